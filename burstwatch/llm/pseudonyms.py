"""Format-preserving pseudonyms for validated numbers, dates and addresses.

Native column expressions only. A value is a list of small numbers, each below a modulus
of its own (a digit below 10, an octet below 256, a letter below 26). A keyed Feistel
network over the two halves of the list adds to each number of one half, modulo its
modulus, a keyed digest of the other half, for eight rounds. That permutes the values of
a format among themselves: equal values get equal pseudonyms in every document, different
ones different pseudonyms, and who has the key can turn them back (``undo``).

What is replaced, and the checks it must pass:

* payment card numbers, 13 to 19 digits, bare or in groups of four: Luhn check; the
  pseudonym passes it too;
* telephone numbers with a country code and ten digits: the ten digits change;
* IPv4 addresses: four octets up to 255 without leading zeros;
* social security numbers ddd-dd-dddd: possible area, group and serial;
* dates yyyy-mm-dd, mm/dd/yyyy and dd.mm.yyyy of the calendar, years 1800 to 2199;
* the part of a mail address before the @: letters and digits change within their class;
* lower-case hexadecimal keys of 32 to 64 digits.

Other digits, such as card-like numbers that fail the Luhn check, stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.llm.shared import bound

ROUNDS = 8
#: Every quantifier is bounded or possessive, so that matching stays linear in long texts.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "hex": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?<gap>[ -])[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4})(?![0-9])",
}
PATTERN = "|".join(KINDS.values())
FIRST_DAY, DAYS = "1800-01-01", 146_097  # 400 years of the calendar
_DAY_MODULI = (189, 773)  # 189 * 773 = DAYS


def _int(c: Column) -> Column:
    return c.cast("int")


def feistel(values: Column, moduli: Column, tag: str, key: str, undo: bool = False) -> Column:
    """Permute ``array<int>`` values below their ``moduli``; the network is its own inverse run backwards."""
    half = _int(F.floor(F.size(values) / 2))
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def network(m: Column, h: Column) -> Column:
        def one(state: Column, r: Column) -> Column:
            left_moves = r % 2 == 0
            fixed = F.when(left_moves, F.slice(state, h + 1, F.size(state) - h)).otherwise(F.slice(state, F.lit(1), h))
            text = F.concat_ws("|", F.lit(key), F.lit(tag), r.cast("string"), F.array_join(fixed.cast("array<string>"), ","))

            def moved(digest: Column) -> Column:
                def each(x: Column, i: Column) -> Column:
                    part = F.conv(F.substring(digest, 1 + (i % 18) * 7, F.lit(7)), 16, 10).cast("long")
                    changed = _int(F.pmod(x - part if undo else x + part, F.get(m, i).cast("long")))
                    return F.when((i < h) == left_moves, changed).otherwise(x)

                return F.transform(state, each)

            return bound(F.sha2(text, 512), moved)

        return F.aggregate(rounds, values, one)

    return bound(F.struct(moduli.alias("m"), half.alias("h")), lambda b: network(b["m"], b["h"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _characters(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)))


def _as_ints(digits: Column) -> Column:
    return F.transform(_characters(digits), lambda c: _int(c))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of a Luhn check over digits; ``doubled``: parity, counted from the right at 0, of the doubled ones."""

    def add(total: Column, i: Column) -> Column:
        d = _int(F.substring(digits, i, F.lit(1)))
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((F.length(digits) - i) % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""

    def each(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        nth = F.length(_digits(F.substring(value, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), each), "")


def _permuted_digits(digits: Column, tag: str, key: str, undo: bool) -> Column:
    values = _as_ints(digits)
    moved = feistel(values, F.transform(values, lambda _: F.lit(10)), tag, key, undo)
    return F.array_join(moved.cast("array<string>"), "")


def _card(value: Column, key: str, undo: bool) -> Column:
    def change(d: Column) -> Column:
        body = _permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), "card", key, undo)

        def checked(b: Column) -> Column:
            check = (10 - _luhn_sum(b, 0) % 10) % 10
            return F.concat(b, check.cast("string"))

        return F.when(_luhn_sum(d, 1) % 10 == 0, _refilled(value, bound(body, checked)))

    return bound(_digits(value), change)


def _phone(value: Column, key: str, undo: bool) -> Column:
    def change(d: Column) -> Column:
        own = F.length(d) - 10
        return _refilled(value, F.concat(
            F.substring(d, F.lit(1), own), _permuted_digits(F.substring(d, own + 1, F.lit(10)), "phone", key, undo)
        ))

    return bound(_digits(value), change)


def _ip(value: Column, key: str, undo: bool) -> Column:
    parts = F.split(value, r"\.")
    octets = F.transform(parts, lambda p: _int(p))
    valid = F.forall(parts, lambda p: (_int(p) < 256) & (_int(p).cast("string") == p))
    moved = feistel(octets, F.array(*[F.lit(256)] * 4), "ip", key, undo)
    return F.when(valid, F.array_join(moved.cast("array<string>"), "."))


def _ssn(value: Column, key: str, undo: bool) -> Column:
    parts = F.transform(F.split(value, "-"), lambda p: _int(p))

    def change(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        place = area - F.when(area > 666, 2).otherwise(1)  # 0..897
        moved = feistel(F.array(place, group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), "ssn", key, undo)

        def shown(m: Column) -> Column:
            new = m[0] + F.when(m[0] >= 665, 2).otherwise(1)
            return F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"), F.lpad((m[1] + 1).cast("string"), 2, "0"),
                               F.lpad((m[2] + 1).cast("string"), 4, "0"))

        return F.when(valid, bound(moved, shown))

    return bound(parts, change)


def _date(value: Column, key: str, undo: bool) -> Column:
    slash, dot = F.substring(value, 3, 1) == "/", F.substring(value, 3, 1) == "."
    cut = lambda a, n: F.substring(value, a, n)
    iso = F.when(slash, F.concat_ws("-", cut(7, 4), cut(1, 2), cut(4, 2))).when(
        dot, F.concat_ws("-", cut(7, 4), cut(4, 2), cut(1, 2))
    ).otherwise(value)
    nth = F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))

    def change(n: Column) -> Column:
        values = F.array(_int(n % _DAY_MODULI[0]), _int(F.floor(n / _DAY_MODULI[0])))
        moved = feistel(values, F.array(*map(F.lit, _DAY_MODULI)), "date", key, undo)

        def shown(m: Column) -> Column:
            day = F.date_add(F.lit(FIRST_DAY).cast("date"), m[0] + m[1] * _DAY_MODULI[0])
            return F.when(slash, F.date_format(day, "MM/dd/yyyy")).when(dot, F.date_format(day, "dd.MM.yyyy")).otherwise(
                F.date_format(day, "yyyy-MM-dd")
            )

        return F.when((n >= 0) & (n < DAYS), bound(moved, shown))

    return bound(nth, change)


def _by_class(value: Column, alphabets: list[str], tag: str, key: str, undo: bool) -> Column:
    """Permute every character within the alphabet of its class; others stay."""

    def code(c: Column) -> Column:
        out = F.lit(0)
        for alphabet in alphabets:
            out = F.when(F.position(c, F.lit(alphabet)) > 0, F.position(c, F.lit(alphabet)) - 1).otherwise(out)
        return _int(out)

    def modulus(c: Column) -> Column:
        out = F.lit(1)
        for alphabet in alphabets:
            out = F.when(F.position(c, F.lit(alphabet)) > 0, F.lit(len(alphabet))).otherwise(out)
        return out

    def letter(c: Column, x: Column) -> Column:
        out = c
        for alphabet in alphabets:
            out = F.when(F.position(c, F.lit(alphabet)) > 0, F.substring(F.lit(alphabet), x + 1, F.lit(1))).otherwise(out)
        return out

    def change(chars: Column) -> Column:
        moved = feistel(F.transform(chars, code), F.transform(chars, modulus), tag, key, undo)
        return F.array_join(F.zip_with(chars, moved, letter), "")

    return bound(_characters(value), change)


_LOWER, _UPPER, _NUMERALS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _email(value: Column, key: str, undo: bool) -> Column:
    local = F.substring_index(value, "@", 1)
    moved = _by_class(local, [_LOWER, _UPPER, _NUMERALS], "email", key, undo)
    return F.concat(moved, F.substring(value, F.length(local) + 1, F.length(value)))


def _hex(value: Column, key: str, undo: bool) -> Column:
    return _by_class(value, ["0123456789abcdef"], "hex", key, undo)


_CHANGES: dict[str, tuple[str, Callable[[Column, str, bool], Column]]] = {
    "email": ("@", _email),
    "hex": (r"^[0-9a-f]{32,64}$", _hex),
    "ip": (r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$", _ip),
    "date": (r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\1[0-9]{4})$", _date),
    "ssn": (r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", _ssn),
    "phone": (r"^\+", _phone),
    "card": (r"^[0-9][0-9 -]{11,}[0-9]$", _card),
}


def pseudonym(value: Column, key: str, undo: bool = False) -> Column:
    """``kind, value`` of one match: its kind and pseudonym, or a null kind and itself if a check fails."""
    kind, new = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (shape, change) in reversed(_CHANGES.items()):
        kind = F.when(value.rlike(shape), F.lit(name)).otherwise(kind)
        new = F.when(value.rlike(shape), change(value, key, undo)).otherwise(new)
    return bound(F.struct(kind.alias("kind"), new.alias("new")), lambda f: F.struct(
        F.when(f["new"].isNotNull(), f["kind"]).alias("kind"), F.coalesce(f["new"], value).alias("value")
    ))


def pseudonymise(
    documents: DataFrame, key: str, text: str = "text", kinds: str | None = None, undo: bool = False
) -> DataFrame:
    """``documents`` with every validated value in ``text`` replaced.

    ``kinds`` names a column to add: the kinds of the replaced values in order (an older one
    of that name is replaced). A null text stays null, with no kinds; a text without a valid
    value stays as it is. Equal values have equal pseudonyms under one key in all rows, also
    repeated ones; other columns are passed on. ``undo`` turns pseudonyms back, as long as
    nothing next to them makes another match.
    """
    body = F.col(text)
    parts = F.split(body, PATTERN, -1)
    found = F.transform(F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0)), lambda m: pseudonym(m, key, undo))

    def rebuilt(values: Column) -> Column:
        new = F.concat(F.transform(values, lambda v: v["value"]), F.array(F.lit("")))
        return F.struct(
            F.array_join(F.zip_with(parts, new, lambda a, b: F.concat(a, b)), "").alias("text"),
            F.filter(F.transform(values, lambda v: v["kind"]), lambda k: k.isNotNull()).alias("kinds"),
        )

    hit = body.rlike("[0-9@]") & body.rlike(PATTERN)
    done = F.when(hit, bound(found, rebuilt)).otherwise(
        F.struct(body.alias("text"), F.array().cast("array<string>").alias("kinds"))
    )
    if kinds is None:
        return documents.select(*(done["text"].alias(c) if c == text else F.col(c) for c in documents.columns))
    both = [c for c in documents.columns if c != kinds]
    held = "done" + "_" * max(map(len, both))
    return documents.select(*both, done.alias(held)).select(
        *(F.col(held)["text"].alias(c) if c == text else F.col(c) for c in both), F.col(held)["kinds"].alias(kinds)
    )

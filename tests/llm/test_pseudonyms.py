"""Pseudonyms against a plain Feistel network, their formats, their inverse."""

import hashlib
import random
import re
from datetime import date

from burstwatch.llm import pseudonyms

KEY = "test key"


def network(values, moduli, tag):
    """The same permutation, number by number."""
    values = list(values)
    half = len(values) // 2
    for r in range(pseudonyms.ROUNDS):
        left = r % 2 == 0
        fixed = values[half:] if left else values[:half]
        digest = hashlib.sha512("|".join([KEY, tag, str(r), ",".join(map(str, fixed))]).encode()).hexdigest()
        for i in range(len(values)):
            if (i < half) == left:
                at = (i % 18) * 7
                values[i] = (values[i] + int(digest[at : at + 7], 16)) % moduli[i]
    return values


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def card(digits):
    new = "".join(map(str, network(map(int, digits[:-1]), [10] * 99, "card")))
    return next(new + str(c) for c in range(10) if luhn(new + str(c)))


def some_cards(n):
    rng, found = random.Random(8), []
    while len(found) < n:
        digits = "".join(rng.choice("0123456789") for _ in range(rng.choice([13, 16, 19])))
        if luhn(digits):
            found.append(digits)
    return found


def replaced(docs, texts, **options):
    rows = docs(list(enumerate(texts)), extra="done")
    found = pseudonyms.pseudonymise(rows, KEY, kinds="kinds", **options)
    assert found.columns == [*rows.columns, "kinds"]
    got = {r.doc_id: (r.text, r.kinds) for r in found.collect()}
    return [got[i] for i in range(len(texts))]


def test_cards_agree_with_plain_network(docs):
    cards = some_cards(30)
    got = replaced(docs, [f"pay {c}, now" for c in cards])
    for c, (text, kinds) in zip(cards, got):
        assert text == f"pay {card(c)}, now" and kinds == ["card"]


def test_every_kind_keeps_its_format_and_can_be_undone(docs):
    texts = [
        "card 4539148803436467 and 4539-1488-0343-6467.", "+1 (017) 555-7713", "+49 301 555 1234", "10.0.0.1, 255.255.255.255",
        "123-45-6789", "1999-12-31 02/28/2001 28.02.2001", "Some.Name_7@mail.example.com", 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"',
    ]
    shapes = [
        r"card \d{16} and \d{4}-\d{4}-\d{4}-\d{4}\.", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\+49 \d{3} \d{3} \d{4}",
        r"[\d.]+, [\d.]+", r"\d{3}-\d{2}-\d{4}", r"\d{4}-\d\d-\d\d \d\d/\d\d/\d{4} \d\d\.\d\d\.\d{4}",
        r"[A-Z][a-z]{3}\.[A-Z][a-z]{3}_\d@mail\.example\.com", r'token = "[0-9a-f]{40}"',
    ]
    got = replaced(docs, texts)
    for text, shape, (new, kinds) in zip(texts, shapes, got):
        assert re.fullmatch(shape, new) and new != text and kinds, (text, new)
    card_a, card_b = re.findall(r"[\d-]{16,}", got[0][0])
    assert luhn(card_a) and card_a == card_b.replace("-", "")
    date.fromisoformat(got[5][0][:10])
    assert [t for t, _ in replaced(docs, [t for t, _ in got], undo=True)] == texts


def test_dates_are_a_permutation(spark):
    from pyspark.sql import functions as F

    days = spark.range(0, pseudonyms.DAYS, 7).selectExpr("cast(date_add(date'1800-01-01', cast(id as int)) as string) as d")
    new = days.select(pseudonyms.pseudonym(F.col("d"), KEY)["value"].alias("v"))
    assert new.distinct().count() == days.count()


def test_what_stays(docs):
    texts = [
        None, "", "no digits", "4539148803436468", "300.1.1.1 1.2.3 1.2.3.4.5 01.2.3.4", "2001-02-30 13/13/2001 1700-01-01", "000-12-3456 666-12-3456",
        "12345", "@ alone", "1" * 5000, "a@b", "x" * 100_000 + "9",
    ]
    assert replaced(docs, texts) == [(t, []) for t in texts]


def test_equal_values_stay_linked(docs):
    got = replaced(docs, ["call +1 (017) 555-7713", "or +1 (017) 555-7713 +1 (017) 555-7714", "call +1 (017) 555-7713"])
    first, second, third = (re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", t) for t, _ in got)
    assert first[0] == second[0] == third[0] != second[1]
    other = pseudonyms.pseudonymise(docs([(1, "call +1 (017) 555-7713")]), "other key").first().text
    assert other != got[0][0]


def test_empty_table(docs):
    assert pseudonyms.pseudonymise(docs([]), KEY).collect() == []

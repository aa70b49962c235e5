"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Native column expressions only. Every rule looks at counts of the whole text and votes
good, bad or not at all. Documents with the same votes are alike to the model, so one
aggregate of at most 3**8 vote patterns is all that expectation-maximisation needs; it
estimates how often each rule votes how on good and on bad documents. Abstaining is no
evidence. The posterior probability of "good" then replaces all-must-pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.llm.shared import SPACES, bound, fresh

SPACE = r"[ \t-\r]"
GOOD, BAD, ABSTAIN = 2, 1, 0
#: Words in a repeat window.
WINDOW = 5


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def twice(x: Column, j: Column) -> Column:
                before = (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
                after = (j < F.size(s) - 1) & (F.get(s, j + 1)["h"] == x["h"])
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            places = F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
            return F.aggregate(
                places, start,
                lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total")),
                lambda acc: acc["total"],
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bound(ordered, repeated)
        )

    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    windows = F.transform(places, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(bound(windows, covered))


def text_counts(text: Column) -> Column:
    """A struct of counts over the whole text; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    by_word = bound(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), _repeat_words(w).alias("n_repeat_words"),
    ))
    by_line = bound(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    return F.struct(
        by_word.alias("words"), by_line.alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaims"),
    )


COUNTS = {
    "n_words": "words.n_words", "word_chars": "words.word_chars", "n_symbols": "n_symbols",
    "n_dup_lines": "lines.n_dup_lines", "n_repeat_words": "words.n_repeat_words",
    "n_distinct": "words.n_distinct", "n_lines": "lines.n_lines", "n_exclaims": "n_exclaims",
}


def votes(c: dict[str, Column]) -> list[Column]:
    """One vote per rule: GOOD, BAD or ABSTAIN."""
    n, distinct = c["n_words"], c["n_distinct"]

    def vote(bad: Column, good: Column | None = None) -> Column:
        answer = F.when(bad, F.lit(BAD))
        return (answer.when(good, F.lit(GOOD)) if good is not None else answer).otherwise(F.lit(ABSTAIN))

    return [
        vote(10 * c["n_symbols"] > n),
        vote(20 * c["n_symbols"] > c["word_chars"]),
        vote((n >= 30) & ((c["word_chars"] > 9 * n) | (c["word_chars"] < 3 * n)),
             (c["word_chars"] >= 4 * n) & (2 * c["word_chars"] <= 13 * n)),
        vote(100 * c["n_repeat_words"] > 20 * n, 20 * c["n_repeat_words"] <= n),
        vote((c["n_dup_lines"] >= 3) & (10 * c["n_dup_lines"] > 3 * c["n_lines"])),
        vote((n >= 30) & (10 * distinct < 3 * n), 2 * distinct >= n),
        vote(5 * c["n_exclaims"] > n),
        vote(n < 10),
    ]


RULES = 8
#: Where EM starts: how often a rule abstains, votes bad, votes good on a bad and on a good document.
START_BAD, START_GOOD, START_PRIOR = (0.2, 0.5, 0.3), (0.18, 0.02, 0.8), 0.8
ROUNDS = 25


@dataclass(frozen=True)
class VoteModel:
    """Log weights of every rule's answers (0 for abstaining), and the log odds of "good" before any vote."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def posterior(self, given: list[Column]) -> Column:
        odds = F.lit(self.prior)
        for vote, table in zip(given, self.weights):
            odds = odds + F.when(vote == BAD, F.lit(table[BAD])).when(vote == GOOD, F.lit(table[GOOD])).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: list[tuple[int, int]]) -> VoteModel:
    """EM over (pattern, documents); a pattern is the votes as digits to the base of three."""
    prior = START_PRIOR
    good, bad = [list(START_GOOD) for _ in range(RULES)], [list(START_BAD) for _ in range(RULES)]
    spelled = [([(p // 3**j) % 3 for j in range(RULES)], n) for p, n in sorted(patterns)]
    total = sum(n for _, n in spelled)

    def model() -> VoteModel:
        return VoteModel(
            math.log(prior / (1 - prior)),
            tuple((0.0, *(math.log(good[j][v] / bad[j][v]) for v in (BAD, GOOD))) for j in range(RULES)),
        )

    for _ in range(ROUNDS if total else 0):
        weights = model()
        g_sum, g_votes, b_votes = 0.0, [[0.0] * 3 for _ in good], [[0.0] * 3 for _ in bad]
        for pattern, n in spelled:
            odds = weights.prior + sum(weights.weights[j][v] for j, v in enumerate(pattern))
            share = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            g_sum += n * share
            for j, v in enumerate(pattern):
                g_votes[j][v] += n * share
                b_votes[j][v] += n * (1 - share)
        prior = (g_sum + 8) / (total + 10)
        # ten documents' worth of the starting table keep every probability above zero
        good = [[(x + 10 * s) / (g_sum + 10) for x, s in zip(row, START_GOOD)] for row in g_votes]
        bad = [[(x + 10 * s) / (total - g_sum + 10) for x, s in zip(row, START_BAD)] for row in b_votes]
    return model()


def counted(documents: DataFrame, text: str = "text", name: str = "counts") -> DataFrame:
    """``documents`` with a struct column ``name`` of the counts of each text."""
    return documents.withColumn(name, text_counts(F.col(text)))


def _columns(name: str) -> dict[str, Column]:
    return {k: F.col(f"{name}.{path}") for k, path in COUNTS.items()}


def fit(documents_with_counts: DataFrame, name: str = "counts") -> VoteModel:
    """Estimate the rules on all rows; the driver sees at most 3**8 pattern counts."""
    pattern = sum((v * 3**j for j, v in enumerate(votes(_columns(name)))), F.lit(0))
    found = documents_with_counts.select(pattern.alias("pattern")).groupBy("pattern").count()
    return estimate([(r["pattern"], r["count"]) for r in found.collect()])


def judged(documents_with_counts: DataFrame, model: VoteModel, name: str = "counts") -> DataFrame:
    """Replace the counts struct by its fields, ``base_failed``, ``posterior`` and ``kept``.

    ``base_failed``: fewer than ten words, or over 20 % of them in repeated windows. Such a
    row is not kept; any other is if its posterior is 0.5 or more. Null, empty and one-word
    texts are base failures; repeated rows are judged alike; columns of the same names as
    the new ones are replaced.
    """
    c = _columns(name)
    kept = [x for x in documents_with_counts.columns if x not in {*COUNTS, "base_failed", "posterior", "kept", name}]
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    posterior = model.posterior(votes(c))
    return documents_with_counts.select(
        *kept, *(x.alias(k) for k, x in c.items()), failed.alias("base_failed"), posterior.alias("posterior"),
        (~failed & (posterior >= 0.5)).alias("kept"),
    )


def keep_good(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that the votes keep, with their columns as they were."""
    name, verdict = fresh("counts", documents.columns), fresh("verdict", documents.columns)
    with_counts = counted(documents, text, name)
    model = fit(with_counts, name)
    c = _columns(name)
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    kept = with_counts.withColumn(verdict, ~failed & (model.posterior(votes(c)) >= 0.5))
    return kept.where(verdict).select(*documents.columns)

"""Counts against a plain count; the vote model against the labels."""

import random
import re
from collections import Counter

from burstwatch.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(set(words)), len(lines), text.count("!"),
    )


TEXTS = [
    None, "", " ", "one", "\n\n a \n a\n b", "é ü\x0bß\x0c# <x>|", "a b c d e a b c d e f", "x " * 12, "a b c d e f g h i",
    "a b c d a b c d a b c d", "line one\nline one\r\nline one\n", "nb\u00a0sp \u2003em", "!" * 5,
]


def test_counts(docs):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = docs(list(enumerate(texts)))
    counted = quality.counted(rows)
    model = quality.fit(counted)
    found = {r.doc_id: r for r in quality.judged(counted, model).collect()}
    for i, text in enumerate(texts):
        expected = plain(text)
        assert tuple(found[i][k] for k in quality.COUNTS) == expected, text
        n, repeated = expected[0], expected[4]
        assert found[i].base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (found[i].kept and found[i].base_failed)


def test_very_long_text(docs):
    text = " ".join(f"w{i % 7000}" for i in range(9000))
    found = quality.judged(quality.counted(docs([(1, text)])), quality.estimate([])).first()
    assert (found.n_words, found.n_repeat_words) == (9000, plain(text)[4])


def test_posterior_follows_the_labels(table):
    rows = quality.counted(table("documents", "sf0.01").join(table("labels", "sf0.01"), "doc_id"))
    found = quality.judged(rows, quality.fit(rows)).where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in found}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.05 * n[0, False]


def test_em_separates_planted_classes():
    """Two kinds of documents; the rules' answers on them are recovered."""
    clean = sum(quality.GOOD * 3**j for j in (2, 3, 5))
    noisy = quality.BAD * (1 + 3) + quality.GOOD * 3**3 + quality.GOOD * 3**5
    model = quality.estimate([(clean, 900), (noisy, 100)])
    assert model.weights[0][quality.BAD] < -2
    assert model.weights[0][quality.ABSTAIN] == 0


def test_keep_good_keeps_columns_and_empty_tables(docs):
    good = " ".join(f"word{i}" for i in range(40))
    rows = docs([(1, good), (1, good), (2, "short"), (3, None)], extra="counts")
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns
    assert [r.doc_id for r in kept.collect()] == [1, 1]
    assert quality.keep_good(docs([])).collect() == []

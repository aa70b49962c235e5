"""Held-out accuracy, defined results of odd rows, and the automaton against edit distance."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstwatch.llm import language, toxicity
from burstwatch.llm.shared import fold_of


def test_language_held_out(table):
    docs = table("documents", "sf0.01")
    model = language.fit(docs, fold_of(F.col("doc_id"), 4) != 2)
    found = language.identify(docs, model, reject=False).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(fold_of(F.col("doc_id"), 4) == 2).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97
    assert len(set(model.languages)) == 4 and len(model.languages) > 4  # several centroids a language
    again = language.fit(docs.repartition(5), fold_of(F.col("doc_id"), 4) != 2)
    assert np.allclose(again.centroids, model.centroids, atol=1e-4)


def test_language_odd_rows(docs, spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(8)] + [(i, "le chat et le chien " * 3, "fr") for i in range(8, 16)]
    table = spark.createDataFrame([*rows, (20, None, "en"), (21, "x y", None)], "doc_id long, text string, lang string")
    model = language.fit(table, F.lit(True), per_language=5000)
    odd = docs([(1, "THE DOG and the cat"), (2, None), (3, ""), (4, "123 - !"), (5, "…—"), (6, "Жук жужжит над лугом"), (6, "le chien"), (None, "le chat " * 40000)])
    got = sorted(((r.doc_id or 99, r.lang_pred, r.score > 0) for r in language.identify(odd, model, reject=False).collect()))
    assert got[0] == (1, "en", True) and got[-1] == (99, "fr", True)
    assert [g for g in got if g[0] in (2, 3, 4, 5)] == [(i, "und", False) for i in (2, 3, 4, 5)]
    rejected = {r.doc_id: r.lang_pred for r in language.identify(odd, model).collect()}
    assert rejected[1] in ("en", "und") and rejected[2] == "und"
    far = language.identify(docs([(1, "zzqx kkwv jjp xxq wwz")]), model).first()
    assert far.lang_pred == "und" and far.rejected


def test_language_without_training(docs):
    empty = docs([]).withColumn("lang", F.lit("en"))
    model = language.fit(empty, F.lit(True))
    assert [(r.lang_pred, r.score) for r in language.identify(docs([(1, "words")]), model).collect()] == [("und", 0.0)]
    assert language.identify(docs([]), model).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rng = random.Random(5)
    terms = ["scum", "idiot", "worthless", "disgusting", "abcabcabcabc"]
    automaton = toxicity.build([t.encode() for t in terms])
    words = []
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "a", "s"])
        words.append("".join(word) or "z")
    from burstwatch.llm.batches import chunks
    import pyarrow as pa

    (chunk,) = chunks(pa.array([" ".join(words)]))
    at, _, _, edits = toxicity.found_terms(chunk, automaton)
    found = dict(zip(at.tolist(), edits.tolist()))
    place = 0
    for word in words:
        best = min((d for t in terms if (d := distance(word, t)) <= toxicity.allowed_edits(t.encode())), default=None)
        assert found.get(place) == best, word
        place += len(word) + 1


def test_an_edit_is_a_letter_in_any_script():
    """Accented, Cyrillic and CJK words against edit distance over letters, upper case as lower case."""
    import pyarrow as pa
    from burstwatch.llm.batches import chunks

    rng = random.Random(11)
    terms = ["réeux", "hateful", "дурачок", "ненавистный", "漢字漢字漢字", "αβγδε", "éé", "𐐨𐐩𐐪𐐫𐐬𐐭"]
    automaton = toxicity.build([t.encode() for t in terms])
    words = ["reeux", "hatéful", "RÉEUX", "ДУРАЧОК", "дурачек", "𐐀𐐩𐐪𐐫𐐬", "ÉÉ", "ee", "HATÉFUL"]
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "é", "ч", "字", "q", "𐐨"])
        words.append("".join(c.upper() if rng.random() < 0.2 and len(c.upper()) == 1 else c for c in word) or "z")
    (chunk,) = chunks(pa.array([" ".join(words)]))
    at, _, _, edits = toxicity.found_terms(chunk, automaton)
    found, place = dict(zip(at.tolist(), edits.tolist())), 0
    for word in words:
        near = [d for t in terms if (d := distance(word.lower(), t)) <= toxicity.allowed_edits(t.encode())]
        assert found.get(place) == min(near, default=None), word
        place += len(word.encode()) + 1


def test_stems_take_any_ending():
    import pyarrow as pa
    from burstwatch.llm.batches import chunks

    automaton = toxicity.build([b"idiot"], [b"achlich"])
    words = ["achlich", "achlichkeitenundmehr", "achlick", "achlic", "idiots", "idiotsss", "nachlich", "achlichx"]
    (chunk,) = chunks(pa.array([" ".join(words)]))
    at = toxicity.found_terms(chunk, automaton)[0].tolist()
    places = {sum(len(w) + 1 for w in words[:i]): w for i, w in enumerate(words)}
    assert [places[p] for p in at] == ["achlich", "achlichkeitenundmehr", "idiots", "achlichx"]


def test_quotation_is_told_from_abuse():
    import pyarrow as pa
    from burstwatch.llm.batches import chunks

    automaton = toxicity.build([b"idiot"])
    texts = ["you idiot", 'he wrote "you idiot" and left', "you idi0t!", "nothing", ""]
    rows = np.concatenate([toxicity.features(c, automaton) for c in chunks(pa.array(texts))])
    assert (rows[:, :4] > 0).tolist() == [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0] * 4, [0] * 4]


def test_toxicity_held_out(table):
    docs, labels = table("documents", "sf0.1"), table("labels", "sf0.1")
    model = toxicity.fit(docs, labels, fold_of(F.col("doc"), 5) != 0)
    assert b"idiot" in model.terms
    found = toxicity.score(docs, model).join(labels, "doc_id").where(fold_of(F.col("doc_id"), 5) == 0).toPandas()
    assert (found.toxic == found.predicted).mean() > 0.97
    assert found[found.toxic == 1].predicted.mean() > 0.85
    assert found.score.between(0, 1).all()


def test_toxicity_odd_rows(docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    rows = docs([(1, "idiot " * 9), (2, "fine words"), (3, None), (4, ""), (4, ""), (None, "idiot")])
    model = toxicity.fit(rows, labels, F.lit(True))
    found = toxicity.score(rows, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    none = toxicity.fit(rows, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(rows, none).collect()} == {0.5}
    assert toxicity.score(docs([]), model).collect() == []


def test_stems_are_found_with_edits():
    import pyarrow as pa
    from burstwatch.llm.batches import chunks

    rng = random.Random(7)
    terms, stems = ["scum", "disgusting", "achlichkeiten"], ["achlich", "bomen", "clownesk"]
    automaton = toxicity.build([t.encode() for t in terms], [s.encode() for s in stems], near_stems=True)
    words = []
    for _ in range(3000):
        word = list(rng.choice(terms + stems))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "c", "l"])
        words.append("".join(word) + rng.choice(["", "en", "erundvieleslaengerealsalle"]) or "z")
    (chunk,) = chunks(pa.array([" ".join(words)]))
    at, _, _, edits = toxicity.found_terms(chunk, automaton)
    found = dict(zip(at.tolist(), edits.tolist()))
    place = 0
    for word in words:
        near = [d for t in terms if (d := distance(word, t)) <= toxicity.allowed_edits(t.encode())]
        near += [d for s in stems for k in range(len(word) + 1) if (d := distance(word[:k], s)) <= toxicity.allowed_edits(s.encode())]
        assert found.get(place) == min(near, default=None), word
        place += len(word) + 1


def test_rare_and_many_terms_are_learned(docs, spark):
    """A word of 5 % of 2,000 toxic texts, a stem of 1.5 %, and more than a hundred words."""
    rng = random.Random(3)
    filler = ["".join(rng.choices("aeimnorst", k=4)) for _ in range(60)]
    toxic = [rng.choices(filler, k=12) + ["vermin"] for _ in range(2000)]
    for i in range(100):
        toxic[i].append("schurke")
    for i in range(30):
        toxic[200 + i] += [f"bomente{rng.choice('bcdfg')}{i}", f"bomente{rng.choice('bcdfg')}x{i}"]
    many = [f"{a}{b}zzq" for a in "bcdfghjklmpv" for b in "bcdfghjklmpv"]
    for i, word in enumerate(many):
        for j in range(25):
            toxic[(i * 25 + j) % 1600 + 400].append(word)
    clean = [rng.choices(filler, k=12) for _ in range(2000)]
    rows = docs([(i, " ".join(w)) for i, w in enumerate(toxic + clean)])
    labels = spark.createDataFrame([(i, int(i < 2000)) for i in range(4000)], "doc_id long, toxic int")
    model = toxicity.fit(rows, labels, F.lit(True))
    assert {b"vermin", b"schurke", *(w.encode() for w in many)} <= set(model.terms)
    assert any(s.startswith(b"bomen") for s in model.stems)
    assert not {f.encode() for f in filler} & set(model.terms)


def test_every_language_is_learned(spark):
    """More labels than 500, the rarest with one row."""
    rng = random.Random(11)
    names = [f"l{i:03}" for i in range(520)]
    rows = []
    for i, name in enumerate(names):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(len(rows) + k, " ".join(words), name) for k in range(2 if i < 500 else 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table, F.lit(True), clusters=1)
    assert set(model.languages) == set(names)
    found = language.identify(table, model, reject=False).join(table, "doc_id")
    assert found.where("lang_pred <> lang").count() == 0


def test_no_language_is_lost_whatever_its_ids(spark):
    """Null, repeated and distinct ids, one repeated row, and a language mostly without letters."""
    import random

    rng = random.Random(9)
    kinds = {"none": lambda i: None, "same": lambda i: 7, "own": lambda i: i}
    rows = []
    for n, (name, key) in enumerate(kinds.items()):
        words = ["".join(rng.choice("abcdefghij"[n * 3 : n * 3 + 4]) for _ in range(6)) for _ in range(30)]
        rows += [(key(i), " ".join(rng.choice(words) for _ in range(12)), name) for i in range(3000)]
    rows += [(1, "ein und derselbe Satz", "copy")] * 3000 + [(i, "...", "dots") for i in range(500)] + [(9, "zu zweit", "dots")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table, F.lit(True), per_language=200)
    assert set(model.languages) == {"none", "same", "own", "copy", "dots"}
    sample = language._sampled(table.select(F.col("doc_id").cast("string").alias("doc"), "lang", "text"), 200)
    assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == dict.fromkeys([*kinds, "copy", "dots"], 200)
    asked = table.where("lang <> 'dots'").select("text", F.col("lang").alias("doc_id")).distinct()
    got = language.identify(asked, model, reject=False).groupBy("doc_id").agg(F.avg((F.col("lang_pred") == F.col("doc_id")).cast("int"))).collect()
    assert len(got) == 4 and all(share > 0.99 for _, share in got)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.fit(table, F.lit(True), languages=3)


def test_nearest_centroid_is_the_plain_one(spark, table):
    docs = table("documents")
    model = language.fit(docs, F.lit(True), per_language=50)
    texts = docs.select("doc_id", "text").collect()
    import pyarrow as pa

    from burstwatch.llm.batches import chunks

    want = {}
    for row in texts:
        chunk = next(chunks(pa.array([row["text"]], pa.string())))
        vector = language.vectors(language.term_counts(chunk), model.idf)[0]
        cosines = [sum(float(a) * float(b) for a, b in zip(vector, c) if a) for c in model.centroids]
        want[row["doc_id"]] = max(cosines), cosines
    for row in language.identify(docs, model, reject=False).collect():
        best, cosines = want[row["doc_id"]]
        if row["lang_pred"] == "und":
            continue
        assert abs(row["score"] - best) < 1e-4
        assert max(c for c, name in zip(cosines, model.languages) if name == row["lang_pred"]) > best - 1e-4

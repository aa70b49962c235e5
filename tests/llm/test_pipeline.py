"""The stages one by one against brute force, and the whole."""

import hashlib
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from burstwatch.llm import contamination, jaccard, pseudonyms, quality
from test_contamination_urls import brute as held_items
from test_jaccard import brute as linked

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "pii", "tokens"]
    columns = docs.columns

    counted = quality.counted(docs)
    good = {r.doc_id for r in quality.judged(counted, quality.fit(counted)).where("kept").collect()}
    first = corpus_pipeline.quality_stage(spark, docs, FOLDER)
    rows = [(r.doc_id, r.text) for r in first.collect()]
    assert first.columns == columns and {d for d, _ in rows} == good

    second = corpus_pipeline.duplicate_stage(spark, first, FOLDER)
    lowest = {d: c for d, _, c in linked(rows, 5, 80)}
    kept = [(r.doc_id, r.text) for r in second.collect()]
    assert second.columns == columns and {d for d, _ in kept} == {d for d in lowest if lowest[d] == d}

    third = corpus_pipeline.decontamination_stage(spark, second, FOLDER)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {d for d, *_ in held_items(kept, items)}
    clean = {r.doc_id: r.text for r in third.collect()}
    assert third.columns == columns and set(clean) == {d for d, _ in kept} - held

    fourth = corpus_pipeline.pii_stage(spark, third, FOLDER)
    private = {r.doc_id: r.text for r in fourth.collect()}
    assert fourth.columns == columns and set(private) == set(clean)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in whole} == set(private)
    for r in whole:
        ids = library.encode(private[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(private[r.doc_id].encode()).hexdigest()


ODD = "doc_id long, text string, lang string, source string, n_chars long, size string, part string, verdict string, id long"


def odd_tables(spark, folder, rows):
    table = spark.createDataFrame([(i, t, "en", "web", 1, "x", "y", "z", 5) for i, t in rows], ODD)
    table.write.parquet(f"{folder}/documents.parquet")
    items = [(1, "the quick ferry leaves the northern pier at noon sharp"), (2, None), (3, ""), (3, "...")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return table


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Null, empty, repeated and very long texts, null and repeated ids, further columns with inner names."""
    real = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(80).collect()]
    rows = list(enumerate(real)) + [(None, None), (None, ""), (900, None), (900, ""), (901, "  "), (None, real[0])]
    rows += [(902, real[1])] * 3 + [(903, real[2] + " " + real[3] * 40), (904, "word")]
    held = real[4] + " the quick ferry leaves the northern pier at noon sharp"
    table = odd_tables(spark, tmp_path, rows + [(905, held)])
    docs, sizes = table, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == table.columns and {r["size"] for r in docs.select("size").distinct().collect()} <= {"x"}
        sizes.append(docs.count())
    assert len(rows) + 1 > sizes[0] >= sizes[1] >= sizes[2] == sizes[3] > 0
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(left) == sizes[3]  # no id twice: its rows were copies of one another
    assert not any(t is None or "quick ferry leaves the northern pier" in t for t in left.values())
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in done) == sorted(map(str, left)) and all(r["n_tokens"] > 0 for r in done)


def test_empty_documents(spark, tmp_path):
    odd_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for path in root.glob("burstwatch/**/*.py"):
        if "llm" not in path.parts:
            assert "burstwatch.llm" not in path.read_text(), path
    assert contamination and jaccard and pseudonyms

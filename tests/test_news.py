from datetime import datetime

import pytest
from pyspark.sql import functions as F

from burstwatch import news
from burstwatch.plans import news_queries, tables

NGRAMS = "docid long, quadgram string, count long, pos long"


def snippets(spark, rows, **options):
    data = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], NGRAMS)
    return {r["docid"]: r["snippet"] for r in news.build_snippets(data, **options).collect()}


def test_snippets(spark):
    assert snippets(spark, [(1, "north pier reopens today", 1), (1, "ferries run every hour", 5), (2, "storm closes coastal road", 2)]) == {
        1: "ferries run every hour north pier reopens today", 2: "storm closes coastal road"}
    assert snippets(spark, [(1, f"quadgram number {i}", i) for i in range(10)], n=3)[1] == (
        "quadgram number 9 quadgram number 8 quadgram number 7")
    assert snippets(spark, [(31, "bread prices rise again,", 4), (31, "bread prices rise again!", 1)])[31] == "bread prices rise again"
    assert snippets(spark, [(1, "...", 5), (1, "real content here", 1)])[1] == "real content here"
    assert snippets(spark, [(1, "b", 1), (1, "a", 1), (1, "c", 1)])[1] == "b a c"
    assert snippets(spark, []) == {}


TOC = "ID long, date string, img string, lang string, title string, url string, toc_timestamp string, pos long"


def toc(spark, *rows):
    full = [(i, "2026-08-06T02:17:00.000Z", r.get("img", ""), r.get("lang", "en"), r.get("title", "T"), r.get("url", f"https://e.com/{i}"),
             r.get("minute", "20260806021700"), i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TOC)


def test_normalize(spark):
    rows = news.normalize(toc(spark, {"url": " https://e.com/a ", "title": " A\n"}, {"url": "  "}, {"title": ""}, {"title": None}, {"img": "i.png"})).collect()
    assert [(r["toc_id"], r["title"], r["url"], r["image_url"], r["snippet"]) for r in rows] == [
        (0, "A", "https://e.com/a", None, ""), (4, "T", "https://e.com/4", "i.png", "")]
    assert rows[0]["observed_at"].endswith("Z") and rows[0]["source"] == "gdelt_web_ngrams" and rows[0]["event_type"] == "article"


def test_languages(spark):
    assert news.parse_languages(" EN, es ,,en") == ("en", "es")
    assert news.parse_languages(None) == () and news.parse_languages(" , ") == ()
    articles = news.normalize(toc(spark, {"lang": " EN "}, {"lang": "fr"}, {"lang": None}))
    assert news.in_languages(articles, ()).count() == 3
    assert [r["toc_id"] for r in news.in_languages(articles, ("en",)).collect()] == [0]


def test_assemble(spark):
    ngrams = spark.createDataFrame(
        [(0, "real quadgram text here", 2, 0, "20260806021700"), (1, "wrong minute text here", 2, 1, "20260806021800")], NGRAMS + ", toc_timestamp string")
    entries = toc(spark, {"url": "https://e.com/x"}, {"url": "https://e.com/y"}, {"url": "https://e.com/x", "title": "again"}, {"lang": "fr"})
    rows = news.assemble(entries, ngrams, ("en",)).collect()
    assert sorted((r["toc_id"], r["title"], r["snippet"]) for r in rows) == [(0, "T", "real quadgram text here"), (1, "T", "")]


def test_pending_minutes(spark):
    ledger = spark.createDataFrame([("20260806021500",), ("20260806021000",), ("20200101000000",)], "toc_timestamp string")
    now = datetime(2026, 8, 6, 2, 25, 42)
    minutes = sorted(r[0] for r in news.pending_minutes(spark, now, ledger, lookback=10).collect())
    assert minutes == [f"202608060{m}00" for m in range(211, 221) if m != 215]
    everything = news.pending_minutes(spark, now, ledger.limit(0), lookback=10)
    assert everything.count() == 11
    kept = news.prune_ledger(ledger, datetime(2026, 8, 6, 5, 12, 0)).collect()
    assert [r[0] for r in kept] == ["20260806021500"]


def test_dedup_keeps_the_first(spark):
    articles = news.normalize(toc(spark, {"url": "https://e.com/x", "minute": "20260806021800"}, {"url": "https://e.com/x"}), keep=("pos",))
    assert [r["toc_id"] for r in news.dedup(articles).collect()] == [1]


def _small_folder(spark, tmp_path):
    """Texts that repeat words, share an id, or are too short, and their pages."""
    texts = [(10, "a b c d a b c d a b"), (11, "x, y z. w v x, y z. w"), (11, "x, y z. w again"), (12, "too short"), (None, "p q r s")]
    rows = [(n, text, "en") for n, text in texts]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(n, f"https://example.com/{n}") for n in range(3)]
    spark.createDataFrame(pages, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString().splitlines()


def test_quadgrams_are_counted_where_their_texts_were_dealt(spark, tmp_path):
    folder = _small_folder(spark, tmp_path)
    snippets = news_queries.build_snippets(spark, folder)
    assert sum("Exchange" in line for line in _plan(snippets)) == 1  # the texts, not their runs
    found = {r["docid"]: r["snippet"] for r in snippets.collect()}
    assert set(found) == {10, 11, None}
    assert found[10] == "a b c d b c d a c d a b d a b c"
    assert found[11].startswith("x, y z. w y z. w v")


def test_minutes_of_quadgrams_are_found_without_making_them(spark, tmp_path):
    folder = _small_folder(spark, tmp_path)
    minutes = tables.ngram_minutes(spark, folder)
    every = tables.ngrams(spark, folder).select("toc_timestamp").distinct()
    assert not any("Generate" in line for line in _plan(minutes)) and any("Generate" in line for line in _plan(every))
    assert sorted(minutes.collect(), key=str) == sorted(every.collect(), key=str)


def test_assembling_does_not_move_quadgrams(spark, tmp_path):
    folder = _small_folder(spark, tmp_path)
    plan = _plan(news.assemble(tables.toc(spark, folder), tables.ngrams(spark, folder)))
    runs = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    join = max(i for i, line in enumerate(plan[:runs]) if "Join" in line)
    assert "ShuffledHashJoin" in plan[join] and not any("Exchange" in line for line in plan[join:runs])

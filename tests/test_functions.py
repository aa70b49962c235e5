import pytest
from pyspark.sql import functions as F

from burstwatch import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


CLEANED = [
    ("Restored revision 9071 by [[Special:Contributions/Orla|Orla]] ([[User talk:Orla|talk]]): taking out an unsourced rumour",
     "taking out an unsourced rumour"),
    ("/* Timetable */ ferry hours for winter", "Timetable ferry hours for winter"),
    ("split off to [[Old lighthouse]]", "split off to Old lighthouse"),
    ("per [[Treaty of the bay|that treaty]]", "per that treaty"),
    ("a  b\x1fc", "a b c"),
    ("undid REVISIONS 1 - 2 BY [[x]] : why", "why"),
    ("/* a\rb */ c", "a b c"),
    ("/* a\nb */ c", "/* a b */ c"),
    ("", ""), (None, ""), ("   ", ""),
]

DROPPED = [
    "ce", "rv", "RV", "rv top", "ce, mos", "", "   ", None, "/* top */", "/* See also */", "/* Attendances */",
    "/* External links */", "/* See also */ | /* Attendances */ | /* See also */", "created article",
    "Created page", "Undid revision 20864 by [[Special:Contributions/Ivo|Ivo]] (talk): rv", "правка",
]
KEPT = [
    "rv hoax", "strike", "flood", "ce: corrected the harbour depth", "/* Timetable */ last ferry now at 23",
    "n/a", "rvx", "xrv", "cem",
    "Restored revision 9071 by [[Special:Contributions/Orla|Orla]] ([[User talk:Orla|talk]]): taking out a rumour",
]


def test_clean_comment(spark):
    rows = spark.createDataFrame(CLEANED, "raw string, want string")
    for r in rows.withColumn("have", fn.clean_comment(F.col("raw"))).collect():
        assert r["have"] == r["want"], r["raw"]


def test_clean_comment_keeps_template_words(spark):
    raw = "Created page with '{{Infobox bridge|Swing bridge over the eastern canal}}'"
    cleaned = one(spark, fn.clean_comment(F.lit(raw)))
    assert "Swing bridge" in cleaned
    assert not any(mark in cleaned for mark in ("{{", "}}", "|"))


@pytest.mark.parametrize("kept", [False, True])
def test_substantive_comment(spark, kept):
    rows = spark.createDataFrame([(c,) for c in (KEPT if kept else DROPPED)], "c string")
    for r in rows.withColumn("s", fn.substantive_comment(F.col("c"))).collect():
        assert (r["s"] is not None) == kept, r["c"]


def test_embedded_texts(spark):
    rows = spark.createDataFrame(
        [("Fires near LA", "evacuation order"), ("Fires near LA", "  "), ("Fires near LA", None),
         (None, "some fragment"), (None, None)], "a string, b string")
    articles = [r[0] for r in rows.select(fn.article_text(F.col("a"), F.col("b"))).collect()]
    assert articles == ["Fires near LA. evacuation order", "Fires near LA", "Fires near LA", "some fragment", ""]
    pages = spark.createDataFrame(
        [("Eastern_canal_closure", "barges rerouted"), ("Eastern_canal_closure", ""), (None, None)], "a string, b string")
    texts = [r[0] for r in pages.select(fn.anomaly_text(F.col("a"), F.col("b"))).collect()]
    assert texts == ["Eastern canal closure barges rerouted", "Eastern canal closure", ""]


@pytest.mark.parametrize("text, epoch", [
    ("2026-08-10T14:30:00Z", 1786372200),
    ("2026-08-10T14:30:00", 1786372200),
    ("2026-08-10 10:30:00", 1786372200),  # Eastern wall time
    ("2026-01-10 10:30:00", 1768059000),
    ("2026-08-10 14:30:00+00:00", 1786372200),
    ("2026-08-10T16:30:00+02:00", 1786372200),
    ("", None), (None, None), ("soon", None),
])
def test_parse_window_time(spark, text, epoch):
    parsed = F.unix_seconds(fn.parse_window_time(F.lit(text).cast("string")))
    assert one(spark, parsed) == epoch


@pytest.mark.parametrize("start, end, label", [
    ("2026-08-10T14:30:00Z", "2026-08-10T14:45:00Z", "Aug 10 10:30 – 10:45 ET"),
    ("2026-08-10 10:30:00", "2026-08-10 10:45:00", "Aug 10 10:30 – 10:45 ET"),
    ("bad", None, "bad – ?"), (None, "x", "? – x"), (None, None, None), ("", "", None),
])
def test_window_label(spark, start, end, label):
    assert one(spark, fn.window_label(F.lit(start).cast("string"), F.lit(end).cast("string"))) == label


@pytest.mark.parametrize("title, path", [
    ("A b/c", "A_b/c"), ("x~y*z", "x~y%2Az"), ("Zoë+1", "Zo%C3%AB%2B1"), ("Q&A?", "Q%26A%3F"),
])
def test_page_url(spark, title, path):
    assert one(spark, fn.page_url(F.lit(title))) == "https://en.wikipedia.org/wiki/" + path


def test_page_url_without_title(spark):
    assert one(spark, fn.page_url(F.lit(""))) is None
    assert one(spark, fn.page_url(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("url, domain", [
    ("https://news.example.com/a", "news.example.com"), ("https://u:p@h.example:81/x?y#z", "u:p@h.example:81"),
    ("//h/x", "h"), ("not a url", None), ("", None), (None, None), ("http://a b/c|d", "a b"),
])
def test_url_domain(spark, url, domain):
    assert one(spark, fn.url_domain(F.lit(url).cast("string"))) == domain


def test_small_functions(spark):
    assert one(spark, fn.edge_trim(F.lit(' ("rock-n-roll, isn\'t it?") \t'))) == "rock-n-roll, isn't it"
    assert one(spark, fn.iso_to_epoch(F.lit("1970-01-01T00:01:00Z"))) == 60
    assert one(spark, fn.iso_to_epoch(F.lit("yesterday"))) == 0
    assert one(spark, fn.minute_key(F.timestamp_seconds(F.lit(1704067261)))) == "20240101000100"
    same = one(spark, fn.stable_id(F.lit(" https://e.com/a\n"))), one(spark, fn.stable_id(F.lit("https://e.com/a")))
    assert same[0] == same[1] and len(same[0]) == 64
    pair = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0))
    assert one(spark, fn.cosine(*pair)) == pytest.approx(0.96)

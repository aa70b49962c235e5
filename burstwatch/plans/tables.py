"""The roles of the domain, played by the generated test tables.

Each function maps a table of the data folder to the records an operator
expects; ``SQL`` holds the same mapping as common table expressions for the
reference SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from burstwatch.functions.times import MINUTE_KEY
from burstwatch.session import spread
from burstwatch.sources.decode import once

COMMENTS = (
    "ce",
    "rv top",
    "/* See also */",
    "/* Casualties */ revised toll after official report",
    "moved section to [[Harbour tunnel]]",
    "per [[Great flood of 1910|the flood article]]",
    "Undid revision 4711 by [[Special:Contributions/Zed|Zed]] (talk): rv",
    "Restored revisions 12 through 15 by [[Special:Contributions/Ann|Ann]] "
    "([[User talk:Ann|talk]]): sourced figures were removed",
    "Created page with '{{Short description|Harbour town in the north}}'",
    "   ",
    "",
    "n/a",
    "created article",
    "fire",
    "typo, fmt;  added   eyewitness   account",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _written(rows: DataFrame, *columns) -> DataFrame:
    """The columns as if read from a file: built once, whatever the operators do with them."""
    return rows.select(once(F.struct(*columns)))


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows are about to be worked on one by one; a single small file is spread."""
    return spread(table(spark, folder, name))


# A text of 400 words becomes 400 rows of a hundred bytes: parts so many times smaller than those read hold them in memory.
PARTS = 8


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table dealt out by ``keys`` into parts whose number follows the table's size.

    There are never fewer than a shuffle makes, as a join would deal the rows out again.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, PARTS * rows.rdd.getNumPartitions()), *keys)


def _by_number(values: tuple[str, ...], number: str):
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.col(number) % len(values) + 1).cast("int"))


def edits(spark: SparkSession, folder: str) -> DataFrame:
    """Edit records with ``event_time`` and transport columns, from ``events``."""
    kind = F.col("event_type")
    size = F.round(F.col("value") * 100).cast("long")
    return (
        spread_table(spark, folder, "events")
        .withColumn("size", size)
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("event_id").alias("recent_change_id"),
            (F.col("event_id") + 1000).alias("revision_id"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.concat(F.lit("page_"), F.get_json_object("props", "$.k")).alias("page_title"),
            F.lit(0).cast("long").alias("namespace"),
            F.concat(F.lit("u"), F.col("user_id")).alias("user"),
            (kind == "error").alias("bot"),
            (kind == "view").alias("minor"),
            F.col("size").alias("old_length"),
            F.when(kind.isin("signup", "error"), F.lit(0)).otherwise(F.col("size") * 2).alias("new_length"),
            F.when(kind.isin("signup", "error"), -F.col("size")).otherwise(F.col("size")).alias("byte_change"),
            _by_number(COMMENTS, "event_id").alias("comment"),
            F.lit("en.wikipedia.org").alias("server_name"),
            F.when(kind == "signup", "new").otherwise("edit").alias("event_type"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("kafka_timestamp"),
            F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("event_time"),
        )
    )


def edit_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Edits as topic rows; removals by bots arrive cut off and new pages lack their id."""
    rows = edits(spark, folder)
    fields = [
        "event_id", "recent_change_id", "revision_id", "timestamp", "page_title", "namespace", "user",
        "bot", "minor", "old_length", "new_length", "byte_change", "comment", "server_name", "event_type",
    ]
    body = F.to_json(F.struct(*fields))
    no_id = F.to_json(F.struct(*fields[1:]))
    value = (
        F.when(F.col("bot"), F.regexp_replace(body, "}$", ""))
        .when(F.col("event_type") == "new", no_id)
        .otherwise(body)
    )
    return _written(
        rows, value.alias("value"), "partition", "offset", F.col("kafka_timestamp").alias("timestamp")
    )


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw change events: out-of-scope servers, types and namespaces, absent and null flags."""
    kind = F.col("event_type")
    length = F.round(F.col("value") * 100).cast("long")
    common = [
        F.col("event_id").alias("id"),
        F.when(kind == "signup", "new").when(kind == "error", "log").otherwise("edit").alias("type"),
        F.when(F.col("user_id") % 7 == 0, 1).otherwise(0).alias("namespace"),
        F.concat(F.lit("page_"), F.get_json_object("props", "$.k")).alias("title"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(kind != "click", _by_number(COMMENTS, "event_id")).alias("comment"),
        F.when(F.col("user_id") % 11 == 0, "de.wikipedia.org").otherwise("en.wikipedia.org").alias("server_name"),
        F.struct(F.concat(F.lit("m"), F.col("event_id")).alias("id")).alias("meta"),
        F.when(
            kind != "signup",
            F.struct(F.when(kind != "click", length).alias("old"), (length + 50).alias("new")),
        ).alias("length"),
        F.struct((F.col("event_id") + 1000).alias("new")).alias("revision"),
    ]
    keep_nulls = {"ignoreNullFields": "false"}
    with_flags = F.struct(
        *common,
        F.when(kind != "purchase", F.col("value") > 10).alias("bot"),
        F.when(kind != "purchase", F.col("value") > 20).alias("minor"),
    )
    value = F.when(kind == "view", F.to_json(F.struct(*common), keep_nulls)).otherwise(
        F.to_json(with_flags, keep_nulls)
    )
    return _written(spread_table(spark, folder, "events"), value.alias("value"))


def history_lines(spark: SparkSession, folder: str) -> DataFrame:
    """History records in the accepted spellings, plus blank lines and non-objects."""
    e = edits(spark, folder).withColumn("kind", F.col("user"))
    number = F.col("offset") % 6
    keep_nulls = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct("page_title", "user", "bot", "minor", "byte_change", "timestamp"))
    api = F.to_json(F.struct(
        F.col("page_title").alias("title"), F.col("user").alias("user_name"), "bot",
        F.col("old_length").alias("oldlen"), F.col("new_length").alias("newlen"), "timestamp",
    ))
    new_page = F.to_json(F.struct(
        F.lit("").alias("page_title"), F.col("page_title").alias("page"), "user",
        F.lit(0).alias("old_length"), F.lit(50).alias("new_length"), F.col("timestamp").alias("ts"),
    ))
    odd = F.to_json(F.struct(
        "page_title", "user", F.lit("false").alias("bot"), F.lit(None).cast("boolean").alias("minor"),
        F.lit("many").alias("byte_change"), F.col("timestamp").cast("string").alias("time"),
    ), keep_nulls)
    value = (
        F.when(number == 0, plain).when(number == 1, api).when(number == 2, new_page)
        .when(number == 3, odd).when(number == 4, F.lit("  ")).otherwise(F.lit("[1, 2]"))
    )
    return _written(e, value.alias("value"))


def api_changes(spark: SparkSession, folder: str) -> DataFrame:
    """API change records: some without title or user, some without a size, some bad times."""
    e = edits(spark, folder)
    return e.select(
        F.when(F.col("minor") & F.col("user").endswith("7"), "").otherwise(F.col("page_title")).alias("title"),
        F.when(~(F.col("minor") & F.col("user").endswith("3")), F.col("user")).alias("user"),
        F.when(~F.col("minor"), F.col("bot")).alias("bot"),
        "minor",
        F.when(F.col("bot"), F.lit("yesterday"))
        .otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        F.when(F.col("event_type") != "new", F.col("old_length")).alias("oldlen"),
        F.col("new_length").alias("newlen"),
    )


def toc(spark: SparkSession, folder: str) -> DataFrame:
    """News entries from ``documents``: the whole text is the title, the URL comes from ``pages``.

    There are more documents than pages, so URLs repeat. Ten entries share a minute.
    """
    pages = table(spark, folder, "pages")
    total = pages.agg(F.count(F.lit(1))).scalar()
    docs = spread_table(spark, folder, "documents").withColumn("page_id", F.col("doc_id") % total)
    minute = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("doc_id") / 10) * 60)
    return docs.join(pages.select("page_id", F.col("url").alias("page_url")), "page_id").select(
        F.col("doc_id").alias("ID"),
        F.date_format(minute, "yyyy-MM-dd'T'HH:mm:ss.000'Z'").alias("date"),
        F.when(F.col("lang") == "en", "").otherwise(F.concat("page_url", F.lit("/i.png"))).alias("img"),
        "lang",
        F.col("text").alias("title"),
        F.concat(F.lit(" "), "page_url", F.lit("  ")).alias("url"),
        F.date_format(minute, MINUTE_KEY).alias("toc_timestamp"),
        F.col("doc_id").alias("pos"),
    )


def toc_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The entries as JSON lines; Spanish ones arrive cut off, German ones as a bare list."""
    fields = ["ID", "date", "img", "lang", "title", "url"]
    body = F.to_json(F.struct(*fields))
    value = (
        F.when(F.col("lang") == "es", F.regexp_replace(body, "}$", ""))
        .when(F.col("lang") == "de", F.concat(F.lit("["), F.col("ID").cast("string"), F.lit("]")))
        .otherwise(body)
    )
    return _written(toc(spark, folder), value.alias("value"), "toc_timestamp", "pos")


def _minute_texts(spark: SparkSession, folder: str) -> DataFrame:
    minute = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("doc_id") / 10) * 60)
    return table(spark, folder, "documents").select(
        F.date_format(minute, MINUTE_KEY).alias("toc_timestamp"), F.col("doc_id").alias("docid"), "text"
    )


def _in_words(texts: DataFrame) -> DataFrame:
    """The texts that have a run of four words, as lists of words."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return texts.select("toc_timestamp", "docid", words.alias("words")).filter(F.size("words") >= 4)


def ngram_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """The minutes that ``ngrams`` has rows of, without making them."""
    return _in_words(_minute_texts(spark, folder)).select("toc_timestamp").distinct()


def ngrams(spark: SparkSession, folder: str, keys: tuple[str, ...] = ("toc_timestamp", "docid")) -> DataFrame:
    """Every run of four words of every document, one row per occurrence in text order.

    Texts are dealt out by ``keys`` before they become runs, so that what is counted by these
    moves its text once and not every run of it.
    """
    def joined(column: str, apart: int):
        """Each string with the one so many places further on."""
        rest = F.size(column) - apart
        return F.zip_with(
            F.slice(column, 1, rest), F.slice(column, apart + 1, rest), lambda a, b: F.concat(a, F.lit(" "), b)
        )

    return (
        _in_words(dealt(_minute_texts(spark, folder), *keys))
        .withColumn("twos", joined("words", 1))
        .select("toc_timestamp", "docid", F.posexplode(joined("twos", 2)).alias("pos", "quadgram"))
        .select(
            "toc_timestamp", "docid", "quadgram", F.lit(1).cast("long").alias("count"), F.col("pos").cast("long").alias("pos")
        )
    )


def ngram_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as quadgram lines: bad ids, bad counts, missing fields and empty text."""
    turns = spread_table(spark, folder, "conversations")
    number = F.col("turn") % 5
    docid = F.when(number == 1, F.lit("abc")).otherwise(F.col("conv_id").cast("string"))
    count = F.when(number == 2, F.lit("notanumber")).otherwise(F.length("text").cast("string"))
    text = F.when(number == 3, F.lit("  ")).otherwise(F.regexp_replace("text", r"\s+", " "))
    line = F.concat_ws("\t", docid, text, count)
    return turns.select(
        F.when(number == 4, F.concat_ws("\t", docid, text)).otherwise(line).alias("value"),
        F.lit("20240101000000").alias("toc_timestamp"),
        F.lit(0).cast("long").alias("pos"),
    )


def _vector_time(minutes_before: int):
    return F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 600 - minutes_before * 60)


def vector_news(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as an article added ten minutes after the one before it."""
    e = table(spark, folder, "embeddings")
    number = F.col("vec_id").cast("string")
    seen = F.date_format(_vector_time(3), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return e.select(
        F.lpad(number, 8, "0").alias("event_id"),
        F.concat(F.lit("article "), number).alias("title"),
        F.concat(F.lit("https://news.example.com/"), number).alias("url"),
        F.lit("en").alias("language"),
        seen.alias("gdelt_seen_at"),
        seen.alias("observed_at"),
        "embedding",
        _vector_time(0).alias("added_at"),
    )


def vector_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as an anomaly handled a minute before its own article came in."""
    e = table(spark, folder, "embeddings")
    return e.select(
        F.concat(F.lit("page_"), F.col("vec_id")).alias("page_title"),
        F.date_format(_vector_time(15), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("window_start"),
        F.date_format(_vector_time(0), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("window_end"),
        (F.lit(-0.01) * F.col("label")).alias("anomaly_score"),
        F.col("label").cast("long").alias("edit_count"),
        F.lit("").alias("recent_comments"),
        F.col("label").cast("long").alias("unique_editors"),
        F.col("vec_id").alias("total_byte_changes"),
        "embedding",
        _vector_time(1).alias("handled_at"),
    )


def verdict_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict topic rows from ``events``: verified, below, without candidate, old format, unreadable."""
    kind, number = F.col("event_type"), F.col("event_id")
    page = F.concat(F.lit("page_"), F.get_json_object("props", "$.k"))
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    start = F.timestamp_seconds(F.floor(second / 900) * 900)
    end = F.timestamp_seconds(F.floor(second / 900) * 900 + 900)
    iso, naive = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss"
    evaluated = F.date_format(F.timestamp_seconds(second), iso).alias("evaluated_at")
    text = number.cast("string")
    article = F.struct(
        F.concat(F.lit("article "), text).alias("title"),
        F.concat(F.lit("https://u@news"), (number % 10).cast("string"), F.lit(".example.com:8080/a?b"), text).alias("url"),
        F.lit("en").alias("language"), text.alias("event_id"),
        F.when(number % 2 == 0, F.date_format(start, iso)).alias("gdelt_seen_at"),
        F.date_format(end, iso).alias("observed_at"),
    )
    score = (F.lit(0.0) - F.lit(0.001) * (number % 100)).alias("anomaly_score")
    count = F.col("user_id").alias("edit_count")

    def message(matched, similarity, matched_article, closest):
        return F.to_json(F.struct(
            page.alias("page_title"), F.date_format(start, iso).alias("window_start"),
            F.date_format(end, iso).alias("window_end"), score, count,
            F.concat(F.lit("c"), text).alias("recent_comments"),
            F.lit(3).alias("unique_editors"), (number * 2).alias("total_byte_changes"),
            matched.alias("matched"), similarity.cast("double").alias("similarity_score"),
            F.lit(0.65).alias("similarity_threshold"),
            matched_article.alias("matched_article"), closest.alias("closest_article"), evaluated,
        ), {"ignoreNullFields": "false"})

    none = F.when(F.lit(False), article)
    old = F.to_json(F.struct(
        page.alias("page_title"), F.date_format(start, naive).alias("window_start"),
        F.date_format(end, naive).alias("window_end"), score, count,
        F.lit(True).alias("matched"), F.lit(0.7).alias("similarity_score"),
        F.struct(article["title"].alias("title"), article["url"].alias("url"), article["language"].alias("language"), article["event_id"].alias("event_id")).alias("matched_article"),
        evaluated,
    ))
    junk = F.element_at(F.array(
        F.lit('{"page_title": "cut'), F.lit("[1, 2]"), F.to_json(F.struct(page.alias("page_title")))
    ), (number % 3 + 1).cast("int"))
    value = (
        F.when(kind == "purchase", message(F.lit(True), F.lit(0.65) + (number % 35) / 100, article, article))
        .when(kind == "view", message(F.lit(False), (number % 65) / 100, none, article))
        .when(kind == "click", message(F.lit(False), F.lit(None), none, none))
        .when(kind == "signup", old)
        .otherwise(junk)
    )
    return _written(spread_table(spark, folder, "events"), value.alias("value"), number.alias("offset"))


_LIST = ", ".join("'" + c.replace("'", "''") + "'" for c in COMMENTS)
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_STRIPPED = "trim(t.title, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

SQL = {
    "edits": f"""edits AS (
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS recent_change_id,
          event_id + 1000 AS revision_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
          'page_' || json_extract_string(props, '$.k') AS page_title, CAST(0 AS BIGINT) AS namespace,
          'u' || user_id AS "user", event_type = 'error' AS bot, event_type = 'view' AS minor,
          CAST(round(value * 100) AS BIGINT) AS old_length,
          CASE WHEN event_type IN ('signup', 'error') THEN 0 ELSE 2 * CAST(round(value * 100) AS BIGINT) END AS new_length,
          CASE WHEN event_type IN ('signup', 'error') THEN -CAST(round(value * 100) AS BIGINT)
               ELSE CAST(round(value * 100) AS BIGINT) END AS byte_change,
          ([{_LIST}])[event_id % {len(COMMENTS)} + 1] AS comment, 'en.wikipedia.org' AS server_name,
          CASE WHEN event_type = 'signup' THEN 'new' ELSE 'edit' END AS event_type,
          CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS kafka_timestamp,
          date_trunc('second', ts) AS event_time
        FROM events)""",
    "sliding": """sliding AS (
        SELECT w AS window_start, page_title, count(*) AS edit_count,
          count(DISTINCT "user") AS unique_editors,
          CAST(sum(abs(byte_change)) AS BIGINT) AS total_byte_changes,
          avg(CAST(bot AS DOUBLE)) AS bot_ratio, avg(CAST(minor AS DOUBLE)) AS minor_edit_ratio,
          max(event_time) AS last_edit_time
        FROM (SELECT *, (timestamp // 300) * 300 - o AS w FROM edits, (VALUES (0), (300), (600)) s(o))
        GROUP BY w, page_title)""",
    "tumbling": """tumbling AS (
        SELECT (timestamp // 900) * 900 AS window_start, page_title, count(*) AS edit_count,
          count(DISTINCT "user") AS unique_editors,
          CAST(sum(abs(byte_change)) AS BIGINT) AS total_byte_changes,
          avg(CAST(bot AS DOUBLE)) AS bot_ratio, avg(CAST(minor AS DOUBLE)) AS minor_edit_ratio,
          sum(abs(byte_change)) / count(*) AS relative_growth,
          avg(CAST(minor AS DOUBLE)) - avg(CAST(bot AS DOUBLE)) AS human_bot_friction,
          count(DISTINCT "user") / count(*) AS editor_concentration
        FROM edits GROUP BY 1, 2)""",
    "toc": f"""toc AS (
        SELECT d.doc_id AS "ID",
          strftime(TIMESTAMP '2024-01-01' + to_minutes(d.doc_id // 10), '%Y-%m-%dT%H:%M:%S.000Z') AS "date",
          CASE WHEN d.lang = 'en' THEN '' ELSE p.url || '/i.png' END AS img, d.lang,
          d.text AS title, ' ' || p.url || '  ' AS url,
          strftime(TIMESTAMP '2024-01-01' + to_minutes(d.doc_id // 10), '%Y%m%d%H%M00') AS toc_timestamp,
          d.doc_id AS pos
        FROM documents d JOIN pages p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages))""",
    "ngrams": """ngrams AS (
        SELECT toc_timestamp, docid, i - 1 AS pos, array_to_string(words[i:i + 3], ' ') AS quadgram, 1 AS n
        FROM (SELECT strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id // 10), '%Y%m%d%H%M00') AS toc_timestamp,
                doc_id AS docid,
                list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words
              FROM documents) d, unnest(range(1, len(words) - 2)) r(i)
        WHERE len(words) >= 4)""",
    "snippets": r"""totals AS (
        SELECT toc_timestamp, docid, q, sum(n) AS total, min(pos) AS first_pos
        FROM (SELECT *, trim(quadgram, ' ' || chr(9) || chr(13) || chr(10) || '.,;:!?"''()[]{}') AS q FROM ngrams)
        WHERE q <> '' GROUP BY 1, 2, 3),
      snippets AS (
        SELECT toc_timestamp, docid, string_agg(q, ' ' ORDER BY total DESC, first_pos) AS snippet
        FROM (SELECT *, row_number() OVER (PARTITION BY docid ORDER BY total DESC, first_pos) AS rn FROM totals)
        WHERE rn <= 5 GROUP BY 1, 2)""",
    "articles": f"""articles AS (
        SELECT sha256(trim(t.url)) AS event_id, t."ID" AS toc_id, t.toc_timestamp, t."date" AS gdelt_seen_at,
          {_STRIPPED} AS title, trim(t.url) AS url, t.lang AS language, nullif(t.img, '') AS image_url,
          'gdelt_web_ngrams' AS source, 'article' AS event_type, t.pos
        FROM toc t WHERE {_STRIPPED} <> '' AND trim(t.url) <> '')""",
    "verdicts": f"""verdicts AS (
        SELECT *, CASE event_type WHEN 'signup' THEN strftime(ws, '%Y-%m-%d %H:%M:%S') ELSE strftime(ws, {_ISO}) END AS window_start,
          CASE event_type WHEN 'signup' THEN strftime(we, '%Y-%m-%d %H:%M:%S') ELSE strftime(we, {_ISO}) END AS window_end,
          event_type IN ('purchase', 'signup') AS matched,
          CASE event_type WHEN 'purchase' THEN 0.65e0 + (event_id % 35) / 100 WHEN 'view' THEN (event_id % 65) / 100
            WHEN 'signup' THEN 0.7e0 END AS similarity_score,
          strftime(date_trunc('second', ts), {_ISO}) AS evaluated_at,
          0e0 - 0.001e0 * (event_id % 100) AS anomaly_score,
          event_type <> 'click' AS has_article,
          CASE WHEN event_type <> 'signup' THEN 'c' || event_id END AS recent_comments
        FROM (SELECT *, 'page_' || json_extract_string(props, '$.k') AS page_title,
                make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900000000) AS ws,
                make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) // 900 * 900000000 + 900000000) AS we
              FROM events WHERE event_type <> 'error'))""",
    "pairs": """pairs AS (
        SELECT a.vec_id AS q, n.vec_id AS a, list_cosine_similarity(a.v, n.v) AS similarity,
          row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, n.v) DESC, n.vec_id) AS rn
        FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a
        JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) n
          ON n.vec_id * 600 <= a.vec_id * 600 - 60 AND n.vec_id * 600 >= a.vec_id * 600 - 60 - 86400)""",
}


def with_(*names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"


# Words of texts, their md5 digests, and vectors by place; weights are fitted on the articles among ``texts``.
EMBED_SQL = r"""
  digests AS (SELECT kind, id, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) AS d FROM (
    SELECT kind, id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS w FROM texts)),
  weights AS (SELECT d % 262144 AS slot, ln(((SELECT count(*) FROM texts WHERE kind = 'article') + 1) / (count(DISTINCT id) + 1)) AS weight
    FROM digests WHERE kind = 'article' GROUP BY 1),
  places AS (SELECT kind, id, (d // 262144) % 384 AS place, sum(CASE WHEN (d // 262144 // 384) % 2 = 0 THEN 1 ELSE -1 END
      * coalesce(weight, ln((SELECT count(*) FROM texts WHERE kind = 'article') + 1))) AS v
    FROM digests LEFT JOIN weights ON slot = d % 262144 GROUP BY 1, 2, 3),
  scaled AS (SELECT kind, id, place, v / length AS v FROM places JOIN (
    SELECT kind, id, sqrt(sum(v * v)) AS length FROM places GROUP BY 1, 2) USING (kind, id) WHERE length > 0),
  vectors AS (SELECT kind, id, list_transform(range(384), lambda i: CAST(coalesce(m[i], 0) AS FLOAT)) AS v FROM (
    SELECT kind, id, map(list(place), list(v)) AS m FROM scaled GROUP BY 1, 2))
"""

"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from burstwatch.llm import (
    bpe, chat, contamination, exactdup, jaccard, language, pseudonyms, quality, repair, resampling, toxicity, unigram,
    urlrules,
)
from burstwatch.llm.shared import fold_of, stored

Query = Callable[[SparkSession, str], DataFrame]
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
UNIGRAM_FILE = public_tokenizers.path("piece_bpe_32k.model")
#: A key for the tables here; a user passes a secret one.
PSEUDONYM_KEY = "key of the test tables"
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.fit(docs, fold_of(F.col("doc_id"), 4) != 2)
    found = language.identify(docs, model, reject=False)
    return found.select(
        "doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


_JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM worded),
one AS (SELECT unnest(s) AS g, doc_id FROM sets),
-- two linked sets share one of the first n - ceil(0.85 n) + 1 shingles of either, in any one order
ranked AS (SELECT g, doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY md5(g)) AS r FROM one),
head AS (
  SELECT g, doc_id, len(s) AS n FROM ranked JOIN sets USING (doc_id) WHERE r <= len(s) - (85 * len(s) + 99) // 100 + 1),
maybe AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM head a JOIN head b USING (g)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
shared AS (
  SELECT a, b, len(list_intersect(x.s, y.s)) AS i, len(x.s) AS m, len(y.s) AS n
  FROM maybe JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b),
links AS (SELECT a, b FROM shared WHERE 100 * i >= 85 * (m + n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS start, doc_id AS node FROM sets
  UNION SELECT start, b FROM reach JOIN both_ways ON a = node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT start, min(node) AS component_id FROM reach GROUP BY start) r ON r.start = s.doc_id
"""


@query(_JACCARD_SQL)
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"), width=4, percent=85)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table with conversation -1, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


_BROKEN = r"replace(coalesce({0}, ''), '\', '\\')"
for _control in ("</s>", "<s>", "[/INST]", "[INST]", "[/ROLE]", "[ROLE]"):
    _BROKEN = f"replace({_BROKEN}, '{_control}', '{_control[0]}\\{_control[1:]}')"
_CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
formatted AS (SELECT *, CASE role WHEN 'user' THEN '<s>[INST] ' || {_BROKEN.format('text')} || ' [/INST]</s>'
  WHEN 'assistant' THEN '<s>' || {_BROKEN.format('text')} || '</s>'
  ELSE '<s>[ROLE]' || {_BROKEN.format('role')} || '[/ROLE]' || {_BROKEN.format('text')} || '</s>' END AS f FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(f)) AS BIGINT) AS formatted_chars, CAST(NULL AS BIGINT) AS rewritten_at
FROM formatted GROUP BY conv_id
"""


@query(_CHAT_SQL)
def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_probe(_table(spark, folder, "conversations"))
    return chat.digests(chat.format_conversations(rows))


@query()
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counted = stored(quality.counted(docs).select("doc_id", "counts"), "counts")
    return quality.judged(counted, quality.fit(counted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept"
    )


def token_digests(documents: DataFrame) -> DataFrame:
    # stored, as encoding and decoding in one stage would take two Python workers a core
    encoded = stored(bpe.encode(documents.select("doc_id", "text"), BPE_FILE).select("doc_id", "ids"), "encoded")
    return bpe.decode(encoded, BPE_FILE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op5_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(_table(spark, folder, "documents"))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, fold_of(F.col("doc"), 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_terms"
    )


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.count_tokens(_table(spark, folder, "documents"), UNIGRAM_FILE)


_LEAKS_SQL = r"""
WITH worded AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM worded),
shingles AS (
  SELECT kind, id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g
  FROM words),
items AS (SELECT id AS item_id, g, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i')
SELECT id AS doc_id, item_id, n_item, count(*) AS n_shared
FROM items JOIN (SELECT id, g FROM shingles WHERE kind = 'd') USING (g)
GROUP BY id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""


@query(_LEAKS_SQL)
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contained_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


_URL_SQL = r"""
WITH parsed AS (
  SELECT page_id, url, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
ruled AS (
  SELECT page_id, url, coalesce(host, '') AS host, coalesce(path, '') AS path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parsed),
given AS (SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
  WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END AS given FROM ruled),
cut AS (SELECT *, list_reverse(string_split(host, '.')) AS l, list_filter(string_split(path, '/'), lambda p: p <> '') AS p,
  list_filter(list_transform(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
    lambda x: string_split(x, '=')[1]), lambda x: x <> '') AS q FROM given),
tokened AS (SELECT page_id, host, path, rule, given, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(
  list_transform(l, lambda x, i: 'h' || (i - 1) || ':' || x) || CASE WHEN len(l) > 3 THEN ['h:' || l[-1]] ELSE [] END
  || list_transform(p, lambda x, i: 'p' || (i - 1) || ':' || regexp_replace(x, '[0-9]+', '0', 'g'))
  || list_transform(q, lambda x: 'q:' || x) || CASE WHEN contains(url, '#') THEN ['#'] ELSE [] END)) END AS w FROM cut),
total AS (SELECT count(*) AS total FROM tokened WHERE given IS NOT NULL),
frequent AS (SELECT token FROM (SELECT unnest(w) AS token FROM tokened WHERE given IS NOT NULL), total
  GROUP BY token, total HAVING count(*) >= ceil(0.01 * total)),
known AS (SELECT coalesce(list_sort(list(token)), []) AS all_frequent FROM frequent),
worded AS (SELECT page_id, host, path, rule, given, list_filter(w, lambda x: list_contains(all_frequent, x)) AS t
  FROM tokened, known),
sets AS (SELECT t, given, count(*) AS n FROM worded GROUP BY t, given),
labelled AS (SELECT * FROM sets WHERE given IS NOT NULL),
combos AS (
  SELECT list_filter(t, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items, given, n
  FROM (SELECT t, given, n, unnest(range(1, 1 << len(t))) AS mask FROM labelled)),
counted AS (
  SELECT items, sum(n) AS n, sum(n) FILTER (given = 'block') AS block, sum(n) FILTER (given = 'allow') AS allow
  FROM combos GROUP BY items),
verdicts AS (
  SELECT items, 'block' AS verdict, block AS hits, n FROM counted UNION ALL SELECT items, 'allow', allow, n FROM counted),
mined AS (
  SELECT items, verdict, hits / n AS confidence, hits AS support FROM verdicts, total
  WHERE hits >= ceil(0.01 * total) AND hits / n >= 0.9),
ranked AS (
  SELECT t, verdict, row_number() OVER (PARTITION BY t ORDER BY confidence DESC, support DESC, verdict) AS r
  FROM (SELECT DISTINCT t FROM sets WHERE given IS NULL) JOIN mined ON list_has_all(t, items))
SELECT page_id, host, path, rule, coalesce(given, verdict, 'allow') AS verdict
FROM worded LEFT JOIN (SELECT t, verdict FROM ranked WHERE r = 1) USING (t)
"""


@query(_URL_SQL)
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlrules.judge(pages, URL_RULES).drop("url")


@query()
def op10_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, kinds="kinds")
    return found.select("doc_id", "text", "kinds", F.size("kinds").cast("long").alias("n_pseudonyms"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of conversation and turn; ``dropped`` ones are marked."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"))
    times = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return rows.select(
        "conv_id", "turn", (F.col("kind") == 0).alias("dropped"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


# A checksum table, and the checksum of a list of bytes under the table ``t``.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = "xor(list_reduce(list_concat([4294967295], {0}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _least(*options: str) -> str:
    return "list_min([" + ", ".join(options) + "])"


def _then(value: str, cost: str, letters: str) -> str:
    return f"{{'c': {value}.c + {cost}, 'a': '{letters}' || {value}.a}}"


# Values v0 to v3 of the rest by what came last (nothing, system, user, assistant); b0 to b3 before insertions.
_BEFORE_ROW = ", ".join(
    _least(_then(f"v{g}", "3", "D"), *(
        f"CASE WHEN fault < 2 AND initial = '{i}' THEN {_then(f'v{to}', 'fault', 'K')} END" for i, to in kept
    ), f"CASE WHEN fault < 2 THEN {_then(f'v{changed}', '2 + fault', 'R')} END") + f" AS b{g}"
    for g, (kept, changed) in enumerate([([("s", 1), ("u", 2)], 2), ([("u", 2)], 2), ([("a", 3)], 3), ([("u", 2)], 2)])
)
_WITH_INSERTIONS = ", ".join([
    _least("b0", _then("b2", "2", "I"), _then("b3", "4", "II")) + " AS v0",
    _least("b1", _then("b2", "2", "I"), _then("b3", "4", "II")) + " AS v1",
    _least("b2", _then("b3", "2", "I")) + " AS v2", _least("b3", _then("b2", "2", "I")) + " AS v3",
])
_REPAIR_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT *, {_CRC.format("list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))")} % 20 AS kind
  FROM keyed, {_CRC_TABLE}),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS whole FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM placed),
faults AS (
  SELECT *, CASE WHEN whole = '' THEN 3 WHEN nth > 1 THEN 2 WHEN right(whole, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial, 'su') AS pair FROM seen),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv_id),
ends AS (SELECT {{'c': 0, 'a': ''}} AS b0, {{'c': 1000000, 'a': ''}} AS b1, {{'c': 1000000, 'a': ''}} AS b2, {{'c': 0, 'a': ''}} AS b3),
solved AS (
  SELECT conv_id, n + 1 AS pos, {_WITH_INSERTIONS} FROM counts, ends
  UNION ALL
  SELECT conv_id, pos, {_WITH_INSERTIONS} FROM (
    SELECT s.conv_id, f.pos, {_BEFORE_ROW} FROM solved s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.pos - 1)),
answers AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM solved WHERE pos = 1),
letters AS (
  SELECT conv_id, i, audit[i] AS letter,
    length(regexp_replace(audit[1:i], '[^KRD]', '', 'g')) AS pos FROM answers, unnest(range(1, length(audit) + 1)) u(i)),
-- kept rows fix the states; a rerolled or inserted row's role follows from how many u and a rows came before
rows AS (
  SELECT l.conv_id, l.i, l.letter, f.role, f.text, f.initial,
    count(*) FILTER (NOT (letter = 'K' AND f.initial = 's')) OVER (PARTITION BY l.conv_id ORDER BY l.i) AS nth
  FROM letters l LEFT JOIN faults f ON l.letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos
  WHERE l.letter <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS t FROM rows GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN answers a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(_table(spark, folder, "conversations"))
    found = stored(repair.verdicts(rows, absent=F.col("dropped")), "verdicts")
    hashed = repair.digests(repair.repaired(rows, found, absent=F.col("dropped"))).withColumnRenamed("conv_id", "of")
    return found.join(hashed, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
    )


_COPIES_SQL = """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""


@query(_COPIES_SQL)
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select(
        "doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )
    return exactdup.classes(docs, columns=["text_sha256"])


_RESAMPLING_SQL = rf"""
WITH words AS (
  SELECT kind, row_nr, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 'd' AS kind, row_number() OVER () AS row_nr, doc_id, text FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark)),
bytes AS (SELECT w, list_transform(range(length(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT)) AS b
  FROM (SELECT w, hex(w) AS h FROM (SELECT DISTINCT w FROM words))),
buckets AS (SELECT w, {_CRC.format("b")} % 10000 AS bucket FROM bytes, {_CRC_TABLE}),
counted AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
    / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counted),
weighed AS (
  SELECT row_nr, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row_nr),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 *
    ln(-ln((CAST(('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8)) AS BIGINT) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
  FROM (SELECT doc_id, row_number() OVER () AS row_nr FROM documents) LEFT JOIN weighed USING (row_nr)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS r,
    count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= drawn THEN r END AS rank FROM ranked
"""


@query(_RESAMPLING_SQL)
def op13_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return resampling.resample(docs, target).drop("n_words")

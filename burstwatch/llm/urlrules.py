"""URL filtering by association rules.

Native: DataFrame functions and Spark ML's FP-growth. Given rules (host and path) decide the
urls they fit. Those decisions are the labels from which FP-growth mines combinations of url
tokens that go with one verdict; combinations below a support or confidence are pruned. A url
that no given rule fits takes the verdict of its best mined rule, found through an inverted
index: each mined rule is listed under its rarest token, urls are looked up by their tokens,
and a hit counts if the url has all of the rule's tokens.

Nothing but the support bounds the rules: a url has as many tokens as it has parts, a rule as many
as go together. Tokens of exactly the same labelled urls are one item, as no rule can tell them apart;
so a long url that fills a share of the table adds one item and not all subsets of its tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from burstwatch.llm.shared import fresh, stored

#: (verdict, host and path): fits the host and its subdomains if the path starts with the rule's.
Rule = tuple[str, str]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
VERDICTS = ("allow", "block")
_MARK = "="
#: Parts that rows of one item set are dealt over when they meet their verdict.
SALTS = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def given_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r)):  # the last one tried wins
        own, _, below = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + below)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """All distinct tokens: host labels counted from the end, the first label of a host of more than three,
    path parts with digits written as 0, names in the query, and whether there is a fragment."""
    labels = F.reverse(F.split(host, r"\."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, "^[^=]*", 0)), lambda q: q != "")
    found = F.concat(
        F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x)),
        F.when(F.size(labels) > 3, F.array(F.concat(F.lit("h:"), F.get(labels, F.size(labels) - 1)))).otherwise(F.array()),
        F.transform(parts, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), F.regexp_replace(x, "[0-9]+", "0"))),
        F.transform(names, lambda q: F.concat(F.lit("q:"), q)),
        F.when(F.locate("#", url) > 0, F.array(F.lit("#"))).otherwise(F.array()),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def items_of_tokens(labelled: DataFrame, min_support: float) -> DataFrame:
    """``token, item`` of the tokens in at least ``min_support`` of the labelled rows.

    Tokens of the same rows have the same item, the first of them in text order. Rows are told by two
    hashes of their tokens and verdict. There are at most (mean number of tokens) / ``min_support`` tokens.
    """
    counted = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    total = labelled.agg(F.count("*").alias("total"))
    each = counted.select(
        F.explode("tokens").alias("token"), "n", F.xxhash64("tokens", "verdict").alias("x"),
        F.xxhash64(F.lit(1), "verdict", "tokens").alias("y"),
    )
    held = each.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    held = held.join(F.broadcast(total)).where(F.col("n") >= F.ceil(F.lit(min_support) * F.col("total")))
    return held.select("token", F.min("token").over(Window.partitionBy("n", "x", "y")).alias("item"))


def mined_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """``items, verdict, confidence, support`` of the rules that FP-growth finds in ``tokens, verdict``.

    Support and confidence are shares of the labelled rows; rules may have any number of items.
    """
    empty = "items array<string>, verdict string, confidence double, support double"
    if labelled.isEmpty():
        return labelled.sparkSession.createDataFrame([], empty)
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(_MARK), F.col("verdict"))).alias("items"))
    model = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    marks = F.array(*(F.lit(_MARK + v) for v in VERDICTS))
    rules = model.associationRules.where(F.array_contains(marks, F.col("consequent")[0]))
    rules = rules.where(~F.arrays_overlap("antecedent", marks))
    return rules.select(
        F.array_sort("antecedent").alias("items"), F.substring(F.col("consequent")[0], 2, 1000).alias("verdict"),
        "confidence", "support",
    )


def judge(
    pages: DataFrame, rules: list[Rule], url: str = "url", min_support: float = 0.01, min_confidence: float = 0.9,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; older columns of these names are replaced.

    Among mined rules that fit, the most confident wins, then the one of more support, then
    one that allows; a url that none fits takes ``default``, as does a null
    url or one without ``://`` (host and path empty, rule null). Repeated urls are looked up
    once and judged alike; an empty table gives an empty result.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    columns = pages.columns
    host, path = host_and_path(F.col(url))
    parsed = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    own, given = fresh("tokens", parsed.columns), fresh("given", parsed.columns)
    parsed = parsed.withColumn("rule", rule).withColumn(given, verdict)
    parsed = parsed.withColumn(own, tokens(F.col(url), F.col("host"), F.col("path")))
    labelled = parsed.where(F.col(given).isNotNull()).select(F.col(own).alias("tokens"), F.col(given).alias("verdict"))
    named = stored(items_of_tokens(labelled, min_support), "items")

    # One row with all frequent tokens, whose number the support bounds.
    pairs = F.map_from_entries(F.collect_list(F.struct("token", "item")))
    book = fresh("book", parsed.columns)
    one = F.broadcast(named.agg(pairs.alias(book)))

    def with_items(rows: DataFrame, column: str) -> DataFrame:
        known = F.array_compact(F.transform(column, lambda t: F.col(book)[t]))
        return rows.join(one).withColumn(column, F.array_sort(F.array_distinct(known))).drop(book)

    mined = stored(mined_rules(with_items(labelled, "tokens"), min_support, min_confidence), "rules")
    counts = mined.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    listed = mined.withColumn("token", F.explode("items")).join(counts, "token")
    index = listed.groupBy("items", "verdict", "confidence", "support").agg(
        F.min(F.struct("n", "token")).alias("rarest")
    ).select(F.col("rarest.token").alias("token"), "items", "verdict", "confidence", "support")
    parsed = with_items(parsed, own)
    open_sets = parsed.where(F.col(given).isNull()).select(F.col(own).alias("tokens")).distinct()
    asked = open_sets.withColumn("token", F.explode("tokens"))
    fits = F.size(F.array_intersect("items", "tokens")) == F.size("items")
    best = asked.join(index, "token").where(fits).groupBy("tokens").agg(F.min(F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "verdict",
    )).alias("best")).select(
        F.col("tokens").alias("key"), F.col("best.verdict").alias("mined"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    # Many urls have the same items: they are dealt by the partition they were read in.
    part = fresh("part", parsed.columns)
    parsed = parsed.withColumn(part, F.spark_partition_id() % SALTS)
    same = (F.col(f"p.{own}") == F.col("m.key")) & (F.col(f"p.{part}") == F.col("m.salt")) & F.col(f"p.{given}").isNull()
    joined = parsed.alias("p").join(best.alias("m"), same, "left")
    verdict = F.coalesce(f"p.{given}", "m.mined", F.lit(default))
    return joined.select(*(F.col(f"p.`{c}`") for c in [*columns, "host", "path", "rule"]), verdict.alias("verdict"))

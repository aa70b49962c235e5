"""File readers: history, lakes, and the news feed's minute files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from burstwatch.functions.text import strip
from burstwatch.schemas import EDIT_LAKE_SCHEMA, HISTORY_SCHEMA, TOC_SCHEMA
from burstwatch.sources.decode import is_object, once


def decode_history(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Loose history records out of JSON lines.

    Blank lines and JSON that is not an object are skipped. With ``strict`` a
    malformed line fails the job at run time, naming the text (and the file when
    the lines carry one): the check rides along in the single pass over the data.
    """
    text = F.col("value")
    malformed = F.try_parse_json(text).isNull()
    if strict:
        where = F.col("file") if "file" in lines.columns else F.lit("history")
        message = F.concat(F.lit("Invalid JSON in "), where, F.lit(": "), text)
        usable = F.when(malformed, F.raise_error(message).cast("boolean")).otherwise(
            strip(text).startswith("{")
        )
    else:
        usable = is_object(text)
    return (
        lines.filter(strip(text) != "")
        .filter(usable)
        .select(F.from_json(text, HISTORY_SCHEMA).alias("record"))
        .select("record.*")
    )


def read_history(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """History from JSON lines, plain or gzipped; no record at all is an error."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    records = decode_history(lines, strict)
    if records.isEmpty():
        raise ValueError(f"No records found in {path}")
    return records


def read_feature_lake(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Every Parquet file below ``path``, columns matched by name.

    Merging schemas reads all footers (as a Spark job); pass ``schema`` to skip it.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise FileNotFoundError(f"No feature lake parquet files found in {path}.") from error
        raise


def read_edit_lake(
    spark: SparkSession, path: str, schema: StructType | str = EDIT_LAKE_SCHEMA
) -> DataFrame:
    """The archived edits with ``event_time``; null flags read false, null byte change 0.

    Empty part files (left by a killed writer) hold no rows and are passed over:
    the given schema spares Spark from opening footers to infer one.
    """
    return (
        spark.read.schema(schema).parquet(path)
        .withColumn("event_time", F.timestamp_seconds("timestamp"))
        .withColumn("bot", F.coalesce("bot", F.lit(False)))
        .withColumn("minor", F.coalesce("minor", F.lit(False)))
        .withColumn("byte_change", F.coalesce("byte_change", F.lit(0)))
    )


# A minute's name in a path: the last fourteen digits between separators.
MINUTE_NAME = r"^.*[/=](\d{14})[./]"


def _lines(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.regexp_extract(F.col("_metadata.file_path"), MINUTE_NAME, 1).alias("toc_timestamp"),
        # Gzip files are not split, so ids rise with the line order of a file.
        F.monotonically_increasing_id().alias("pos"),
    )


def minute_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``value, toc_timestamp, pos`` of the lines of the named files; no name gives no line."""
    if not paths:
        return spark.createDataFrame([], "value string, toc_timestamp string, pos bigint")
    return _lines(spark.read.text(list(paths)))


def _minute_files(spark: SparkSession, path: str, suffix: str, minutes: Sequence[str] | None):
    names = "*" if minutes is None else "{" + ",".join(sorted(minutes)) + "}"
    return _lines(spark.read.option("pathGlobFilter", names + suffix).text(path))


def decode_toc(lines: DataFrame, keep: Sequence[str] = ("toc_timestamp", "pos")) -> DataFrame:
    """Article entries out of JSON lines; blank, malformed and non-object lines are skipped."""
    return (
        lines.filter(is_object(F.col("value")))
        .select(once(F.from_json("value", TOC_SCHEMA)), *keep)
    )


def read_toc(spark: SparkSession, path: str, minutes: Sequence[str] | None = None) -> DataFrame:
    """Article entries of the ``.toc.json.gz`` files; minutes not published yet have no rows."""
    return decode_toc(_minute_files(spark, path, ".toc.json.gz", minutes))


def decode_ngrams(lines: DataFrame, keep: Sequence[str] = ("toc_timestamp", "pos")) -> DataFrame:
    """``docid, quadgram, count`` out of tab-separated lines; unreadable lines are skipped.

    Line ends are white space, which the count is stripped of.
    """
    return (
        lines.select(once(F.struct(F.split("value", "\t", -1).alias("f"))), *keep)
        .filter(F.size("f") == 3)
        .select(
            once(F.struct(
                _integer(F.get("f", F.lit(0))).alias("docid"),
                strip(F.get("f", F.lit(1))).alias("quadgram"),
                _integer(F.get("f", F.lit(2))).alias("count"),
            )),
            *keep,
        )
        .filter("docid IS NOT NULL AND `count` IS NOT NULL AND quadgram <> ''")
    )


def _integer(text):
    # most are digits and nothing else, which costs less than to strip them
    digits, number = strip(text), r"^[+-]?\d+\z"
    return F.when(text.rlike(number), text.try_cast("long")).when(digits.rlike(number), digits.try_cast("long"))


def read_ngrams(spark: SparkSession, path: str, minutes: Sequence[str] | None = None) -> DataFrame:
    """Quadgram counts of the ``.ngrams.txt.gz`` files."""
    return decode_ngrams(_minute_files(spark, path, ".ngrams.txt.gz", minutes))

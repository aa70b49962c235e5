"""From raw documents to token digests in five stages, each on all that the one before kept.

Every stage but the last returns the columns of documents as they came, whatever further ones there
are and whatever their names. Repeated rows and ids are rows of their own, a null id is an id, and an
empty table gives an empty result in all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from burstwatch.llm import contamination, jaccard, pseudonyms, quality
from burstwatch.llm.queries import PSEUDONYM_KEY, token_digests
from burstwatch.llm.shared import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the weighed votes reject.

    Null, empty and one-word texts fail the base rules and go; equal rows are judged alike.
    """
    return quality.keep_good(docs)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles, similarity 0.8.

    The smallest id stays (null only where a group has no other); of rows with that id and the same
    shingles any one. Texts without words are like nothing, so all of them stay.
    """
    return jaccard.keep_one(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item: 80 % of its five-word shingles.

    Rows of one id are one text, so they go or stay together. Null, empty and wordless texts and
    items neither hold nor are held.
    """
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by pseudonyms, equal values by equal ones in all rows; a null text stays null."""
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, one row a document; a null text counts as empty."""
    return token_digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("tokens", token_stage),
]

#: The EM model and the BPE merges cannot be put in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written to the shared scratch folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Small helpers that several operators use."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from burstwatch.session import scratch_dir, ship_package

#: What separates words: the space and the five ASCII controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back: cuts lineage, survives lost executors."""
    path = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def with_workers(rows: DataFrame) -> DataFrame:
    """Make sure that Python workers can import this package, also when a caller owns the session."""
    ship_package(rows.sparkSession)
    return rows


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def fold_of(doc_id: Column, folds: int) -> Column:
    """The crc32 of an id's decimal digits modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(prefix: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` has."""
    name = prefix
    while name.lower() in {t.lower() for t in taken}:
        name = f"{prefix}_{uuid.uuid4().hex[:6]}"
    return name


#: log2 of the bits of an array that goes to the tasks (2 MB).
BITS = 24


def bit_array(rows: DataFrame, column: str) -> bytes:
    """An array of fixed size with the bit set that the highest bits of each 64-bit hash name.

    Its bytes are put together on the executors; however many hashes there are, the driver
    gets at most 2**21 of them, in one job. A full array only lets more rows pass.
    """
    at = F.expr(f"shiftrightunsigned({column}, {64 - BITS})")
    found = rows.select(at.alias("at")).groupBy(F.shiftright("at", 3).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(at & 7 as int))")).alias("bits")
    )
    array = np.zeros(1 << (BITS - 3), np.uint8)
    table = found.toArrow()
    array[table["byte"].to_numpy()] = table["bits"].to_numpy().astype(np.uint8)
    return array.tobytes()

"""Estimated distinct addresses from sketches that merge.

A HyperLogLog sketch of each asset and day takes some kilobytes whatever the number of
addresses. Sketches of any days unite, so a range that nobody planned for is answered from the
stored sketches, without reading a transfer. A sketch is built on the map side from both columns
of a transfer; no address is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log, sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.rollups import DAILY_KEYS

SIZE = 12  # 2^12 registers


def standard_error(size: int = SIZE) -> float:
    """Relative standard deviation of an estimate after a union."""
    return sqrt(log(2)) / sqrt(2**size)


def address_sketches(
    transfers: DataFrame, by: Sequence[str] = DAILY_KEYS, size: int = SIZE
) -> DataFrame:
    """``by, addresses``: a sketch of the addresses on both sides, lower-cased."""
    sides = [F.hll_sketch_agg(F.lower(side), size).alias(f"_{side}") for side in ("from", "to")]
    return transfers.groupBy(*by).agg(*sides).select(
        *by, F.hll_union("_from", "_to").alias("addresses")
    )


def unite_sketches(sketches: DataFrame, by: Sequence[str] = ("asset",)) -> DataFrame:
    """Sketches of more general groups from those of finer ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("addresses").alias("addresses"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The estimated number of addresses in place of the sketch."""
    return sketches.withColumn("estimated_addresses", F.hll_sketch_estimate("addresses")).drop("addresses")


def write_sketches(sketches: DataFrame, path: str) -> None:
    """By date; dates in the input are replaced, so a day that is computed anew stays one row."""
    rows = sketches.hint("rebalance", "date").sortWithinPartitions("date", "asset")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_sketches(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Stored sketches of an inclusive range of dates, by partition filter."""
    rows = spark.read.schema("asset string, addresses binary, date date").parquet(path)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("date") <= F.lit(last).cast("date"))
    return rows

"""Tables that hand one step over to the next, and order that needs no single task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import working_folder


class WorkTables:
    """A new folder below the shared one; what is stored there survives a lost executor."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = working_folder(spark, purpose)

    def store(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.parquet(path)
        return self.spark.read.parquet(path)


def wide(spark: SparkSession, factor: int = 1) -> int:
    """A number of partitions that grows with what the session is sized for."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


def order_bounds(rows: DataFrame, key: str, parts: int) -> tuple[list[int], int]:
    """Inner bounds of about equal parts of a whole-number column, and the parts of its nulls.

    A key with several parts' worth of rows comes as often as it has bounds. Reads that one
    column; what comes to the driver is at most ``parts`` numbers.
    """
    if parts < 2 or key not in rows.columns:
        return [], 0
    low, high, known, total = rows.agg(F.min(key), F.max(key), F.count(key), F.count("*")).first()
    nulls = math.ceil(parts * (total - known) / total) if total else 0
    if low is None or parts - nulls < 1:
        return [], nulls
    inner = parts - nulls if nulls else parts - 1
    shares = [i / (inner + 1) for i in range(1, inner + 1)]
    cuts = rows.agg(F.percentile_approx(key, F.lit(shares).cast("array<double>"), 10000)).first()[0]
    bounds = sorted(int(c) for c in cuts if low <= int(c) <= high)
    # the least key is in part 0 without a bound
    return bounds[1:] if bounds and bounds[0] == low else bounds, nulls


def part_of(key: Column, bounds: tuple[list[int], int], then: Column) -> Column:
    """The part a row falls into, ascending in key (nulls first) and ``then``, a 64-bit hash.

    Rows of a key that comes several times among the bounds, and those without a key, are
    divided by ``then``, so that no key is one part. Rows alike in both stay together.
    """
    inner, nulls = bounds
    first = max(nulls - 1, 0)
    place = then.cast("double") / F.lit(float(1 << 64)) + F.lit(0.5)

    def spread(parts: Column) -> Column:
        return F.least(F.floor(place * parts), parts - 1).cast("int")

    none = spread(F.lit(nulls)) if nulls > 1 else F.lit(0)
    if not inner:
        return F.when(key.isNull(), none).otherwise(F.lit(first))
    cuts = F.array(*[F.lit(b).cast("long") for b in inner])
    # the bounds are few (one for each part), so a scan of them is cheap
    upto = F.size(F.filter(cuts, lambda c: c <= key))
    several = sorted({b for b, c in zip(inner, inner[1:]) if b == c})
    if several:
        same = F.size(F.filter(cuts, lambda c: c == key))
        upto = F.when(key.isin(several), upto - same + 1 + spread(same)).otherwise(upto)
    return F.when(key.isNull(), none).otherwise(upto + F.lit(first))

"""Exact distinct counts from bitmaps over dense numbers.

Every transaction and every address gets a number, without holes, once. A day then is a few
bitmaps of 32,768 numbers each: transactions are numbered in chain order, so those of a day lie
together. Bitmaps of any days are united bit by bit, and a distinct count is a count of bits:
exact figures of any range come from the stored daily bitmaps, with neither transfers nor hashes
read or shuffled. New keys are numbered behind the old ones, so what is stored stays valid.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.rollups import DAILY_KEYS, stats_columns

# a reader takes up to 4,096 rows of a row group at once, each with bitmaps of 4 KB
_ROW_GROUP = 4 << 20
_ROW_BITS = 33  # of monotonically_increasing_id are the row within its partition
_LOT_BITS = 6  # buckets of a group that are made in one task: 64, of 2 million numbers


@dataclass(frozen=True)
class BitmapTables:
    """Folders of numbers and daily bitmaps, all below ``root``."""

    root: str

    def numbers(self, kind: str) -> str:
        return f"{self.root}/numbers/{kind}"

    def days(self, kind: str) -> str:
        return f"{self.root}/days/{kind}"


def _numbered(keys: DataFrame, path: str, first: int) -> None:
    """Stores ``key, number`` for the rows of ``key, place``, in the order of place and key.

    Keys are dealt out by ranges and sorted there; a row's number is its place in its range plus
    the sizes of the ranges before, of which the driver gets one number each.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, "place", "key").sortWithinPartitions("place", "key")
    placed = f"{path}/placed"
    ordered.select("key", F.monotonically_increasing_id().alias("id")).write.mode("overwrite").parquet(placed)
    rows = spark.read.schema("key string, id long").parquet(placed)
    part = F.shiftright("id", _ROW_BITS)
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = spark.createDataFrame(
        [(p, first + b) for (p, _), b in zip(sizes, before)], "part long, start long"
    )
    number = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    found = rows.withColumn("part", part).join(F.broadcast(starts), "part")
    found.select("key", number.alias("number")).write.mode("overwrite").parquet(f"{path}/from={first}")


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, number long, `from` long").parquet(path).select("key", "number")


def add_numbers(keys: DataFrame, path: str) -> DataFrame:
    """Numbers the keys of ``key, place`` that have none yet; returns ``key, number`` of all.

    A key counts once, at its first place. Nulls have no number.
    """
    from ledgerline.sinks.folders import partition_folders, remove_folder

    spark = keys.sparkSession
    once = keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("place").alias("place"))
    first = 0
    # a folder is named by its first number
    stored = partition_folders(spark, path, "from")
    if stored:
        known = read_numbers(spark, path)
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        once = once.join(known.select("key"), "key", "left_anti")
    _numbered(once, path, first)
    remove_folder(spark, f"{path}/placed")
    return read_numbers(spark, path)


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"bucket": F.bitmap_bucket_number("number"), "bit": F.bitmap_bit_position("number")}
    ).drop("number")


def _gathered(rows: DataFrame, by: Sequence[str]):
    """Rows in groups of ``by, bucket``, each brought together before its bitmap is made.

    A number moves in a few bytes. Bitmaps made where the rows lie and united later would move in
    4 KB each, most of them with one bit where a group's numbers lie far apart.
    """
    lots = rows.withColumn("_lot", F.shiftright("bucket", _LOT_BITS))
    return lots.repartition(*by, "_lot").groupBy(*by, "_lot", "bucket")


def transaction_bitmaps(
    transfers: DataFrame, numbers: DataFrame, by: Sequence[str] = DAILY_KEYS
) -> DataFrame:
    """``by, bucket`` with bitmaps of all, DeFi and rollup transactions, volume and transfers.

    Transfers are folded by transaction before they meet its number. A missing transaction counts
    as one; it has bucket -1 and no bitmaps.
    """
    per_tx = transfers.groupBy(*by, "tx_hash").agg(
        F.sum("amount").alias("volume"),
        F.count("*").alias("transfers"),
        F.bool_or("is_defi_transaction").alias("defi"),
        F.bool_or("is_rollup_transaction").alias("rollup"),
    )
    numbered = per_tx.join(numbers.withColumnRenamed("key", "tx_hash"), "tx_hash", "left")
    rows = _bucketed(numbered).withColumn("bucket", F.coalesce("bucket", F.lit(-1).cast("long")))
    lost = F.col("bit").isNull()
    return _gathered(rows, by).agg(
        F.bitmap_construct_agg("bit").alias("all"),
        F.bitmap_construct_agg(F.when(F.col("defi"), F.col("bit"))).alias("defi"),
        F.bitmap_construct_agg(F.when(F.col("rollup"), F.col("bit"))).alias("rollup"),
        F.sum("volume").alias("volume"),
        F.sum("transfers").alias("transfers"),
        F.bool_or(lost).alias("lost"),
        F.bool_or(lost & F.coalesce("defi", F.lit(False))).alias("lost_defi"),
        F.bool_or(lost & F.coalesce("rollup", F.lit(False))).alias("lost_rollup"),
    ).drop("_lot")


def address_bitmaps(
    transfers: DataFrame, numbers: DataFrame, by: Sequence[str] = DAILY_KEYS
) -> DataFrame:
    """``by, bucket`` with a bitmap of the addresses on both sides, lower-cased."""
    parties = transfers.select(*by, F.explode(F.array(F.lower("from"), F.lower("to"))).alias("key"))
    rows = _bucketed(parties.where(F.col("key").isNotNull()).distinct().join(numbers, "key"))
    return _gathered(rows, by).agg(F.bitmap_construct_agg("bit").alias("all")).drop("_lot")


def store_days(
    transfers: DataFrame, tables: BitmapTables, place: str = "block_number", period: str = "day"
) -> None:
    """Numbers what is new in ``transfers`` and stores the bitmaps of its dates.

    A folder holds the dates of a ``period`` (day, month or year; longer ones for ledgers with
    few rows a day). ``transfers`` must hold its periods whole, as a stored ledger does: they are
    replaced.
    """
    begins = F.col("date") if period == "day" else F.trunc("date", period)
    tx = add_numbers(
        transfers.select(F.col("tx_hash").alias("key"), F.col(place).alias("place")), tables.numbers("tx")
    )
    sides = F.explode(F.array(F.lower("from"), F.lower("to"))).alias("key")
    parties = add_numbers(transfers.select(sides, F.col(place).alias("place")), tables.numbers("address"))
    # groups come in the order of period, asset, date and bucket; bitmaps are not sorted again
    dated, by = transfers.withColumn("period", begins), ("period", *DAILY_KEYS)
    made = {"tx": transaction_bitmaps(dated, tx, by), "address": address_bitmaps(dated, parties, by)}
    for kind, rows in made.items():
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("parquet.block.size", _ROW_GROUP).partitionBy("period").parquet(tables.days(kind))
        )


_TX_DAYS = (
    "asset string, bucket long, all binary, defi binary, rollup binary, volume double, "
    "transfers long, lost boolean, lost_defi boolean, lost_rollup boolean, date date, period date"
)


def read_days(spark: SparkSession, tables: BitmapTables) -> tuple[DataFrame, DataFrame]:
    """Stored daily bitmaps of transactions and of addresses; filter both by date for a range."""
    return (
        spark.read.schema(_TX_DAYS).parquet(tables.days("tx")),
        spark.read.schema("asset string, bucket long, all binary, date date, period date").parquet(tables.days("address")),
    )


def bitmap_stats(
    transactions: DataFrame, addresses: DataFrame, by: Sequence[str] = ("asset",)
) -> DataFrame:
    """Statistics of any groups of days from their bitmaps; the same columns as ``ledger_stats``."""
    united = transactions.groupBy(*by, "bucket").agg(
        *[F.bitmap_or_agg(c).alias(c) for c in ("all", "defi", "rollup")],
        F.sum("volume").alias("volume"),
        F.sum("transfers").alias("transfers"),
        *[F.bool_or(c).cast("int").alias(c) for c in ("lost", "lost_defi", "lost_rollup")],
    )

    def count(bits: str, lost: str):
        return F.sum(F.bitmap_count(bits) + F.col(lost)).cast("long")

    stats = united.groupBy(*by).agg(
        F.sum("volume").alias("total_volume"),
        count("all", "lost").alias("transaction_count"),
        F.sum("transfers").alias("transfer_count"),
        count("defi", "lost_defi").alias("defi_transaction_count"),
        count("rollup", "lost_rollup").alias("rollup_transaction_count"),
    )
    parties = addresses.groupBy(*by, "bucket").agg(F.bitmap_or_agg("all").alias("all"))
    counted = parties.groupBy(*by).agg(F.sum(F.bitmap_count("all")).cast("long").alias("different_addresses"))
    both = stats.join(counted, list(by), "left").fillna(0, ["different_addresses"])
    return stats_columns(both, by)

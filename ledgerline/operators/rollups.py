"""Exact daily and whole-range statistics in two aggregation levels.

The first level has one row per group and key, where a key is a transaction or
an address; the second counts those rows. Distinct counts so become plain
counts, and no plan here needs several ``count(DISTINCT)`` at once. The first
level is combined on the map side and spread by its key: a day, an asset, an
address or a transaction that holds a third of all rows is folded before the
shuffle and never gathered in one task.

Rows of the first level can also be kept as *partials*, which merge exactly;
the incremental ledger is built on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_KEYS = ("asset", "date")


def key_partials(transfers: DataFrame, by: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """``by, is_tx, key`` with the volume, transfers and flags that key adds.

    One scan and one shuffle serve transactions and addresses alike. Volume and
    flags ride on the transaction rows only.
    """
    return merge_partials(_keyed(transfers, by), by)


def _keyed(transfers: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of ``key_partials`` before any are folded: three for each transfer."""
    tx = F.struct(
        F.lit(True).alias("is_tx"),
        F.col("tx_hash").alias("key"),
        F.col("amount").alias("volume"),
        F.lit(1).cast("long").alias("transfers"),
        F.col("is_defi_transaction").alias("defi"),
        F.col("is_rollup_transaction").alias("rollup"),
    )

    def party(side: str):
        return F.struct(
            F.lit(False).alias("is_tx"),
            F.lower(side).alias("key"),
            F.lit(None).cast("double").alias("volume"),
            F.lit(None).cast("long").alias("transfers"),
            F.lit(None).cast("boolean").alias("defi"),
            F.lit(None).cast("boolean").alias("rollup"),
        )

    return transfers.select(*by, F.inline(F.array(tx, party("from"), party("to"))))


def merge_partials(partials: DataFrame, by: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Folds partials of the same key together, also onto fewer group columns."""
    return partials.groupBy(*by, "is_tx", "key").agg(
        F.sum("volume").alias("volume"),
        F.sum("transfers").alias("transfers"),
        F.bool_or("defi").alias("defi"),
        F.bool_or("rollup").alias("rollup"),
    )


def count_partials(partials: DataFrame, by: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Statistics from partials already merged on ``by``."""
    stats = partials.groupBy(*by).agg(
        F.sum("volume").alias("total_volume"),
        F.count_if(F.col("is_tx")).alias("transaction_count"),
        F.sum("transfers").alias("transfer_count"),
        F.count_if(~F.col("is_tx") & F.col("key").isNotNull()).alias("different_addresses"),
        F.count_if(F.col("defi")).alias("defi_transaction_count"),
        F.count_if(F.col("rollup")).alias("rollup_transaction_count"),
    )
    return stats_columns(stats, by)


def stats_columns(stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns of statistics in their order, with the average."""
    return stats.select(
        *by,
        "total_volume",
        "transaction_count",
        "transfer_count",
        (F.col("total_volume") / F.col("transfer_count")).alias("avg_transfer_size"),
        "different_addresses",
        "defi_transaction_count",
        "rollup_transaction_count",
    )


def transaction_stats(transfers: DataFrame, by: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Everything but the addresses: first per transaction, then per group."""
    per_tx = transfers.groupBy(*by, "tx_hash").agg(
        F.sum("amount").alias("volume"),
        F.count("*").alias("transfers"),
        F.bool_or("is_defi_transaction").alias("defi"),
        F.bool_or("is_rollup_transaction").alias("rollup"),
    )
    return per_tx.groupBy(*by).agg(
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("transaction_count"),
        F.sum("transfers").alias("transfer_count"),
        F.count_if(F.col("defi")).alias("defi_transaction_count"),
        F.count_if(F.col("rollup")).alias("rollup_transaction_count"),
    )


def address_stats(transfers: DataFrame, by: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Distinct addresses over the union of both sides, lower-cased."""
    parties = transfers.select(
        *by, F.explode(F.array(F.lower("from"), F.lower("to"))).alias("address")
    )
    return parties.distinct().groupBy(*by).agg(
        F.count("address").alias("different_addresses")
    )


def ledger_stats(
    transfers: DataFrame, by: Sequence[str], single_pass: bool = False
) -> DataFrame:
    """All statistics of the transfers per group; unordered.

    Over a stored columnar ledger, transactions and addresses are two branches:
    they read different columns, an address row carries nothing but its key to
    the shuffle, and the two small results are partitioned alike, so that
    joining them moves nothing. ``single_pass`` is for transfers that are
    expensive to produce, such as ones decoded on the fly: it reads its input
    once and sends somewhat wider rows through one shuffle.
    """
    if single_pass:
        return count_partials(key_partials(transfers, by), by)
    stats = transaction_stats(transfers, by).join(address_stats(transfers, by), list(by))
    return stats_columns(stats, by)


def daily_stats(transfers: DataFrame, single_pass: bool = False) -> DataFrame:
    """Statistics per asset and date, sorted by asset and date."""
    return ledger_stats(transfers, DAILY_KEYS, single_pass).orderBy(*DAILY_KEYS)


def overall_stats(transfers: DataFrame, single_pass: bool = False) -> DataFrame:
    """Statistics per asset over the whole range.

    Distinct figures are distinct over the range, not sums of daily figures.
    """
    return ledger_stats(transfers, ("asset",), single_pass)


def daily_and_overall(partials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both from one stored table of daily partials, without the transfers."""
    daily = count_partials(merge_partials(partials)).orderBy(*DAILY_KEYS)
    overall = count_partials(merge_partials(partials, ("asset",)), ("asset",))
    return daily, overall


def stats_by_sets(transfers: DataFrame) -> DataFrame:
    """Daily and whole-range statistics from one scan: ``is_total`` rows have no date.

    Keys are folded once with and once without the date, both on the map side and in one shuffle.
    Folding them by day first and the folded rows again would save little where most keys have
    few rows a day, and move every one of those twice.
    """
    by = ("asset", "date", "is_tx", "key")
    sets = _keyed(transfers, DAILY_KEYS).groupingSets([list(by), ["asset", "is_tx", "key"]], *by)
    folded = sets.agg(
        F.grouping("date").alias("_total"),
        F.sum("volume").alias("volume"),
        F.sum("transfers").alias("transfers"),
        F.bool_or("defi").alias("defi"),
        F.bool_or("rollup").alias("rollup"),
    )
    marked = folded.withColumn("is_total", F.col("_total") == 1)
    return count_partials(marked, ("asset", "date", "is_total"))


# The four functions below compute single figures with the least work each one
# needs; use daily_stats for several together.


def daily_volume(transfers: DataFrame) -> DataFrame:
    """Volume, transfer count and average size; one map-side combined aggregate."""
    sums = transfers.groupBy(*DAILY_KEYS).agg(
        F.sum("amount").alias("total_volume"), F.count("*").alias("transfer_count")
    )
    average = F.col("total_volume") / F.col("transfer_count")
    return sums.withColumn("avg_transfer_size", average)


def daily_transactions(transfers: DataFrame) -> DataFrame:
    """Distinct transactions."""
    return transfers.groupBy(*DAILY_KEYS).agg(
        F.count_distinct("tx_hash").alias("transaction_count")
    )


def daily_addresses(transfers: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Distinct addresses over the union of both sides, lower-cased.

    With ``relative_error`` the count is a HyperLogLog estimate of that
    standard deviation, which needs no shuffle of addresses.
    """
    if relative_error is None:
        return address_stats(transfers)
    parties = transfers.select(
        *DAILY_KEYS, F.explode(F.array(F.lower("from"), F.lower("to"))).alias("address")
    )
    return parties.groupBy(*DAILY_KEYS).agg(
        F.approx_count_distinct("address", relative_error).alias("different_addresses")
    )


def daily_categories(transfers: DataFrame) -> DataFrame:
    """Distinct transactions with at least one flagged transfer of that asset and day."""
    per_tx = transfers.groupBy(*DAILY_KEYS, "tx_hash").agg(
        F.bool_or("is_defi_transaction").alias("defi"),
        F.bool_or("is_rollup_transaction").alias("rollup"),
    )
    return per_tx.groupBy(*DAILY_KEYS).agg(
        F.count_if(F.col("defi")).alias("defi_transaction_count"),
        F.count_if(F.col("rollup")).alias("rollup_transaction_count"),
    )

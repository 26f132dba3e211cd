"""CSV in the exchange layout: ``{asset}_transfers.csv``, ``{asset}_daily_stats.csv``.

Each name is a folder of part files, every one with its own header. The
exporters take the path of a stored table, so that the filter on the asset
prunes partitions and no asset causes the table to be computed again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import money_text
from ledgerline.operators.decode import in_chain_order
from ledgerline.schemas import DAILY, TRANSFERS_CSV
from ledgerline.sinks.folders import remove_folder
from ledgerline.sources.transfers import read_transfers


def _true_false(flag: str) -> Column:
    return F.initcap(F.col(flag).cast("string")).alias(flag)


def export_transfers_csv(
    spark: SparkSession, transfers_path: str, folder: str, assets: Iterable[str]
) -> None:
    """One folder per asset; part files follow each other in chain order.

    An asset without transfers gets no folder, and one from an earlier export
    is removed.
    """
    stored = read_transfers(spark, transfers_path)
    for asset in assets:
        rows = stored.where(F.col("asset") == asset)
        if rows.isEmpty():
            remove_folder(spark, f"{folder}/{asset}_transfers.csv")
            continue
        columns = [
            _true_false(n) if n.startswith("is_") else F.col(n)
            for n in TRANSFERS_CSV.fieldNames()
        ]
        ordered = in_chain_order(rows).select(*columns)
        _write(ordered, f"{folder}/{asset}_transfers.csv")


def daily_export_view(daily: DataFrame, asset: str) -> DataFrame:
    """Daily rows of one asset under its own column names, money as text."""
    return daily.where(F.col("asset") == asset).select(
        "date",
        money_text(F.col("total_volume")).alias(f"total_volume_{asset}"),
        "transaction_count",
        "transfer_count",
        money_text(F.col("avg_transfer_size")).alias(f"avg_transfer_size_{asset}"),
        "different_addresses",
        "defi_transaction_count",
        "rollup_transaction_count",
    )


def export_daily_csv(
    spark: SparkSession, daily_path: str, folder: str, assets: Iterable[str]
) -> None:
    """One single-file folder per asset, by date. A file holds one row per day."""
    stored = spark.read.schema(DAILY).parquet(daily_path)
    for asset in assets:
        rows = daily_export_view(stored, asset)
        if rows.isEmpty():
            remove_folder(spark, f"{folder}/{asset}_daily_stats.csv")
            continue
        _write(rows.coalesce(1).sortWithinPartitions("date"), f"{folder}/{asset}_daily_stats.csv")


def _write(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)

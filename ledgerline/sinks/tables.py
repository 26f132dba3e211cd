"""Parquet tables: transfers, daily statistics, chart series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sinks.folders import partition_folders, remove_folder

PARTITIONS = ("asset", "date")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_transfers(transfers: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Partitioned by asset and date, in chain order inside each file.

    ``overwrite`` replaces only the (asset, date) partitions present in the
    input; ``append`` adds files. The rebalance hint brings the rows of a
    partition together but lets adaptive execution cut a large one, such as a
    day holding a third of all rows, into several files of the advisory size,
    and join small ones, so there is neither one huge task nor a file per task
    and day.
    """
    rows = transfers.hint("rebalance", *PARTITIONS)
    ordered = rows.sortWithinPartitions(*PARTITIONS, "block_number", "tx_pos", "log_pos")
    _write(ordered, path, mode, PARTITIONS)


def write_daily(daily: DataFrame, path: str, partition: str = "asset") -> None:
    """Daily rows by ``asset`` or by ``date``; partitions not in the input stay.

    By asset suits a job that recomputes whole assets, by date one that updates
    days. A partition holds one row per day, or per asset, respectively.
    """
    other = "date" if partition == "asset" else "asset"
    rows = daily.hint("rebalance", partition).sortWithinPartitions(partition, other)
    _write(rows, path, "overwrite", (partition,))


def write_series(series: DataFrame, path: str) -> None:
    """Chart points by metric: one chart reads one partition."""
    rows = series.hint("rebalance", "metric")
    _write(rows.sortWithinPartitions("metric", "asset", "date"), path, "overwrite", ("metric",))


def replace_assets(
    rows: DataFrame, path: str, assets: Iterable[str], order: Sequence[str]
) -> None:
    """Puts ``rows`` of several assets in place of all that these had, in one write.

    New dates and those that come again are written first, by asset and date; dates of these
    assets that are not among them are removed after that. Other assets are not touched. Rows
    must come from another folder.
    """
    spark = rows.sparkSession
    ordered = rows.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *order)
    # a date without rows has no folder; there are as many folders as days of an asset
    place = F.coalesce(F.col("date").cast("string"), F.lit(_NO_VALUE)).alias("date")
    new = {(r["asset"], r["date"]) for r in rows.select("asset", place).distinct().collect()}
    _write(ordered, path, "overwrite", PARTITIONS)
    for asset in assets:
        for found in partition_folders(spark, path, f"asset={asset}", "date"):
            if (asset, found["date"]) not in new:
                remove_folder(spark, f"{path}/asset={asset}/date={found['date']}")


def replace_daily(daily: DataFrame, path: str, assets: Iterable[str]) -> None:
    """Daily rows of several assets in place of all that these had, in one write.

    An asset without rows loses what it had after the others have been written.
    """
    spark = daily.sparkSession
    write_daily(daily, path)
    kept = {r["asset"] for r in daily.select("asset").distinct().collect()}
    for asset in assets:
        if asset not in kept:
            remove_folder(spark, f"{path}/asset={asset}")


def _write(frame: DataFrame, path: str, mode: str, partitions: tuple[str, ...]) -> None:
    (
        frame.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )

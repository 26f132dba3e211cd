"""Incremental ingest with exact running statistics.

A streaming source of transfers is processed file batch by file batch. Each micro-batch stores
its transfers below ``date=/batch_id=`` and its key partials as runs (see ``compaction``), and
then recomputes the dates it touched from the live runs. Any batch may bring rows for any date;
nothing is late and no watermark is kept.

Running a batch again puts its new rows in place of all it had: a date that it no longer has
loses its rows, and a merged run that holds its old rows is built anew from the stored transfers.
The dates at stake are noted first, so that a try that fails half-way is completed by the next.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.decode import CHAIN_ORDER
from ledgerline.operators.rollups import count_partials, key_partials, merge_partials
from ledgerline.schemas import DAILY, REJECTS, TRANSFERS
from ledgerline.sinks.folders import partition_folders, remove_folder
from ledgerline.sinks.tables import write_daily
from ledgerline.streaming.compaction import (
    FAN,
    Run,
    compact,
    live_runs,
    read_runs,
    stored_runs,
    write_runs,
)

_STORED_TRANSFERS = T.StructType(
    TRANSFERS.fields + [T.StructField("batch_id", T.LongType())]
)


@dataclass(frozen=True)
class LedgerTables:
    """Folders of one incremental ledger, all below ``root``."""

    root: str

    @property
    def transfers(self) -> str:
        return f"{self.root}/transfers"

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    @property
    def daily(self) -> str:
        return f"{self.root}/daily"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def pending(self) -> str:
        return f"{self.root}/pending"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def stored_transfers(spark: SparkSession, tables: LedgerTables) -> DataFrame:
    return spark.read.schema(_STORED_TRANSFERS).parquet(tables.transfers)


def stored_rejects(spark: SparkSession, tables: LedgerTables) -> DataFrame:
    """Logs of all batches that could not be decoded, with their reason and batch."""
    schema = T.StructType([*REJECTS.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(tables.rejects)


def stored_daily(spark: SparkSession, tables: LedgerTables) -> DataFrame:
    return spark.read.schema(DAILY).parquet(tables.daily)


def _replace(frame: DataFrame, path: str) -> None:
    """Writes one batch, by date, over what an earlier try of it left.

    A date with very many rows is cut into several files by the rebalance.
    """
    order = ["date", "batch_id", "asset"] + [c for c in CHAIN_ORDER if c in frame.columns]
    rows = frame.hint("rebalance", "date").sortWithinPartitions(*order)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .parquet(path)
    )


def _dates_at_stake(
    spark: SparkSession, transfers: DataFrame, batch_id: int, tables: LedgerTables
) -> tuple[set[str], set[str]]:
    """Dates of the batch now, and those of earlier tries; one value for each calendar day."""
    now = {str(row["date"]) for row in transfers.select("date").distinct().collect()}
    before = {
        row["date"]
        for row in partition_folders(spark, tables.transfers, "date", f"batch_id={batch_id}")
    }
    noted = partition_folders(spark, tables.pending, f"batch_id={batch_id}", "date")
    return now, before | {row["date"] for row in noted}


def _note(spark: SparkSession, batch_id: int, dates: set[str], tables: LedgerTables) -> None:
    rows = spark.createDataFrame([(d, 1) for d in sorted(dates)], "date string, n int")
    rows.write.mode("append").partitionBy("date").parquet(f"{tables.pending}/batch_id={batch_id}")


def apply_batch(
    transfers: DataFrame, batch_id: int, tables: LedgerTables, fan: int = FAN
) -> None:
    """Stores one batch and brings the daily table up to date.

    The batch is staged once; its transfers, rejects (rows with a ``reject_reason``, see
    ``accepted_and_rejected``) and dates come from there, and its partials from the stored
    transfers. Then the live runs of the dates at stake, and of no others, are merged. The
    dates are the only thing that reaches the driver, one value per calendar day.
    """
    spark = transfers.sparkSession
    staged = f"{tables.root}/staged/batch_id={batch_id}"
    transfers.write.mode("overwrite").parquet(staged)
    both = spark.read.schema(transfers.schema).parquet(staged)
    good = both
    if "reject_reason" in transfers.columns:
        rejects = both.where(F.col("reject_reason").isNotNull()).select(*REJECTS.fieldNames())
        rejects.sortWithinPartitions("asset", *CHAIN_ORDER).write.mode("overwrite").parquet(
            f"{tables.rejects}/batch_id={batch_id}"
        )
        good = both.where(F.col("reject_reason").isNull()).select(*TRANSFERS.fieldNames())

    now, before = _dates_at_stake(spark, good, batch_id, tables)
    dates = now | before
    if dates:
        if before:
            _note(spark, batch_id, dates, tables)
        if now:
            _replace(good.withColumn("batch_id", F.lit(batch_id).cast("long")), tables.transfers)
        for date in before - now:
            remove_folder(spark, f"{tables.transfers}/date={date}/batch_id={batch_id}")
        _renew_runs(spark, batch_id, now, dates, tables)
        _merge_days(spark, dates, compact(spark, tables.partials, dates, fan), tables)
        remove_folder(spark, f"{tables.pending}/batch_id={batch_id}")
    remove_folder(spark, staged)


def _renew_runs(
    spark: SparkSession, batch_id: int, now: set[str], dates: set[str], tables: LedgerTables
) -> None:
    """Runs of the dates at stake that hold the batch, from the stored transfers.

    Where a merged run covers the batch, all its batches are read again for that date; else the
    batch has a run of its own.
    """
    live = live_runs(stored_runs(spark, tables.partials, dates))
    covering = {r.date: r for r in live if r.first <= batch_id <= r.last}
    renewed = {d: covering.get(d) or Run(d, batch_id, batch_id, 0) for d in dates}
    kept: dict[str, Run] = {}
    folders = []
    for date, run in renewed.items():
        held = partition_folders(spark, tables.transfers, f"date={date}", "batch_id")
        covered = [h for h in held if run.first <= int(h["batch_id"]) <= run.last]
        if covered:
            kept[date] = run
            folders += [f"{tables.transfers}/date={date}/batch_id={h['batch_id']}" for h in covered]
        else:
            remove_folder(spark, f"{tables.partials}/{run.folder}")
    if not kept:
        return
    stored = spark.read.schema(_STORED_TRANSFERS).option("basePath", tables.transfers)
    rows = key_partials(stored.parquet(*folders).drop("batch_id"))
    place = spark.createDataFrame(
        [(d, r.level, r.first, r.last) for d, r in kept.items()],
        "_date string, level int, first long, last long",
    ).select(F.to_date("_date").alias("date"), "level", "first", "last")
    write_runs(rows.join(F.broadcast(place), "date"), tables.partials)


def _merge_days(
    spark: SparkSession, dates: set[str], live: list[Run], tables: LedgerTables
) -> None:
    """Daily rows of these dates from their live runs; a date without any has none."""
    for date in dates - {r.date for r in live}:
        remove_folder(spark, f"{tables.daily}/date={date}")
    if live:
        current = read_runs(spark, tables.partials, live)
        write_daily(count_partials(merge_partials(current)), tables.daily, "date")


def run_incremental(
    source: DataFrame,
    tables: LedgerTables,
    to_transfers: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    fan: int = FAN,
) -> None:
    """Processes everything a streaming source holds now, then stops.

    ``source`` is a streaming DataFrame, usually over files with
    ``maxFilesPerTrigger``; ``to_transfers`` decodes its rows where they are not
    transfers yet. A later call continues from the checkpoint.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(to_transfers(batch), batch_id, tables, fan)

    query = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", tables.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

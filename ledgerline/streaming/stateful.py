"""Running statistics kept in Spark's state store alone, without stored partials.

Two queries run over the same source. One adds up volume and transfers of each asset and day.
The other makes a row of every key a transfer has (its transaction, flagged transactions, both
addresses), drops those it has seen, and counts what is left; a distinct count so is a plain
count, and the state has one entry for each key, spread by that key. Both run in update mode:
a micro-batch hands over the new figures of the groups it touched, which replace the old ones.

``lateness`` is the watermark, off by default: nothing is late, the state of every day is kept
and the figures equal the batch answer. With it, days that lie further back than the latest
time seen are closed: their state is freed, and rows that still come for them are left out and
counted. Days are then UTC days of the block time.

Large state belongs in RocksDB, which :data:`STATE_SETTINGS` chooses; it does not change figures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import DAILY

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_GROUP = ("asset", "date")
_SUMS = ("total_volume", "transfer_count")
_COUNTS = (
    "transaction_count",
    "different_addresses",
    "defi_transaction_count",
    "rollup_transaction_count",
)


@dataclass(frozen=True)
class StateTables:
    """Folders of running figures, all below ``root``."""

    root: str

    def figures(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def checkpoint(self, kind: str) -> str:
        return f"{self.root}/checkpoint-{kind}"


def _grouped(transfers: DataFrame, lateness: str | None) -> tuple[DataFrame, list[str]]:
    """The transfers with what they are grouped by; under a watermark that is a day window."""
    if lateness is None:
        return transfers, list(_GROUP)
    timed = transfers.withColumn("event_time", F.timestamp_seconds("timestamp"))
    days = timed.withWatermark("event_time", lateness).withColumn(
        # windows begin at UTC midnight whatever the time zone of the session
        "day", F.window("event_time", "1 day")
    )
    return days, ["asset", "day"]


def _dated(rows: DataFrame) -> DataFrame:
    if "day" not in rows.columns:
        return rows
    date = F.date_from_unix_date(F.floor(F.unix_seconds("day.start") / 86400).cast("int"))
    return rows.withColumn("date", date).drop("day")


def running_sums(transfers: DataFrame, lateness: str | None = None) -> DataFrame:
    """Volume and transfers of each asset and day, as a streaming aggregate."""
    rows, by = _grouped(transfers, lateness)
    return _dated(
        rows.groupBy(*by).agg(
            F.sum("amount").alias("total_volume"), F.count("*").alias("transfer_count")
        )
    )


def running_counts(transfers: DataFrame, lateness: str | None = None) -> DataFrame:
    """Distinct transactions and addresses of each asset and day, as duplicates dropped."""
    rows, by = _grouped(transfers, lateness)

    def key(kind: str, value, wanted=None):
        row = F.struct(F.lit(kind).alias("kind"), value.alias("key"))
        return row if wanted is None else F.when(wanted, row)

    keys = F.array(
        key("transaction_count", F.col("tx_hash")),
        key("defi_transaction_count", F.col("tx_hash"), F.col("is_defi_transaction")),
        key("rollup_transaction_count", F.col("tx_hash"), F.col("is_rollup_transaction")),
        key("different_addresses", F.lower("from")),
        key("different_addresses", F.lower("to")),
    )
    keyed = rows.select(*by, F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("k")).select(
        *by, "k.kind", "k.key"
    )
    # the batch form counts a missing transaction once and a missing address not at all
    known = keyed.where(F.col("key").isNotNull() | (F.col("kind") != "different_addresses"))
    once = known.dropDuplicates([*by, "kind", "key"])
    return _dated(
        once.groupBy(*by).agg(*[F.count_if(F.col("kind") == c).alias(c) for c in _COUNTS])
    )


def _keep_updates(path: str):
    """Puts the figures of touched groups in place of the old ones; a batch may come again."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.hint("rebalance", "date").withColumn("batch_id", F.lit(batch_id).cast("long"))
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "asset")
            .parquet(path)
        )

    return handle


def run_stateful(
    source: DataFrame, tables: StateTables, lateness: str | None = None
) -> dict[str, int]:
    """Processes everything a streaming source of transfers holds now, then stops.

    Returns how many rows each query left out as too late in this run. ``counts`` is in keys:
    three of each transfer, and one more for each flag it has. ``sums`` is in rows as they come
    to the state, where the transfers of one group and task are one.
    """
    late = {}
    for kind, figures in (("sums", running_sums), ("counts", running_counts)):
        query = (
            figures(source, lateness)
            .writeStream.outputMode("update")
            .foreachBatch(_keep_updates(tables.figures(kind)))
            .option("checkpointLocation", tables.checkpoint(kind))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        late[kind] = sum(
            int(state.numRowsDroppedByWatermark)
            for progress in query.recentProgress
            for state in progress.stateOperators
        )
    return late


def state_daily(spark: SparkSession, tables: StateTables) -> DataFrame:
    """The daily statistics as they stand."""
    types = {f.name: f.dataType for f in DAILY}

    def read(kind: str, columns: tuple[str, ...]) -> DataFrame:
        fields = [T.StructField(c, types[c]) for c in (*columns, *_GROUP)]
        return spark.read.schema(T.StructType(fields)).parquet(tables.figures(kind))

    both = read("sums", _SUMS).join(read("counts", _COUNTS), list(_GROUP))
    average = F.col("total_volume") / F.col("transfer_count")
    return both.withColumn("avg_transfer_size", average).select(*DAILY.fieldNames())

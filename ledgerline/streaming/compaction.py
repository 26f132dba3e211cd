"""Levelled runs of key partials, so that a day stays cheap however many batches touch it.

A batch adds a run of level 0 to each date it touches. When a date has ``fan`` runs of one level,
they are merged into one run of the next, which covers the batches from the first to the last of
them. A date that n batches touch so has at most (fan - 1) runs on each of about log n levels.

What a run replaces is written in its name, ``date=/level=/first=/last=``: every run of a lower
level whose batches lie within its own. A reader goes by that list, so a merged run counts from
the moment its folder is there, and the runs it replaces stop to count at the same moment; that
they are deleted afterwards is only housekeeping, and a failure in between changes no figure.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.rollups import merge_partials
from ledgerline.sinks.folders import partition_folders, remove_folder

FAN = 4

PARTIALS = T.StructType(
    [
        T.StructField("asset", T.StringType()),
        T.StructField("is_tx", T.BooleanType()),
        T.StructField("key", T.StringType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("transfers", T.LongType()),
        T.StructField("defi", T.BooleanType()),
        T.StructField("rollup", T.BooleanType()),
        T.StructField("date", T.DateType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)
_PLACE = ("date", "level", "first", "last")


@dataclass(frozen=True, order=True)
class Run:
    """The partials of one date from the batches ``first`` to ``last``."""

    date: str
    first: int
    last: int
    level: int

    @property
    def folder(self) -> str:
        return f"date={self.date}/level={self.level}/first={self.first}/last={self.last}"

    def replaces(self, other: Run) -> bool:
        return (
            self.date == other.date
            and self.level > other.level
            and self.first <= other.first
            and other.last <= self.last
        )


def stored_runs(spark: SparkSession, path: str, dates: Iterable[str]) -> list[Run]:
    """All runs of these dates, also those that are replaced and not yet deleted."""
    found = []
    for date in sorted(set(dates)):
        for row in partition_folders(spark, path, f"date={date}", *_PLACE[1:]):
            found.append(Run(date, int(row["first"]), int(row["last"]), int(row["level"])))
    return found


def live_runs(runs: Iterable[Run]) -> list[Run]:
    """The runs that no other one replaces."""
    by_date = defaultdict(list)
    for run in runs:
        by_date[run.date].append(run)
    return sorted(
        r for same in by_date.values() for r in same if not any(o.replaces(r) for o in same)
    )


def read_runs(spark: SparkSession, path: str, runs: Iterable[Run]) -> DataFrame:
    """The partials of some runs; only their folders are listed."""
    folders = [f"{path}/{r.folder}" for r in runs]
    if not folders:
        return spark.createDataFrame([], PARTIALS)
    return spark.read.schema(PARTIALS).option("basePath", path).parquet(*folders)


def write_runs(partials: DataFrame, path: str) -> None:
    """Writes runs over what an earlier try of them left.

    A date with very many keys is cut into several files by the rebalance.
    """
    rows = partials.select(*PARTIALS.fieldNames()).hint("rebalance", "date")
    (
        rows.sortWithinPartitions(*_PLACE, "asset", "is_tx", "key").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PLACE)
        .parquet(path)
    )


def due(runs: Iterable[Run], fan: int) -> dict[Run, list[Run]]:
    """Merged runs to write, of the lowest level of each date that is full, and their sources."""
    levels = defaultdict(list)
    for run in live_runs(runs):
        levels[run.date, run.level].append(run)
    merges: dict[Run, list[Run]] = {}
    taken = set()
    for (date, level), same in sorted(levels.items()):
        if len(same) >= fan and date not in taken:
            taken.add(date)
            merges[Run(date, same[0].first, same[-1].last, level + 1)] = same
    return merges


def compact(spark: SparkSession, path: str, dates: Iterable[str], fan: int = FAN) -> list[Run]:
    """Merges full levels of these dates until none is full; returns the live runs.

    All dates that have a merge due are served by one job for each level. The keys of a run are
    folded on the map side and spread, so a hot date is no single task.
    """
    if fan < 2:
        raise ValueError("a run is merged from two at least")
    dates = set(dates)
    while True:
        runs = stored_runs(spark, path, dates)
        merges = due(runs, fan)
        if not merges:
            for run in set(runs) - set(live_runs(runs)):
                remove_folder(spark, f"{path}/{run.folder}")
            return live_runs(runs)
        # as many rows as dates are touched
        place = spark.createDataFrame(
            [(m.date, m.level, m.first, m.last) for m in merges],
            "_date string, level int, first long, last long",
        ).select(F.to_date("_date").alias("date"), "level", "first", "last")
        sources = read_runs(spark, path, [r for same in merges.values() for r in same])
        merged = merge_partials(sources.drop("level", "first", "last"), ("asset", "date"))
        write_runs(merged.join(F.broadcast(place), "date"), path)

"""The three jobs a user runs: extract, report, analyse.

``extract`` turns landed blocks into the transfers and daily tables, ``report``
turns daily CSV files into chart series and summary figures, and ``analyse``
gives the whole-range figures of a stored ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.fixed_values import CHUNK_BLOCKS, END_BLOCK, START_BLOCK, TOKENS
from ledgerline.operators.decode import CHAIN_ORDER, accepted_and_rejected, decode_logs
from ledgerline.operators.report import chart_series, loaded_assets, summary_stats
from ledgerline.operators.rollups import DAILY_KEYS, ledger_stats, overall_stats
from ledgerline.operators.totals import block_coverage, chunk_counts, transfers_per_asset, with_labels
from ledgerline.schemas import DAILY, REJECTS, TRANSFERS
from ledgerline.sinks.csv_export import export_daily_csv, export_transfers_csv
from ledgerline.sinks.folders import remove_folder
from ledgerline.sinks.tables import replace_assets, replace_daily, write_series
from ledgerline.sources.daily_csv import daily_csv_files, read_daily_csv
from ledgerline.sources.registry import CONTRACTS, select_tokens, token_registry
from ledgerline.sources.transfers import read_transfers


@dataclass(frozen=True)
class Ledger:
    """A stored ledger; every DataFrame is read lazily from its tables."""

    spark: SparkSession
    root: str
    registry: DataFrame
    assets: tuple[str, ...]

    @property
    def transfers_path(self) -> str:
        return f"{self.root}/transfers"

    @property
    def daily_path(self) -> str:
        return f"{self.root}/daily"

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/rejects"

    def transfers(self) -> DataFrame:
        """The transfers of the selected assets, by partition filter."""
        return read_transfers(self.spark, self.transfers_path).where(
            F.col("asset").isin(*self.assets)
        )

    def rejects(self) -> DataFrame:
        """Logs of the selected assets that could not be decoded, with the reason."""
        stored = self.spark.read.schema(REJECTS).parquet(self.rejects_path)
        return stored.where(F.col("asset").isin(*self.assets))

    def daily(self) -> DataFrame:
        stored = self.spark.read.schema(DAILY).parquet(self.daily_path)
        return stored.where(F.col("asset").isin(*self.assets)).orderBy(*DAILY_KEYS)

    def transfers_per_asset(self) -> DataFrame:
        return transfers_per_asset(self.transfers(), self.registry)

    def chunk_counts(
        self,
        start: int = START_BLOCK,
        end: int = END_BLOCK,
        chunk_blocks: int = CHUNK_BLOCKS,
    ) -> DataFrame:
        return chunk_counts(self.transfers(), start, end, chunk_blocks)

    def block_coverage(
        self,
        headers: DataFrame,
        start: int = START_BLOCK,
        end: int = END_BLOCK,
        chunk_blocks: int = CHUNK_BLOCKS,
    ) -> DataFrame:
        """Blocks asked for and blocks present, per chunk of the range."""
        return block_coverage(self.spark, headers, start, end, chunk_blocks)

    def export_csv(self, folder: str) -> None:
        export_transfers_csv(self.spark, self.transfers_path, folder, self.assets)
        export_daily_csv(self.spark, self.daily_path, folder, self.assets)


def extract(
    receipts: DataFrame,
    root: str,
    headers: DataFrame | None = None,
    assets: Iterable[str] | None = None,
    tokens: Sequence[tuple] = TOKENS,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
    zone: str = "UTC",
) -> Ledger:
    """Decodes landed blocks into ``root`` and computes their daily statistics.

    One pass decodes the blocks into a staged table of transfers and rejects;
    from there, in one write each for all selected assets, transfers, rejects
    (with their reason, below ``root/rejects``) and daily statistics take the
    place of what these had. Other assets are not touched, nothing is replaced
    before the pass has succeeded, what is left over is removed after the new
    rows are written, and an asset without rows ends up with none. The staged
    table is removed at the end.
    """
    spark = receipts.sparkSession
    chosen = tuple(row[0] for row in select_tokens(assets, tokens))
    ledger = Ledger(spark, root, token_registry(spark, chosen, tokens), chosen)
    decoded = decode_logs(receipts, ledger.registry, headers)
    folder = f"{root}/staged-{uuid.uuid4().hex}"
    both = accepted_and_rejected(decoded, contracts, zone)
    both.write.partitionBy("asset").parquet(folder)
    staged = spark.read.schema(both.schema).parquet(folder)
    good = staged.where(F.col("reject_reason").isNull())
    bad = staged.where(F.col("reject_reason").isNotNull())
    replace_assets(good.select(*TRANSFERS.fieldNames()), ledger.transfers_path, chosen, CHAIN_ORDER)
    replace_assets(bad.select("date", *REJECTS.fieldNames()), ledger.rejects_path, chosen, CHAIN_ORDER)
    replace_daily(ledger_stats(ledger.transfers(), DAILY_KEYS), ledger.daily_path, chosen)
    remove_folder(spark, folder)
    return ledger


@dataclass(frozen=True)
class Report:
    """Chart series and summary of daily files, and the verdict on each file."""

    series: DataFrame
    summary: DataFrame
    files: DataFrame
    loaded: DataFrame

    def write(self, folder: str) -> None:
        """Series by metric, summary and file verdicts as Parquet below ``folder``."""
        write_series(self.series, f"{folder}/series")
        self.summary.write.mode("overwrite").parquet(f"{folder}/summary")
        self.files.write.mode("overwrite").parquet(f"{folder}/files")


def report(spark: SparkSession, daily_files: str | list[str]) -> Report:
    """Loads ``*_daily_stats.csv`` files and derives series and summary."""
    daily = read_daily_csv(spark, daily_files)
    return Report(
        series=chart_series(daily).orderBy("metric", "asset", "date"),
        summary=summary_stats(daily).orderBy("asset"),
        files=daily_csv_files(spark, daily_files),
        loaded=loaded_assets(daily),
    )


def analyse(transfers: DataFrame, registry: DataFrame) -> DataFrame:
    """Whole-range figures per asset, with symbol and currency mark."""
    return with_labels(overall_stats(transfers), registry)

"""The query catalogue over the test tables, with the SQL each one must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import block_key, epoch_date, money_text, whole_number
from ledgerline.operators import bitmaps, contacts, decode, report, rollups, sketches, totals
from ledgerline.plans import jobs, standin
from ledgerline.schemas import BLOCKS, TRANSFERS
from ledgerline.session import working_folder
from ledgerline.sinks.blocks import (
    attach_bucketed_time,
    hot_blocks,
    read_block_ranges,
    write_block_ranges,
    write_bucketed,
)
from ledgerline.sinks.csv_export import daily_export_view, export_daily_csv, export_transfers_csv
from ledgerline.sinks.folders import partition_folders
from ledgerline.sinks.tables import write_daily, write_transfers
from ledgerline.sources.chain import corrupt_records, read_blocks, read_headers
from ledgerline.sources.daily_csv import daily_csv_files, read_daily_csv
from ledgerline.sources.registry import protocol_dimension, token_registry
from ledgerline.sources.transfers import count_transfers_csv, read_transfers_csv
from ledgerline.streaming.incremental import (
    LedgerTables,
    apply_batch,
    run_incremental,
    stored_daily,
    stored_rejects,
)
from ledgerline.streaming.stateful import StateTables, run_stateful, state_daily

Query = Callable[[SparkSession, str], DataFrame]

CHUNK = 50


def comparable(stats: DataFrame) -> DataFrame:
    """Volume in cents and the average from it.

    Sums of doubles depend on the order of addition in their last bits, so both engines are
    compared on the volume as money and on its quotient. The engine's own average, taken times
    the transfers, must give that volume but for the rounding to cents; else it is NULL here.
    """
    volume = F.round("total_volume", 2)
    average = volume / F.col("transfer_count")
    agrees = F.abs(F.col("avg_transfer_size") * F.col("transfer_count") - volume) <= 0.0051
    return stats.withColumns(
        {"total_volume": volume, "avg_transfer_size": F.when(agrees, average)}
    )


def _block_range(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last block that events fall into."""
    return tuple(
        standin.numbered_events(spark, sf_dir)
        .agg(F.min("block_number"), F.max("block_number")).first()
    )


def _registry(spark: SparkSession, assets=None) -> DataFrame:
    return token_registry(spark, assets, standin.token_rows())


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.explode_logs(standin.raw_receipts(spark, sf_dir))


def _raw_as_long(transfers: DataFrame) -> DataFrame:
    return transfers.withColumn("amount_raw", F.col("amount_raw").cast("long")).drop("amount_hex")


def decode_wide_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of up to 54 significant digits, padded to 300, with 6 or 18 decimals."""
    events = standin.table(spark, sf_dir, "events")
    zeros = (F.col("event_id") % 51).cast("int")
    digits = F.concat(F.lower(F.hex(F.col("user_id") + 1)), F.repeat(F.lit("0"), zeros))
    padded = events.select(
        "event_id",
        F.concat(F.lit("0x"), F.lpad(digits, 300, "0")).alias("data"),
        F.when(F.col("event_id") % 2 == 0, 6).otherwise(18).alias("decimals"),
    )
    return decode.decode_amounts(padded).select(
        "event_id", F.col("amount_raw").cast("string").alias("amount_raw"), "amount_hex", "amount"
    )


def extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over landed blocks, and again for one of the assets."""
    root = working_folder(spark, "extract")
    tokens, contracts_ = standin.token_rows(), standin.contracts()
    blocks = standin.raw_blocks(spark, sf_dir)
    jobs.extract(blocks, root, tokens=tokens, contracts=contracts_)
    jobs.extract(blocks, root, assets=["view"], tokens=tokens, contracts=contracts_)
    chosen = tuple(t[0] for t in tokens)
    ledger = jobs.Ledger(spark, root, _registry(spark), chosen)
    daily = ledger.daily().groupBy("asset").agg(
        F.count("*").alias("days"), F.sum("transfer_count").alias("transfers")
    )
    volume = ledger.transfers().groupBy("asset").agg(F.round(F.sum("amount"), 2).alias("volume"))
    rejects = ledger.rejects().groupBy("asset").agg(F.count("*").alias("rejects"))
    per_asset = _registry(spark).select("asset")
    for part in (daily, volume, rejects):
        per_asset = per_asset.join(part, "asset", "left")
    return per_asset.fillna(0, ["days", "transfers", "rejects"])


def decode_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = standin.raw_blocks(spark, sf_dir)
    transfers = decode.decode_transfers(
        blocks, _registry(spark), contracts=standin.contracts()
    )
    return _raw_as_long(transfers)


def decode_with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = standin.raw_receipts(spark, sf_dir)
    transfers = decode.decode_transfers(
        receipts, _registry(spark), standin.raw_headers(spark, sf_dir), standin.contracts()
    )
    return _raw_as_long(transfers)


def rejected_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_logs(standin.raw_blocks(spark, sf_dir), _registry(spark))
    return decode.rejected(decoded)


def block_hex_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = standin.ledger(spark, sf_dir).select("block_number").distinct()
    return blocks.withColumn("block_key", block_key(F.col("block_number")))


def event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = decode.with_both_parties(decode.transfer_events(_logs(spark, sf_dir)))
    return kept.select("event_id", "block_number", "tx_pos", "log_pos")


def asset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decode.transfer_events(_logs(spark, sf_dir))
    return decode.attribute_assets(events, _registry(spark)).select(
        "event_id", "asset", "address", "decimals"
    )


def block_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = decode.transfer_events(_logs(spark, sf_dir)).select("event_id", "block_number")
    headers = standin.raw_headers(spark, sf_dir)
    # every fifth header is landed twice
    return decode.attach_time(events, headers.union(headers.where(F.col("block_number") % 5 == 0)))


def asset_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _registry(spark, ["view", "purchase"]).select("asset")
    return standin.plain_ledger(spark, sf_dir).join(chosen, "asset", "left_semi").select(
        "asset", "tx_hash", "amount"
    )


def block_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.plain_ledger(spark, sf_dir)
    rows = rows.where(F.col("block_number").between(78900, 78950))
    return decode.in_chain_order(rows).select("block_number", "log_pos", "asset", "amount")


def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = standin.table(spark, sf_dir, "events")
    seconds = (
        F.unix_date(F.col("ts").cast("date")).cast("long") * 86400
        + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    )
    return events.select("event_id", seconds.alias("s")).select(
        "event_id",
        F.col("s").alias("timestamp"),
        epoch_date(F.col("s")).alias("utc_date"),
        epoch_date(F.col("s"), "Asia/Tokyo").alias("tokyo_date"),
    )


def protocol_dimension_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = protocol_dimension(spark, standin.contracts())
    parties = standin.plain_ledger(spark, sf_dir).select(
        F.explode(F.array(F.lower("from"), F.lower("to"))).alias("address")
    )
    counts = parties.groupBy("address").agg(F.count("*").alias("contacts"))
    return listed.join(counts, "address").select(
        "category", "protocol", "address", "contacts"
    )


def category_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = standin.ledger(spark, sf_dir)
    return flagged.select(
        F.col("log_pos").alias("event_id"),
        "is_defi_transaction",
        "is_rollup_transaction",
        contacts.either_flag().alias("is_either"),
    )


def category_flags_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.ledger_li(spark, sf_dir).select(
        "tx_hash", "from", "amount", "is_defi_transaction", "is_rollup_transaction"
    )


def touching_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = standin.supplier_dimension(spark, sf_dir).where(F.col("category") == "defi")
    touched = contacts.touching(standin.plain_ledger_li(spark, sf_dir), listed)
    return touched.select("asset", "date", "tx_hash", "from", "amount")


def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.daily_volume(standin.plain_ledger(spark, sf_dir)))


def daily_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_transactions(standin.plain_ledger(spark, sf_dir))


def daily_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_addresses(standin.plain_ledger(spark, sf_dir))


def daily_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_categories(standin.ledger(spark, sf_dir))


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.daily_stats(standin.ledger(spark, sf_dir)))


def daily_stats_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.daily_stats(standin.ledger_li(spark, sf_dir)))


def daily_stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    transfers = decode_with_headers(spark, sf_dir)
    return comparable(rollups.daily_stats(transfers, single_pass=True))


def overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = comparable(rollups.overall_stats(standin.ledger(spark, sf_dir)))
    return totals.with_labels(stats, _registry(spark))


def overall_stats_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.overall_stats(standin.ledger_li(spark, sf_dir)))


def transfers_per_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.transfers_per_asset(
        standin.plain_ledger(spark, sf_dir), _registry(spark)
    )


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.chunk_counts(
        standin.plain_ledger(spark, sf_dir), *_block_range(spark, sf_dir), CHUNK
    )


def block_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = standin.raw_headers(spark, sf_dir)
    return totals.block_coverage(spark, headers, *_block_range(spark, sf_dir), CHUNK)


def missing_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = standin.raw_headers(spark, sf_dir)
    return totals.missing_blocks(spark, headers, *_block_range(spark, sf_dir))


def _daily_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.ledger_stats(standin.ledger(spark, sf_dir), rollups.DAILY_KEYS))


def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = report.summary_stats(_daily_rounded(spark, sf_dir))
    shown = [
        c for c in summary.columns if c.startswith("avg_daily_") and c != "avg_daily_volume"
    ]
    return summary.withColumns(
        {
            "total_volume": F.round("total_volume", 2),
            "avg_daily_volume": F.round("avg_daily_volume", 4),
            **{c: whole_number(F.col(c)) for c in shown},
        }
    )


def loaded_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.loaded_assets(_daily_rounded(spark, sf_dir))


def chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = report.chart_series(_daily_rounded(spark, sf_dir))
    return series.withColumn("log10_value", F.round("log10_value", 9))


def _table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.ledger(spark, sf_dir).select(
        *[
            (F.lit(None) if f.name in ("amount_raw", "amount_hex") else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in TRANSFERS.fields
        ]
    )


def transfers_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table, CSV export, and back from CSV."""
    folder = working_folder(spark, "transfers")
    table = f"{folder}/table"
    write_transfers(_table_shape(spark, sf_dir), table)
    export_transfers_csv(spark, table, folder, standin.ASSETS)
    return read_transfers_csv(spark, f"{folder}/*_transfers.csv")


def transfers_csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "counts")
    write_transfers(_table_shape(spark, sf_dir), f"{folder}/table")
    export_transfers_csv(spark, f"{folder}/table", folder, standin.ASSETS)
    return count_transfers_csv(spark, f"{folder}/*_transfers.csv")


def daily_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table, CSV per asset, and back by name.

    The average is left out: its two decimals are cut at ties by the rule of
    ``money_text``, which the tests check against exact arithmetic.
    """
    folder = working_folder(spark, "daily")
    daily = rollups.ledger_stats(standin.ledger(spark, sf_dir), rollups.DAILY_KEYS)
    write_daily(daily, f"{folder}/table")
    export_daily_csv(spark, f"{folder}/table", folder, standin.ASSETS)
    return read_daily_csv(spark, f"{folder}/*_daily_stats.csv").drop("avg_transfer_size")


def _uneven_daily_csv(spark: SparkSession, sf_dir: str) -> str:
    """Daily CSV where some assets lack columns: one lacks a required one."""
    folder = working_folder(spark, "uneven")
    daily = rollups.ledger_stats(standin.ledger(spark, sf_dir), rollups.DAILY_KEYS)
    write_daily(daily, f"{folder}/table")
    stored = spark.read.parquet(f"{folder}/table")
    absent = {
        "click": ["different_addresses"],
        "error": ["transaction_count"],
        "purchase": ["defi_transaction_count", "rollup_transaction_count"],
    }
    for asset in standin.ASSETS:
        view = daily_export_view(stored, asset).drop(*absent.get(asset, []))
        view.coalesce(1).write.option("header", True).csv(f"{folder}/{asset}_daily_stats.csv")
    return f"{folder}/*_daily_stats.csv"


def optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = read_daily_csv(spark, _uneven_daily_csv(spark, sf_dir))
    return daily.drop("avg_transfer_size", "transfer_count")


def skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = daily_csv_files(spark, _uneven_daily_csv(spark, sf_dir))
    return files.select("asset", "reason")


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger landed as six files and taken in three at a time."""
    folder = working_folder(spark, "incremental")
    landed = f"{folder}/landed"
    # by transaction, so that every file brings rows for every date
    _table_shape(spark, sf_dir).repartition(6, "tx_hash").write.parquet(landed)
    source = (
        spark.readStream.schema(spark.read.parquet(landed).schema)
        .option("maxFilesPerTrigger", 3)
        .parquet(landed)
    )
    tables = LedgerTables(f"{folder}/ledger")
    run_incremental(source, tables)
    return comparable(stored_daily(spark, tables))


def _landed_blocks(spark: SparkSession, sf_dir: str) -> str:
    """Blocks as lines of JSON; of every fifty one is cut off, one has a block number as text,
    and one a null receipt list."""
    folder = working_folder(spark, "landed")
    case = F.col("event_id") % 50
    blocks = standin.raw_blocks(spark, sf_dir)
    receipts = F.when(case != 9, F.col("receipts")).alias("receipts")
    options = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct("block_number", "timestamp", receipts), options)
    number = block_key(F.col("block_number")).alias("block_number")
    as_text = F.to_json(F.struct(number, "timestamp", receipts), options)
    line = F.when(case == 7, F.left(whole, F.lit(30))).when(case == 8, as_text).otherwise(whole)
    blocks.select(line.alias("value")).write.text(folder)
    return folder


def landed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_blocks(spark, _landed_blocks(spark, sf_dir))
    return rows.select("block_number", "timestamp", F.size("receipts").alias("receipts")).withColumn(
        "receipts", F.when(F.col("receipts") >= 0, F.col("receipts"))
    )


def landed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_headers(spark, _landed_blocks(spark, sf_dir))
    return rows.groupBy("block_number").agg(
        F.count("*").alias("records"), F.min("timestamp").alias("timestamp")
    )


def corrupt_landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corrupt_records(spark, _landed_blocks(spark, sf_dir))
    return found.groupBy(F.left("record", F.lit(30)).alias("begins"), "reason").agg(
        F.count("*").alias("records")
    )


def incremental_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecoded blocks in two batches with bad logs, the first of which comes twice."""
    folder = working_folder(spark, "incremental-raw")
    blocks = standin.raw_blocks(spark, sf_dir)
    tables, registry = LedgerTables(f"{folder}/ledger"), _registry(spark)
    even = F.col("event_id") % 2 == 0
    for batch_id, batch in ((0, even), (1, ~even), (0, even)):
        logs = decode.decode_logs(blocks.where(batch).drop("event_id"), registry)
        apply_batch(decode.accepted_and_rejected(logs, standin.contracts()), batch_id, tables)
    daily = stored_daily(spark, tables).groupBy("asset").agg(
        F.count("*").alias("days"), F.sum("transfer_count").alias("transfers")
    )
    rejects = stored_rejects(spark, tables).groupBy("asset").agg(F.count("*").alias("rejects"))
    return daily.join(rejects, "asset", "full")


BATCHES = 16


def incremental_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ledger, dated by its month, in sixteen batches that all touch the same dates, to two levels of merged runs."""
    folder = working_folder(spark, "incremental-levels")
    landed = f"{folder}/landed"
    month = F.trunc("date", "month").alias("date")
    rows = _table_shape(spark, sf_dir).withColumn("batch", F.pmod(F.xxhash64("tx_hash", "log_pos"), F.lit(BATCHES)))
    rows.withColumn("date", month).write.partitionBy("batch").parquet(landed)
    tables = LedgerTables(f"{folder}/ledger")
    for batch_id in range(BATCHES):
        batch = spark.read.schema(TRANSFERS).parquet(f"{landed}/batch={batch_id}")
        apply_batch(batch, batch_id, tables)
    return comparable(stored_daily(spark, tables))


def incremental_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all dates; then the second comes again, without the odd days it had.

    By then its first rows are in merged runs.
    """
    folder = working_folder(spark, "incremental-replay")
    landed = f"{folder}/landed"
    batch = F.pmod("log_pos", F.lit(4)).alias("batch")
    _table_shape(spark, sf_dir).withColumn("batch", batch).write.partitionBy("batch").parquet(landed)
    tables = LedgerTables(f"{folder}/ledger")
    for batch_id in (0, 1, 2, 3, 1):
        rows = spark.read.schema(TRANSFERS).parquet(f"{landed}/batch={batch_id}")
        again = batch_id == 1 and bool(partition_folders(spark, tables.transfers, "date", "batch_id=1"))
        apply_batch(rows.where(F.day("date") % 2 == 0) if again else rows, batch_id, tables, fan=2)
    return comparable(stored_daily(spark, tables))


def _landed_stream(spark: SparkSession, sf_dir: str, folder: str, files: int) -> DataFrame:
    """The ledger landed as files that each have rows for every date, taken in three at a time."""
    landed = f"{folder}/landed"
    _table_shape(spark, sf_dir).repartition(files, "tx_hash").write.parquet(landed)
    reader = spark.readStream.schema(spark.read.parquet(landed).schema)
    return reader.option("maxFilesPerTrigger", 3).parquet(landed)


def stateful_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six files through the state store."""
    folder = working_folder(spark, "stateful")
    tables = StateTables(f"{folder}/figures")
    run_stateful(_landed_stream(spark, sf_dir, folder, 6), tables)
    return comparable(state_daily(spark, tables))


def address_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unions of stored daily sketches by month and whole range, beside the exact counts.

    An estimate must lie within four standard errors (and one address) of the exact count.
    """
    folder = working_folder(spark, "sketches")
    rows = standin.plain_ledger(spark, sf_dir)
    sketches.write_sketches(sketches.address_sketches(rows), folder)
    stored = sketches.read_sketches(spark, folder)

    def ranged(frame: DataFrame, span: Column) -> DataFrame:
        return frame.withColumn("span", span)

    def checked(span: Column) -> DataFrame:
        by = ("asset", "span")
        guess = sketches.estimated(sketches.unite_sketches(ranged(stored, span), by))
        exact = rollups.address_stats(ranged(rows, span), by)
        error = F.abs(F.col("estimated_addresses") - F.col("different_addresses"))
        allowed = F.lit(4 * sketches.standard_error()) * F.col("different_addresses") + 1
        return exact.join(guess, list(by)).select(*by, "different_addresses", (error <= allowed).alias("close"))

    return checked(F.date_format("date", "yyyy-MM")).union(checked(F.lit("all")))


def overall_stats_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by bitmaps: stored by day in two halves of the orders, then united."""
    tables = bitmaps.BitmapTables(working_folder(spark, "bitmaps"))
    rows = standin.ledger_li(spark, sf_dir).withColumn("block_number", F.unix_date("date"))
    early = F.year("date") < 1995
    for half in (early, ~early):
        bitmaps.store_days(rows.where(half), tables, period="year")
    return comparable(bitmaps.bitmap_stats(*bitmaps.read_days(spark, tables)))


def stats_by_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rollups.stats_by_sets(standin.ledger_li(spark, sf_dir)))


def category_flags_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for a contract table too large to broadcast: probed, then looked up."""
    flagged = contacts.flag_contacts_from_table(
        standin.plain_ledger_li(spark, sf_dir), standin.supplier_dimension(spark, sf_dir), broadcast=False
    )
    return flagged.select("tx_hash", "from", "amount", "is_defi_transaction", "is_rollup_transaction")


def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In stretches of seven blocks, so that gaps run over their borders."""
    headers = standin.raw_headers(spark, sf_dir)
    start, end = _block_range(spark, sf_dir)
    return totals.missing_intervals(headers.union(headers), start - 20, end + 3, stretch=7)


def block_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks stored by ranges of forty and read back for the middle third of their numbers."""
    folder = working_folder(spark, "ranges")
    write_block_ranges(standin.raw_blocks(spark, sf_dir).drop("event_id"), folder, 40)
    low, high = _block_range(spark, sf_dir)
    third = (high - low) // 3
    rows = read_block_ranges(spark, folder, BLOCKS, low + third, high - third)
    return rows.groupBy("block_number").agg(
        F.count("*").alias("records"), F.sum(F.size("receipts")).alias("receipts")
    )


def block_time_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header join over buckets, with its crowded blocks apart."""
    folder = working_folder(spark, "buckets")
    name = "ledgerline_" + folder.rsplit("-", 1)[-1]
    receipts = write_bucketed(standin.raw_receipts(spark, sf_dir), f"{name}_receipts", f"{folder}/receipts", 8)
    headers = standin.raw_headers(spark, sf_dir)
    twice = headers.union(headers.where(F.col("block_number") % 5 == 0))
    stored = write_bucketed(twice, f"{name}_headers", f"{folder}/headers", 8)
    events = decode.transfer_events(decode.explode_logs(receipts)).select("event_id", "block_number")
    return attach_bucketed_time(events, stored, hot_blocks(receipts))


def overall_euro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-range figures where the token of purchases is the euro one."""
    tokens = [(a, c, d, "EURC" if a == "purchase" else s, e) for a, c, d, s, e in standin.token_rows()]
    stats = rollups.overall_stats(standin.ledger(spark, sf_dir))
    labelled = totals.with_labels(stats, token_registry(spark, None, tokens))
    shown = F.concat("currency", money_text(F.col("total_volume"))).alias("shown_volume")
    return labelled.select("asset", "symbol", "currency", "transfer_count", shown)


def series_lacking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart points of files that lack columns."""
    daily = read_daily_csv(spark, _uneven_daily_csv(spark, sf_dir))
    series = report.chart_series(daily)
    return series.withColumn("log10_value", F.round("log10_value", 9))


def summary_lacking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary figures of files that lack columns."""
    daily = read_daily_csv(spark, _uneven_daily_csv(spark, sf_dir))
    return report.summary_stats(daily).select(
        "asset", "days", F.round("total_volume", 2).alias("total_volume"), "total_transactions",
        "max_daily_addresses", "max_daily_defi_transactions", "max_daily_rollup_transactions",
        *[
            whole_number(F.col(f"avg_daily_{m}")).alias(f"avg_daily_{m}")
            for m in ("addresses", "defi_transactions", "rollup_transactions")
        ],
    )


def _odd_daily_csv(spark: SparkSession, sf_dir: str) -> str:
    """Daily CSV with a quoted note full of commas; a figure of some assets is no number."""
    folder = working_folder(spark, "odd")
    daily = rollups.ledger_stats(standin.ledger(spark, sf_dir), rollups.DAILY_KEYS)
    write_daily(daily, f"{folder}/table")
    stored = spark.read.parquet(f"{folder}/table")
    first = F.col("date") == F.lit(stored.agg(F.min("date")).first()[0])
    spoilt = {"view": "total_volume_view", "signup": "transfer_count", "error": "different_addresses"}
    for asset in standin.ASSETS:
        view = daily_export_view(stored, asset).withColumn("note", F.lit('a, "b", c'))
        if asset in spoilt:
            column = spoilt[asset]
            # an empty figure is missing and no fault
            odd = F.lit("") if asset == "error" else F.lit("1,234.50")
            view = view.withColumn(column, F.when(first, odd).otherwise(F.col(column).cast("string")))
        front = ["note", *[c for c in view.columns if c != "note"]]
        writer = view.select(front).coalesce(1).write.option("header", True).option("escape", '"')
        writer.csv(f"{folder}/{asset}_daily_stats.csv")
    return f"{folder}/*_daily_stats.csv"


def odd_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each file with the rows and figures that are read from it."""
    paths = _odd_daily_csv(spark, sf_dir)
    rows = read_daily_csv(spark, paths).groupBy("asset").agg(
        F.count("*").alias("days"),
        F.sum("transfer_count").alias("transfers"),
        F.count("different_addresses").alias("days_with_addresses"),
    )
    return daily_csv_files(spark, paths).select("asset", "reason").join(rows, "asset", "left")


QUERIES: dict[str, Query] = {
    "decode_transfers": decode_transfers,
    "decode_with_headers": decode_with_headers,
    "rejected_logs": rejected_logs,
    "decode_wide_amounts": decode_wide_amounts,
    "extract_job": extract_job,
    "landed_blocks": landed_blocks,
    "landed_headers": landed_headers,
    "corrupt_records": corrupt_landed_records,
    "block_hex_keys": block_hex_keys,
    "event_filter": event_filter,
    "asset_attribution": asset_attribution,
    "block_time_join": block_time_join,
    "asset_selection": asset_selection,
    "block_range": block_range,
    "epoch_date": epoch_dates,
    "protocol_dimension": protocol_dimension_contacts,
    "category_flags": category_flags,
    "category_flags_dim": category_flags_dim,
    "touching_semi": touching_dim,
    "daily_volume": daily_volume,
    "daily_transactions": daily_transactions,
    "daily_addresses": daily_addresses,
    "daily_categories": daily_categories,
    "daily_stats": daily_stats,
    "daily_stats_li": daily_stats_li,
    "daily_stats_raw": daily_stats_raw,
    "overall_stats": overall_stats,
    "overall_stats_li": overall_stats_li,
    "transfers_per_asset": transfers_per_asset,
    "chunk_counts": chunk_counts,
    "block_coverage": block_coverage,
    "missing_blocks": missing_blocks,
    "summary_stats": summary_stats,
    "loaded_assets": loaded_assets,
    "chart_series": chart_series,
    "transfers_roundtrip": transfers_roundtrip,
    "transfers_csv_counts": transfers_csv_counts,
    "daily_csv_roundtrip": daily_csv_roundtrip,
    "optional_columns": optional_columns,
    "skipped_files": skipped_files,
    "incremental_daily": incremental_daily,
    "incremental_raw": incremental_raw,
    "incremental_levels": incremental_levels,
    "incremental_replay": incremental_replay,
    "stateful_daily": stateful_daily,
    "address_estimates": address_estimates,
    "overall_stats_bitmap": overall_stats_bitmap,
    "stats_by_sets": stats_by_sets,
    "category_flags_filtered": category_flags_filtered,
    "missing_intervals": missing_intervals,
    "overall_euro": overall_euro,
    "series_lacking_metrics": series_lacking_metrics,
    "summary_lacking_metrics": summary_lacking_metrics,
    "odd_figures": odd_figures,
    "block_layout": block_layout,
    "block_time_bucketed": block_time_bucketed,
}

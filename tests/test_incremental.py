import datetime as dt

import pytest
from pyspark.sql import functions as F

import brute
import golden
from ledgerline.operators import decode, rollups
from ledgerline.schemas import BLOCKS, TRANSFERS
from ledgerline.sources.registry import token_registry
from ledgerline.streaming import compaction
from ledgerline.streaming.compaction import Run, due, live_runs, stored_runs
from ledgerline.streaming.incremental import (
    LedgerTables,
    apply_batch,
    run_incremental,
    stored_daily,
    stored_transfers,
)


def shape(frame):
    absent = [f for f in TRANSFERS if f.name not in frame.columns]
    full = frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return full.select(*TRANSFERS.fieldNames())


def daily_of(frame):
    names = ["total_volume", "transaction_count", "transfer_count", "avg_transfer_size",
             "different_addresses", "defi_transaction_count", "rollup_transaction_count"]
    return {(r.asset, r.date): tuple(r[n] for n in names) for r in frame.collect()}


@pytest.fixture(scope="module")
def rows():
    return brute.random_ledger(9, 600)


def test_any_file_split_equals_the_batch_answer(spark, rows, tmp_path):
    landed = str(tmp_path / "landed")
    # two files by date, then one with rows for every date
    rows = sorted(rows, key=lambda r: r[1])
    late = rows[::7]
    rest = [r for i, r in enumerate(rows) if i % 7]
    tables = LedgerTables(str(tmp_path / "ledger"))

    def land(part):
        frame = shape(spark.createDataFrame(part, brute.COLUMNS)).coalesce(1)
        frame.write.mode("append").parquet(landed)

    def run():
        source = spark.readStream.schema(TRANSFERS).option("maxFilesPerTrigger", 1)
        run_incremental(source.parquet(landed), tables)
        return daily_of(stored_daily(spark, tables))

    land(rest[:250])
    land(rest[250:])
    key = lambda r: (r[0], r[1])
    assert run() == brute.stats(rest, key)
    land(late)
    assert run() == brute.stats(rows, key)
    assert stored_transfers(spark, tables).count() == len(rows)
    assert run() == brute.stats(rows, key)  # nothing new


def test_a_repeated_batch_counts_once(spark, rows, tmp_path):
    tables = LedgerTables(str(tmp_path / "ledger"))
    frame = shape(spark.createDataFrame(rows, brute.COLUMNS))
    apply_batch(frame.limit(200), 0, tables)
    apply_batch(frame.exceptAll(frame.limit(200)), 1, tables)
    once = daily_of(stored_daily(spark, tables))
    apply_batch(frame.exceptAll(frame.limit(200)), 1, tables)
    assert daily_of(stored_daily(spark, tables)) == once
    assert stored_transfers(spark, tables).count() == len(rows)


def test_untouched_dates_stay(spark, tmp_path):
    tables = LedgerTables(str(tmp_path / "ledger"))
    one, two = dt.date(2025, 6, 1), dt.date(2025, 6, 2)
    row = ("usdc", one, "t", brute.address(1), brute.address(2), 1.0, False, False)
    apply_batch(shape(spark.createDataFrame([row], brute.COLUMNS)), 0, tables)
    later = ("usdt", two, *row[2:])
    apply_batch(shape(spark.createDataFrame([later], brute.COLUMNS)), 1, tables)
    assert sorted(daily_of(stored_daily(spark, tables))) == [("usdc", one), ("usdt", two)]


def test_blocks_are_decoded_on_the_way(spark, tmp_path):
    path = golden.land(tmp_path, "blocks", golden.blocks())
    source = spark.readStream.schema(BLOCKS).option("maxFilesPerTrigger", 1).json(path)
    tables = LedgerTables(str(tmp_path / "ledger"))
    registry = token_registry(spark)
    # the second file holds blocks without any transfer
    run_incremental(source, tables, lambda b: decode.decode_transfers(b, registry))
    got = stored_daily(spark, tables).orderBy("asset", "date").collect()
    assert [(r.asset, str(r.date), r.total_volume, r.transaction_count) for r in got] == [
        d[:4] for d in golden.DAILY
    ]
    batch = decode.decode_transfers(spark.read.schema(BLOCKS).json(path), registry)
    assert daily_of(rollups.daily_stats(batch)) == daily_of(stored_daily(spark, tables))


def batches_of(spark, rows, count, tmp_path):
    """Batch frames by number, and the rows of each."""
    parts = [rows[k::count] for k in range(count)]
    return [shape(spark.createDataFrame(p, brute.COLUMNS)) for p in parts], parts


def by_day(rows):
    return brute.stats(rows, lambda r: (r[0], r[1]))


def test_runs_stay_few_and_figures_exact(spark, rows, tmp_path):
    day = dt.date(2025, 6, 1)
    rows = [(r[0], day, *r[2:]) for r in rows]
    frames, parts = batches_of(spark, rows, 10, tmp_path)
    tables = LedgerTables(str(tmp_path / "ledger"))
    for number, frame in enumerate(frames):
        apply_batch(frame, number, tables, fan=2)
        runs = stored_runs(spark, tables.partials, [str(day)])
        assert sorted(runs) == live_runs(runs)  # what was replaced is gone
        assert len(runs) <= 4  # fan - 1 on each of four levels
    assert sum(r.last - r.first + 1 for r in runs) == 10
    assert daily_of(stored_daily(spark, tables)) == by_day(rows)


def test_a_replay_reaches_into_merged_runs(spark, rows, tmp_path):
    frames, parts = batches_of(spark, rows, 6, tmp_path)
    tables = LedgerTables(str(tmp_path / "ledger"))
    for number, frame in enumerate(frames):
        apply_batch(frame, number, tables, fan=2)
    assert daily_of(stored_daily(spark, tables)) == by_day(rows)
    # the second batch comes again with fewer rows, fewer dates, and a date of its own
    first = min(r[1] for r in rows)
    fewer = [r for r in parts[1] if r[1] != first][::2] + [("usdc", dt.date(2025, 7, 7), *parts[1][0][2:])]
    apply_batch(shape(spark.createDataFrame(fewer, brute.COLUMNS)), 1, tables, fan=2)
    want = [r for k, p in enumerate(parts) if k != 1 for r in p] + fewer
    assert daily_of(stored_daily(spark, tables)) == by_day(want)
    assert stored_transfers(spark, tables).count() == len(want)


def test_a_replay_with_fewer_dates_empties_the_others(spark, rows, tmp_path):
    tables = LedgerTables(str(tmp_path / "ledger"))
    apply_batch(shape(spark.createDataFrame(rows, brute.COLUMNS)), 0, tables)
    day = max(r[1] for r in rows)
    left = [r for r in rows if r[1] == day]
    apply_batch(shape(spark.createDataFrame(left, brute.COLUMNS)), 0, tables)
    assert daily_of(stored_daily(spark, tables)) == by_day(left)
    nothing = shape(spark.createDataFrame(rows[:1], brute.COLUMNS)).where("false")
    apply_batch(nothing, 0, tables)
    assert stored_transfers(spark, tables).count() == 0
    assert daily_of(stored_daily(spark, tables)) == {}


@pytest.mark.parametrize("step", ["_renew_runs", "compact", "_merge_days"])
def test_a_failed_replay_is_completed_by_the_next(spark, rows, tmp_path, monkeypatch, step):
    from ledgerline.streaming import incremental

    tables = LedgerTables(str(tmp_path / "ledger"))
    frames, parts = batches_of(spark, rows, 3, tmp_path)
    for number, frame in enumerate(frames):
        apply_batch(frame, number, tables, fan=2)
    day = max(r[1] for r in rows)
    left = [r for r in parts[0] if r[1] == day]
    again = shape(spark.createDataFrame(left, brute.COLUMNS))

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(incremental, step, fail)
        with pytest.raises(RuntimeError):
            apply_batch(again, 0, tables, fan=2)
    apply_batch(again, 0, tables, fan=2)
    assert daily_of(stored_daily(spark, tables)) == by_day([*left, *parts[1], *parts[2]])


def test_a_replaced_run_does_not_count(spark, rows, tmp_path, monkeypatch):
    """A failure after the merged run is there and before what it replaces is deleted."""
    tables = LedgerTables(str(tmp_path / "ledger"))
    frames, _ = batches_of(spark, rows, 3, tmp_path)
    monkeypatch.setattr(compaction, "remove_folder", lambda *a: None)
    for number, frame in enumerate(frames):
        apply_batch(frame, number, tables, fan=2)
    date = str(rows[0][1])
    runs = stored_runs(spark, tables.partials, [date])
    assert len(live_runs(runs)) < len(runs)
    assert daily_of(stored_daily(spark, tables)) == by_day(rows)


def test_which_runs_are_merged():
    zero = [Run("d", k, k, 0) for k in range(5)]
    assert due(zero[:3], 4) == {}
    assert due(zero, 4) == {Run("d", 0, 4, 1): zero}
    assert live_runs([*zero, Run("d", 0, 3, 1)]) == [Run("d", 0, 3, 1), zero[4]]
    assert live_runs([*zero, Run("e", 0, 4, 1)]) == [*zero, Run("e", 0, 4, 1)]

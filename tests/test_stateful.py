"""Statistics in the state store against the batch answer, and late rows under a watermark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import brute
from ledgerline.operators.rollups import daily_stats
from ledgerline.schemas import TRANSFERS
from ledgerline.streaming.stateful import STATE_SETTINGS, StateTables, run_stateful, state_daily
from test_incremental import daily_of, shape

KEY = lambda r: (r[0], r[1])


def timed(spark, rows):
    """Rows with a block time at noon of their date."""
    frame = shape(spark.createDataFrame(rows, brute.COLUMNS))
    noon = F.unix_date("date").cast("long") * 86400 + 43200
    return frame.withColumn("timestamp", noon).select(*TRANSFERS.fieldNames())


def land(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(TRANSFERS).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("settings", [{}, STATE_SETTINGS])
def test_off_equals_the_batch_answer(spark, tmp_path, settings):
    rows = brute.random_ledger(3, 400)
    landed, tables = str(tmp_path / "landed"), StateTables(str(tmp_path / "state"))
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        land(timed(spark, rows[:150]), landed)
        land(timed(spark, rows[150:300]), landed)
        assert run_stateful(stream(spark, landed), tables) == {"sums": 0, "counts": 0}
        assert daily_of(state_daily(spark, tables)) == brute.stats(rows[:300], KEY)
        # keys seen in the first run are known in the second
        land(timed(spark, rows[300:]), landed)
        run_stateful(stream(spark, landed), tables)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert daily_of(state_daily(spark, tables)) == brute.stats(rows, KEY)
    assert daily_of(state_daily(spark, tables)) == daily_of(daily_stats(timed(spark, rows)))


def test_on_closes_old_days_and_counts_what_comes_late(spark, tmp_path):
    rows = brute.random_ledger(8, 120)
    start = dt.date(2025, 6, 1)
    days = [[(r[0], start + dt.timedelta(days=7 * d), *r[2:]) for r in rows[d::3]] for d in range(3)]
    landed, tables = str(tmp_path / "landed"), StateTables(str(tmp_path / "state"))

    def run():
        return run_stateful(stream(spark, landed), tables, lateness="2 days")

    for day in days:
        land(timed(spark, day), landed)
        assert run() == {"sums": 0, "counts": 0}
    late = days[0][:5]
    land(timed(spark, late), landed)
    dropped = run()
    # of each transfer the transaction and both addresses, and the flags that it has
    assert dropped["counts"] == 15 + sum(r[6] + r[7] for r in late)
    assert 1 <= dropped["sums"] <= 5
    assert daily_of(state_daily(spark, tables)) == brute.stats([r for d in days for r in d], KEY)


def test_missing_keys_count_as_in_the_batch(spark, tmp_path):
    day = dt.date(2025, 6, 1)
    rows = [
        ("usdc", day, None, brute.address(1), None, 1.0, False, None),
        ("usdc", day, None, brute.address(1), brute.address(2), 2.0, None, True),
    ]
    landed, tables = str(tmp_path / "landed"), StateTables(str(tmp_path / "state"))
    land(timed(spark, rows), landed)
    run_stateful(stream(spark, landed), tables)
    assert daily_of(state_daily(spark, tables)) == daily_of(daily_stats(timed(spark, rows)))

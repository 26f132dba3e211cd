"""Bitmaps over dense numbers: any range of days against brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import brute
from ledgerline.operators import bitmaps, rollups
from test_rollups import as_dict, plan_of


@pytest.fixture(scope="module")
def rows():
    extra = [
        ("usdc", dt.date(2025, 6, 2), None, brute.address(1), None, 0.25, True, None),
        ("usdc", dt.date(2025, 6, 2), None, None, None, 0.5, None, False),
        ("usdc", dt.date(2025, 6, 3), None, None, None, 0.5, None, False),
        ("only", dt.date(2025, 6, 3), "t1", None, None, 1.0, None, None),
    ]
    return brute.random_ledger(11, 2000) + extra


def frame(spark, rows):
    return spark.createDataFrame(rows, brute.COLUMNS).withColumn("block_number", F.unix_date("date")).repartition(5)


def exact(spark, rows, by):
    return as_dict(rollups.ledger_stats(frame(spark, rows), by), len(by))


def test_days_ranges_and_all(spark, rows, tmp_path):
    tables = bitmaps.BitmapTables(str(tmp_path))
    cut = dt.date(2025, 6, 3)
    bitmaps.store_days(frame(spark, [r for r in rows if r[1] < cut]), tables)
    bitmaps.store_days(frame(spark, [r for r in rows if r[1] >= cut]), tables)
    # a day that is stored again stays one day, and its keys keep their numbers
    bitmaps.store_days(frame(spark, [r for r in rows if r[1] == cut]), tables)
    tx, addresses = bitmaps.read_days(spark, tables)
    for by in (("asset",), ("asset", "date")):
        assert as_dict(bitmaps.bitmap_stats(tx, addresses, by), len(by)) == exact(spark, rows, by)
    first, last = dt.date(2025, 6, 2), dt.date(2025, 6, 4)
    within = F.col("date").between(first, last)
    got = bitmaps.bitmap_stats(tx.where(within), addresses.where(within))
    assert as_dict(got, 1) == exact(spark, [r for r in rows if first <= r[1] <= last], ("asset",))


def test_numbers_have_no_holes_and_stay(spark, tmp_path):
    path = str(tmp_path / "numbers")
    keys = [(f"k{n % 70}", n) for n in range(200)] + [(None, 1)]
    early = spark.createDataFrame(keys, "key string, place int")
    first = {r.key: r.number for r in bitmaps.add_numbers(early, path).collect()}
    assert sorted(first.values()) == list(range(70))
    # in the order of their first place
    assert [first[f"k{n}"] for n in range(70)] == list(range(70))
    more = spark.createDataFrame([("k3", 0), ("new", 5), ("newer", 6)], "key string, place int")
    second = {r.key: r.number for r in bitmaps.add_numbers(more, path).collect()}
    assert {k: second[k] for k in first} == first
    assert (second["new"], second["newer"]) == (70, 71)
    assert len(bitmaps.add_numbers(more.limit(0), path).collect()) == 72


def test_ranges_read_no_hashes(spark, rows, tmp_path):
    tables = bitmaps.BitmapTables(str(tmp_path))
    bitmaps.store_days(frame(spark, rows), tables, period="month")
    plan = plan_of(bitmaps.bitmap_stats(*bitmaps.read_days(spark, tables)))
    assert "tx_hash" not in plan and "numbers" not in plan and "bitmap_or_agg" in plan


def test_numbers_are_moved_and_not_bitmaps(spark, rows, tmp_path):
    ledger = frame(spark, rows)
    numbers = spark.createDataFrame([(f"t{n}", n) for n in range(9)], "key string, number long")
    for made in (bitmaps.transaction_bitmaps(ledger, numbers), bitmaps.address_bitmaps(ledger, numbers)):
        whole = plan_of(made).split("partial_bitmap_construct_agg")
        # from the first bitmap on nothing is exchanged or sorted, and rows come in order of the day
        assert len(whole) > 1 and "Exchange" not in whole[0] and "Sort [" not in whole[0]
        assert made.columns[:3] == ["asset", "date", "bucket"]


def test_sets_equal_daily_and_overall(spark, rows):
    ledger = frame(spark, [*rows, ("nodate", None, "t", brute.address(1), brute.address(2), 1.0, True, True)])
    got = {}
    for r in rollups.stats_by_sets(ledger).collect():
        got[(r.is_total, r.asset, r.date)] = tuple(r)[3:]
    want = {(False, *k): v for k, v in as_dict(rollups.daily_stats(ledger), 2).items()}
    # a join leaves a missing date out; the sets keep it
    nodate = got.pop((False, "nodate", None))
    want |= {(True, k[0], None): v for k, v in as_dict(rollups.overall_stats(ledger), 1).items()}
    assert got == {k: v for k, v in want.items() if k != (False, "nodate", None)} and nodate[0] == 1.0
    assert plan_of(rollups.stats_by_sets(ledger)).count("Scan ExistingRDD") == 1


def test_sets_move_each_key_once(spark, rows):
    # the keys, then the counts
    assert plan_of(rollups.stats_by_sets(frame(spark, rows))).count("Exchange hashpartitioning") == 2

import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from ledgerline.operators import contacts, rollups, sizing


@pytest.fixture(scope="module")
def rows():
    return brute.random_ledger(5, 3000)


@pytest.fixture(scope="module")
def ledger(spark, rows):
    return spark.createDataFrame(rows, brute.COLUMNS).repartition(6).cache()


def as_dict(frame, keys):
    return {tuple(r)[:keys]: tuple(r)[keys:] for r in frame.collect()}


@pytest.mark.parametrize("single_pass", [False, True])
def test_daily_equals_brute_force_with_hot_keys(ledger, rows, single_pass):
    got = rollups.daily_stats(ledger, single_pass)
    assert as_dict(got, 2) == brute.stats(rows, lambda r: (r[0], r[1]))
    keys = [(r.asset, r.date) for r in got.collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize("single_pass", [False, True])
def test_overall_equals_brute_force(ledger, rows, single_pass):
    got = rollups.overall_stats(ledger, single_pass)
    assert as_dict(got, 1) == brute.stats(rows, lambda r: (r[0],))


def test_single_figures_agree_with_daily(ledger, rows):
    want = brute.stats(rows, lambda r: (r[0], r[1]))
    assert as_dict(rollups.daily_volume(ledger), 2) == {
        k: (v[0], v[2], v[3]) for k, v in want.items()
    }
    assert as_dict(rollups.daily_transactions(ledger), 2) == {k: (v[1],) for k, v in want.items()}
    assert as_dict(rollups.daily_addresses(ledger), 2) == {k: (v[4],) for k, v in want.items()}
    assert as_dict(rollups.daily_categories(ledger), 2) == {
        k: v[5:7] for k, v in want.items()
    }


def test_estimated_addresses_are_close(ledger, rows):
    want = brute.stats(rows, lambda r: (r[0], r[1]))
    got = as_dict(rollups.daily_addresses(ledger, relative_error=0.02), 2)
    assert all(abs(got[k][0] - v[4]) <= 0.1 * v[4] + 1 for k, v in want.items())


def test_partials_merge_in_any_split(spark, ledger, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    pieces = [shuffled[0:100], shuffled[100:1900], shuffled[1900:]]
    stacked = None
    for piece in pieces:
        part = rollups.key_partials(spark.createDataFrame(piece, brute.COLUMNS))
        stacked = part if stacked is None else stacked.unionByName(part)
    daily, overall = rollups.daily_and_overall(stacked)
    assert as_dict(daily, 2) == brute.stats(rows, lambda r: (r[0], r[1]))
    assert as_dict(overall, 1) == brute.stats(rows, lambda r: (r[0],))


def test_bounds_between_figures(ledger):
    for r in rollups.daily_stats(ledger).collect():
        assert r.transaction_count <= r.transfer_count
        assert r.defi_transaction_count <= r.transaction_count
        assert r.rollup_transaction_count <= r.transaction_count
        assert r.different_addresses <= 2 * r.transfer_count


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_daily_plan_reads_each_column_once_and_joins_in_place(spark, ledger, tmp_path):
    ledger.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(rollups.ledger_stats(stored, ("asset", "date")))
    columns = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    read = sorted(sorted(re.findall(r"([a-z_]+)#", c)) for c in columns)
    assert read == [
        ["amount", "asset", "date", "is_defi_transaction", "is_rollup_transaction", "tx_hash"],
        ["asset", "date", "from", "to"],
    ]
    # two levels in each of two branches, and none for the join
    assert plan.count("Exchange") == 4 or "BroadcastExchange" in plan
    assert "Expand" not in plan and "partial_sum" in plan


def test_single_pass_plan_has_one_scan_and_no_join(spark, ledger, tmp_path):
    ledger.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(rollups.ledger_stats(stored, ("asset", "date"), single_pass=True))
    assert plan.count("FileScan") == 1
    assert "Expand" not in plan and "Join" not in plan
    assert plan.count("Exchange") == 2
    assert "partial_sum" in plan


FLAGS = ["is_defi_transaction", "is_rollup_transaction"]
CONTRACTS = {
    "defi": {"one": [brute.address(3)], "two": [brute.address(7).upper().replace("0X", "0x")]},
    "rollup": {"three": [brute.address(20)]},
}


def flags_of(frame):
    columns = ["asset", "date", "tx_hash", "from", "to", "amount", *FLAGS]
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_literal_flags_equal_brute_force(ledger):
    flagged = contacts.flag_contacts(ledger.drop(*FLAGS), CONTRACTS)
    assert flags_of(flagged) == flags_of(ledger)


@pytest.mark.parametrize("broadcast", [None, True, False])
def test_table_flags_equal_literal_flags(spark, ledger, broadcast):
    from ledgerline.sources.registry import protocol_dimension

    dimension = protocol_dimension(spark, CONTRACTS)
    dimension = dimension.unionByName(dimension)  # a repeated entry changes nothing
    flagged = contacts.flag_contacts_from_table(
        ledger.drop(*FLAGS), dimension, broadcast=broadcast
    )
    assert flags_of(flagged) == flags_of(ledger)
    assert ("SortMergeJoin" in plan_of(flagged)) == (broadcast is False)


@pytest.mark.parametrize("broadcast", [True, False])
def test_touching_keeps_each_transfer_once(spark, ledger, rows, broadcast):
    listed = spark.createDataFrame([(brute.address(n),) for n in (3, 1000, 3)], "address string")
    got = contacts.touching(ledger, listed, broadcast)
    wanted = {brute.address(3), brute.address(1000)}
    expected = [r for r in rows if {r[3].lower(), r[4].lower()} & wanted]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert got.columns == ledger.columns
    assert "NestedLoop" not in plan_of(got)


def test_salt_spreads_a_hot_address(spark):
    hot = spark.range(0, 4000, 1, 64).select(F.lit("a").alias("k"), "id")
    dimension = spark.createDataFrame([("a", 1)], "k string, v int")
    joined = sizing.left_lookup(hot, dimension, "k", broadcast=False, salts=16)
    salts = hot.select(F.pmod(F.spark_partition_id(), F.lit(16)).alias("s")).distinct().count()
    assert salts == 16
    assert joined.where("v = 1").count() == 4000


def test_size_is_measured(spark):
    names = spark.range(100).select(F.format_string("%040d", "id").alias("address"))
    assert sizing.fits_broadcast(names, "address")
    assert not sizing.fits_broadcast(names, "address", max_rows=99)
    assert not sizing.fits_broadcast(names, "address", max_bytes=3999)
    assert sizing.fits_broadcast(names.where("false"), "address")


def test_adaptive_join_splits_a_hot_block(spark):
    from ledgerline.operators.decode import attach_time

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        block = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        rows = spark.range(0, 60000, 1, 12).select(
            block.alias("block_number"), F.uuid().alias("tx_hash")
        )
        headers = spark.range(60000).select(
            F.col("id").alias("block_number"), F.lit("0x1").alias("timestamp")
        )
        timed = attach_time(rows, headers)
        counts = timed.groupBy("tx_hash").count()
        assert len(counts.collect()) == 60000
        assert "skew=true" in plan_of(counts)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

"""Gaps as intervals, and contact tables that are probed through a filter first."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from ledgerline.operators import contacts, sizing, totals
from test_rollups import as_dict, plan_of


def gaps(present, start, end):
    out, first = [], None
    for b in range(start, end + 2):
        absent = b <= end and b not in present
        if absent and first is None:
            first = b
        if not absent and first is not None:
            out.append((first, b - 1, b - first))
            first = None
    return out


@pytest.mark.parametrize("stretch", [1, 2, 5, 64, 1 << 15])
def test_gaps_equal_a_walk_over_all_blocks(spark, stretch):
    rng = random.Random(stretch)
    start, end = 103, 402
    for share in (0.0, 0.1, 0.9, 1.0):
        present = {b for b in range(start, end + 1) if rng.random() < share}
        rows = [(b, "0x1") for b in present for _ in range(rng.randint(1, 3))]
        rows += [(start - 1, "0x1"), (end + 1, "0x1"), (start + 1, None), (None, "0x1")]
        headers = spark.createDataFrame(rows, "block_number long, timestamp string").repartition(3)
        got = totals.missing_intervals(headers, start, end, stretch).collect()
        assert sorted(tuple(r) for r in got) == gaps(present, start, end)


def test_gaps_need_no_spine_and_one_exchange_of_headers(spark):
    headers = spark.createDataFrame([(5, "0x1")], "block_number long, timestamp string")
    plan = plan_of(totals.missing_intervals(headers, 0, 10**12))
    assert "partial_collect_set" in plan
    assert sorted(tuple(r) for r in totals.missing_intervals(headers, 0, 10**12).collect()) == [
        (0, 4, 5), (6, 10**12, 10**12 - 5),
    ]


def listed(spark, count):
    rows = [("defi" if n % 2 else "rollup", brute.address(n * 3).upper().replace("0X", "0x")) for n in range(count)]
    return spark.createDataFrame(rows, "category string, address string")


def facts(spark, size=800):
    rows = brute.random_ledger(21, size) + [
        ("usdc", None, "t", None, brute.address(3), 1.0, None, None),
        ("usdc", None, "t", None, None, 1.0, None, None),
    ]
    frame = spark.createDataFrame(rows, brute.COLUMNS).repartition(4)
    return frame.drop("is_defi_transaction", "is_rollup_transaction").withColumn("n", F.monotonically_increasing_id())


@pytest.mark.parametrize("most_words", [1, 1 << 20])
def test_filter_lets_all_matches_through(spark, most_words):
    rows = facts(spark)
    dimension = listed(spark, 30)
    keys = dimension.select(F.lower("address").alias("address"))
    words, size = sizing.key_filter(keys, "address", most_words)
    assert words.count() <= most_words
    probed = sizing.may_match(rows, {"may": F.lower("to")}, words, size)
    missed = probed.where(~F.col("may")).join(keys, F.lower("to") == F.col("address"), "left_semi")
    assert missed.count() == 0 and probed.count() == rows.count()
    assert probed.columns == [*rows.columns, "may"]


def test_filtered_flags_equal_broadcast_flags(spark):
    rows = facts(spark)
    for count in (0, 1, 25):
        dimension = listed(spark, count)
        few = contacts.flag_contacts_from_table(rows, dimension, broadcast=True)
        many = contacts.flag_contacts_from_table(rows, dimension, broadcast=False)
        order = ["tx_hash", "from", "to", "amount", "asset", "date"]
        key = lambda f: sorted(map(repr, f.select(*order, *contacts.FLAGS.values()).collect()))
        assert key(few) == key(many)
        assert contacts.touching(rows, dimension, broadcast=False).count() == contacts.touching(
            rows, dimension, broadcast=True
        ).count()


def test_only_possible_matches_are_moved(spark):
    rows = facts(spark, 3000).where("`from` IS NOT NULL").cache()
    unknown = spark.createDataFrame([("defi", f"0xabc{n:037d}") for n in range(200)], "category string, address string")
    possible, rest = contacts._possible_contacts(rows, unknown)
    assert possible.count() <= 0.1 * rows.count() and possible.count() + rest.count() == rows.count()
    plan = plan_of(contacts.flag_contacts_from_table(rows, unknown, broadcast=False))
    top = plan.split("Union")[1]
    # one side of the union has the salted joins, the other no exchange but the filter's broadcast
    assert "_salt" in top and "BroadcastHashJoin" in top

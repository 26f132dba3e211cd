"""Sketches of addresses: unions against exact counts, and what their plan moves."""

import datetime as dt

from pyspark.sql import functions as F

import brute
from ledgerline.operators import sketches


def wide_ledger(spark, per_day=4000, days=5):
    """Addresses that overlap from day to day, half of them in capitals on one side."""
    start = dt.date(2025, 6, 1)
    rows = spark.range(per_day * days).select(
        F.lit("usdc").alias("asset"),
        F.date_add(F.lit(start), (F.col("id") % days).cast("int")).alias("date"),
        F.concat(F.lit("0x"), F.lpad(F.hex(F.col("id") % 7001), 40, "0")).alias("from"),
        F.lower(F.concat(F.lit("0x"), F.lpad(F.hex(F.col("id") % 9001), 40, "0"))).alias("to"),
    )
    return rows.repartition(4)


def exact(rows):
    sides = rows.select("asset", "date", F.explode(F.array(F.lower("from"), F.lower("to"))).alias("a"))
    return sides


def test_unions_of_any_days_are_close(spark, tmp_path):
    rows = wide_ledger(spark).cache()
    path = str(tmp_path / "sketches")
    sketches.write_sketches(sketches.address_sketches(rows), path)
    sketches.write_sketches(sketches.address_sketches(rows), path)  # the same days again
    for first, last in ((None, None), ("2025-06-02", "2025-06-04"), ("2025-06-05", None)):
        stored = sketches.read_sketches(spark, path, first, last)
        [got] = sketches.estimated(sketches.unite_sketches(stored)).collect()
        within = exact(rows).where(
            F.col("date").between(F.lit(first or "2025-01-01").cast("date"), F.lit(last or "2025-12-31").cast("date"))
        )
        want = within.select("a").distinct().count()
        assert abs(got.estimated_addresses - want) <= 4 * sketches.standard_error() * want


def test_small_groups_missing_sides_and_no_rows(spark):
    day = dt.date(2025, 6, 1)
    rows = [
        ("usdc", day, "t", brute.address(1), brute.address(1), 1.0, False, False),
        ("usdt", day, "t", None, brute.address(2), 1.0, False, False),
        ("eurc", day, "t", None, None, 1.0, False, False),
    ]
    frame = spark.createDataFrame(rows, brute.COLUMNS)
    got = sketches.estimated(sketches.address_sketches(frame)).collect()
    assert {r.asset: r.estimated_addresses for r in got} == {"usdc": 1, "usdt": 1, "eurc": 0}
    assert sketches.address_sketches(frame.limit(0)).count() == 0


def test_no_address_is_shuffled(spark):
    plan = sketches.address_sketches(wide_ledger(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan
    assert "partial_hll_sketch_agg" in plan


def test_a_range_lists_only_its_days(spark, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.write_sketches(sketches.address_sketches(wide_ledger(spark)), path)
    few = sketches.read_sketches(spark, path, "2025-06-02", "2025-06-03")
    assert len({f.rsplit("/", 2)[-2] for f in few.select("addresses", F.input_file_name().alias("f")).select("f").distinct().toPandas()["f"]}) == 2

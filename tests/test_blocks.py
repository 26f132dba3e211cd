"""Layouts of blocks: what is listed, what is moved, and what a hot block does."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import decode
from ledgerline.schemas import HEADERS
from ledgerline.sinks import blocks
from test_rollups import plan_of


def headers_of(spark, numbers):
    rows = [(n, f"0x{n or 0:x}") for n in numbers]
    return spark.createDataFrame(rows, HEADERS)


def test_a_narrow_range_lists_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "ranges")
    numbers = [*range(0, 95), None, 205]
    blocks.write_block_ranges(headers_of(spark, numbers), path, per_range=10)
    for start, end in ((23, 41), (0, 0), (94, 300), (None, 9), (90, None), (None, None), (96, 200)):
        rows = blocks.read_block_ranges(spark, path, HEADERS, start, end)
        assert rows.columns == HEADERS.fieldNames()
        want = [n for n in numbers if n is not None and (start is None or n >= start) and (end is None or n <= end)]
        assert sorted(r.block_number for r in rows.collect()) == want
        read = rows.select(F.input_file_name().alias("f")).distinct().collect()
        folders = {r.f.rsplit("/", 2)[1] for r in read}
        assert folders == {f"block_range={n // 10}" for n in want}
        if start is not None and end is not None:
            # the filter reaches the listing, not the rows alone
            plan = plan_of(rows)
            assert "PartitionFilters: [isnotnull(block_range" in plan and f"block_range#" in plan
    with pytest.raises(ValueError):
        blocks.write_block_ranges(headers_of(spark, [1]), path, per_range=20)


def test_a_range_written_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "ranges")
    blocks.write_block_ranges(headers_of(spark, range(30)), path, per_range=10)
    blocks.write_block_ranges(headers_of(spark, [11, 12]), path, per_range=10)
    rows = blocks.read_block_ranges(spark, path, HEADERS)
    assert sorted(r.block_number for r in rows.collect()) == [*range(10), 11, 12, *range(20, 30)]


def bucketed(spark, tmp_path, hot=0):
    rows = [(n % 50, n) for n in range(600)] + [(7, n) for n in range(hot)]
    facts = spark.createDataFrame(rows, "block_number long, n long")
    headers = headers_of(spark, [n for n in range(50) if n % 9] * 2)
    name = "t" + tmp_path.name.replace("-", "_")
    stored = blocks.write_bucketed(facts, f"{name}_rows", str(tmp_path / "rows"), 4)
    times = blocks.write_bucketed(headers, f"{name}_headers", str(tmp_path / "headers"), 4)
    return facts, headers, stored, times


def test_bucketed_join_moves_nothing(spark, tmp_path):
    facts, headers, stored, times = bucketed(spark, tmp_path)
    joined = blocks.attach_bucketed_time(stored.where(F.col("n") % 2 == 0), times)
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = decode.attach_time(facts.where(F.col("n") % 2 == 0), headers)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_block_is_joined_apart(spark, tmp_path):
    facts, headers, stored, times = bucketed(spark, tmp_path, hot=400)
    hot = blocks.hot_blocks(stored, share=0.2)
    assert hot == [7]
    joined = blocks.attach_bucketed_time(stored, times, hot)
    calm, crowded = plan_of(joined).split("Union")[1].split("BroadcastHashJoin")[:2]
    assert "SortMergeJoin" in calm and "hashpartitioning" not in calm.split("SortMergeJoin")[1]
    want = decode.attach_time(facts, headers)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))


def test_buckets_are_opened_by_another_catalogue(spark, tmp_path):
    facts, _, stored, _ = bucketed(spark, tmp_path)
    again = blocks.open_bucketed(spark, "opened_rows", str(tmp_path / "rows"), stored.schema, 4)
    assert again.count() == facts.count()
    assert "Exchange" not in plan_of(again.groupBy("block_number").count())
    spark.sql("DROP TABLE opened_rows")


def most_in_a_file(rows):
    sizes = rows.groupBy(F.input_file_name()).agg(F.sum(F.octet_length("timestamp")).alias("n"))
    return max(r.n for r in sizes.collect())


def crowded(spark):
    """Two blocks have nearly all rows; 200,000 bytes of them in one."""
    long_time = [(n % 3 // 2, f"0x{n:098x}") for n in range(3000)]
    rows = long_time + [(n, "0x1") for n in range(2, 40)] + [(None, "0x2"), (5, None)]
    return spark.createDataFrame(rows, HEADERS).repartition(3)


def test_a_crowded_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = crowded(spark)
    stored = blocks.write_bucketed(rows, "crowded_rows", str(tmp_path / "rows"), 4, task_bytes=20_000)
    assert most_in_a_file(stored) < 30_000
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    times = blocks.write_bucketed(rows, "crowded_headers", str(tmp_path / "headers"), 4)
    joined = blocks.attach_bucketed_time(stored.withColumnRenamed("timestamp", "text"), times)
    assert "Exchange" not in plan_of(joined)
    want = decode.attach_time(rows.withColumnRenamed("timestamp", "text"), rows)
    assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))


def test_a_crowded_range_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "ranges")
    rows = crowded(spark)
    blocks.write_block_ranges(rows, path, per_range=10, task_bytes=20_000)
    stored = blocks.read_block_ranges(spark, path, HEADERS)
    assert most_in_a_file(stored) < 30_000
    want = rows.where(F.col("block_number").isNotNull())
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))
    blocks.write_block_ranges(rows.limit(0), path, per_range=10)
    assert blocks.read_block_ranges(spark, path, HEADERS).count() == want.count()

"""Layouts of landed blocks: by block range for narrow reads, by hash for joins that move nothing.

*Ranges.* Blocks lie below ``blocks_per_range=N/block_range=number div N``. A reader turns the
block numbers it is asked for into ranges, so a narrow question lists only their folders, and
inside them the row groups are in block order for the pushed-down filter.

*Hash buckets.* Headers and receipts are cut into the same number of buckets by block number and
sorted in each. Their join then reads bucket beside bucket without an exchange. What an exchange
could have split must be taken care of otherwise: blocks that hold more than a set share of the
rows, of which there can only be one over that share, are joined by a broadcast of their headers
instead, over a scan that is free to cut their files.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.decode import block_times
from ledgerline.sinks.folders import partition_folders

BLOCKS_PER_RANGE = 10_000
HOT_SHARE = 0.01
TASK_BYTES = 128 << 20  # of records as text, which a writing task sorts


def _evenly(rows: DataFrame, place: Column, task_bytes: int) -> DataFrame:
    """Deals ``rows`` to tasks by ``place``, each with about ``task_bytes`` of records as text.

    Places lie one behind another on a line as long as all records, which tasks cut evenly: a
    large place goes to several tasks, small ones share a task. The records of each place are
    measured first, since compressed sizes, by which adaptive execution cuts, say little of what
    a sort holds; the driver gets one size for each place. Records of one place are told apart by
    their hash and input partition, which are the same when a lost task runs again.
    """
    spark = rows.sparkSession
    size = F.octet_length(F.struct(*rows.columns).cast("string")).cast("long")
    placed = rows.withColumn("_place", place.cast("long"))
    sizes = placed.groupBy("_place").agg(F.sum(size).alias("n")).collect()
    # a missing place is the first
    sizes.sort(key=lambda r: (r["_place"] is not None, r["_place"] or 0))
    ends = list(accumulate(r["n"] for r in sizes))
    tasks = max(1, math.ceil((ends[-1] if ends else 0) / task_bytes))
    line = [(r["_place"], end - r["n"], r["n"]) for r, end in zip(sizes, ends)]
    known = spark.createDataFrame(line, "_at long, _before long, _bytes long")
    found = placed.join(F.broadcast(known), F.col("_place").eqNullSafe(F.col("_at")))
    # maps have no hash
    hashed = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    parts = 1 << 20
    within = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(parts)) / parts
    task = F.floor((F.col("_before") + F.col("_bytes") * within) / task_bytes)
    dealt = found.withColumn("_task", F.least(task, F.lit(tasks - 1)).cast("int"))
    return dealt.repartitionById(tasks, "_task").select(*rows.columns)


def write_block_ranges(
    blocks: DataFrame, path: str, per_range: int = BLOCKS_PER_RANGE, task_bytes: int = TASK_BYTES
) -> None:
    """Writes blocks, headers or receipts by range; ranges in the input are replaced.

    A range of more than ``task_bytes`` is cut into several files, so that no task sorts more at
    once. One table has one size of range; rows without a block number have no place in it and
    are left out.
    """
    stored = partition_folders(blocks.sparkSession, path, "blocks_per_range")
    if any(int(f["blocks_per_range"]) != per_range for f in stored):
        raise ValueError(f"{path} has ranges of another size: {stored[0]['blocks_per_range']}")
    known = blocks.where(F.col("block_number").isNotNull())
    ranged = known.withColumns(
        {
            "blocks_per_range": F.lit(per_range),
            "block_range": F.floor(F.col("block_number") / per_range).cast("long"),
        }
    )
    dealt = _evenly(ranged, F.col("block_range"), task_bytes)
    rows = dealt.sortWithinPartitions("block_range", "block_number")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("blocks_per_range", "block_range")
        .parquet(path)
    )


def read_block_ranges(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Blocks of an inclusive range; only the folders of its ranges are listed."""
    [layout] = partition_folders(spark, path, "blocks_per_range")
    per_range = int(layout["blocks_per_range"])
    placed = T.StructType(
        [
            *schema.fields,
            T.StructField("blocks_per_range", T.IntegerType()),
            T.StructField("block_range", T.LongType()),
        ]
    )
    rows = spark.read.schema(placed).parquet(path)
    if start is not None:
        rows = rows.where((F.col("block_range") >= start // per_range) & (F.col("block_number") >= start))
    if end is not None:
        rows = rows.where((F.col("block_range") <= end // per_range) & (F.col("block_number") <= end))
    return rows.drop("blocks_per_range", "block_range")


def write_bucketed(
    rows: DataFrame, table: str, path: str, buckets: int, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Stores headers or receipts in hash buckets of their block number, as a table.

    One shuffle here saves one in every join that follows. A bucket is one task in such a join,
    so there should be as many as a large job has tasks; one of more than ``task_bytes`` is
    written by several, as a file of each.
    """
    # the bucket that Spark's writer takes
    bucket = F.pmod(F.hash("block_number"), F.lit(buckets))
    dealt = _evenly(rows, bucket, task_bytes)
    (
        dealt.write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, "block_number").sortBy("block_number").saveAsTable(table)
    )
    return rows.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, schema: T.StructType, buckets: int
) -> DataFrame:
    """Makes stored buckets known to a session whose catalogue does not have them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}' "
        f"CLUSTERED BY (block_number) SORTED BY (block_number) INTO {buckets} BUCKETS"
    )
    return spark.table(table)


def hot_blocks(rows: DataFrame, share: float = HOT_SHARE) -> list[int]:
    """Blocks with more than ``share`` of all rows, 1 / share at most; counted bucket by bucket."""
    counts = rows.groupBy("block_number").agg(F.count("*").alias("n"))
    most = rows.count() * share
    return [r["block_number"] for r in counts.where(F.col("n") > most).collect() if r["block_number"] is not None]


def attach_bucketed_time(
    rows: DataFrame, headers: DataFrame, hot: list[int] | None = None
) -> DataFrame:
    """``attach_time`` for rows and headers that are bucketed alike: no exchange on either side.

    ``rows`` may be filtered and exploded from a bucketed table as long as they keep the block
    number. ``hot`` blocks (see ``hot_blocks``) are joined apart.
    """
    once = (
        block_times(headers.select("block_number", "timestamp"))
        .groupBy("block_number").agg(F.min("timestamp").alias("timestamp"))
    )
    if not hot:
        return rows.join(once.hint("merge"), "block_number")
    crowded = F.col("block_number").isin(*hot)
    calm = rows.where(~crowded).join(once.where(~crowded).hint("merge"), "block_number")
    few = once.where(crowded)  # a row for each hot block
    return calm.unionByName(rows.where(crowded).join(F.broadcast(few), "block_number"))

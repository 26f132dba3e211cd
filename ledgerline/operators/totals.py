"""Counts per asset, chunk and block range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.fixed_values import CHUNK_BLOCKS, END_BLOCK, START_BLOCK
from ledgerline.functions import currency_mark
from ledgerline.sources.chain import block_spine


def transfers_per_asset(transfers: DataFrame, registry: DataFrame) -> DataFrame:
    """Transfers of every registered asset, 0 where there are none."""
    counts = transfers.groupBy("asset").agg(F.count("*").alias("n"))
    return registry.join(counts, "asset", "left").select(
        "asset", "symbol", F.coalesce("n", F.lit(0).cast("long")).alias("transfer_count")
    )


def with_labels(stats: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds symbol and currency mark to per-asset statistics."""
    names = registry.select("asset", "symbol", currency_mark(F.col("symbol")).alias("currency"))
    return stats.join(names, "asset")


def chunk_counts(
    transfers: DataFrame,
    start: int = START_BLOCK,
    end: int = END_BLOCK,
    chunk_blocks: int = CHUNK_BLOCKS,
) -> DataFrame:
    """Transfers per chunk of blocks and asset, with the chunk's block bounds.

    Chunks are numbered from 0; pairs without transfers are left out.
    """
    offset = F.col("block_number") - F.lit(start)
    chunk = F.floor(offset / F.lit(chunk_blocks)).cast("long")
    counts = (
        transfers.where(F.col("block_number").between(start, end))
        .groupBy(chunk.alias("chunk_id"), "asset")
        .agg(F.count("*").alias("transfer_count"))
    )
    first = F.lit(start) + F.col("chunk_id") * chunk_blocks
    return counts.select(
        "chunk_id",
        first.cast("long").alias("first_block"),
        F.least(first + chunk_blocks - 1, F.lit(end)).cast("long").alias("last_block"),
        "asset",
        "transfer_count",
    )


def missing_blocks(
    spark: SparkSession,
    headers: DataFrame,
    start: int = START_BLOCK,
    end: int = END_BLOCK,
) -> DataFrame:
    """Blocks of the inclusive range without a present header."""
    present = headers.where(
        F.col("timestamp").isNotNull() & F.col("block_number").between(start, end)
    ).select("block_number")
    return block_spine(spark, start, end).join(present, "block_number", "left_anti")


GAP_BLOCKS = 1 << 15


def missing_intervals(
    headers: DataFrame,
    start: int = START_BLOCK,
    end: int = END_BLOCK,
    stretch: int = GAP_BLOCKS,
) -> DataFrame:
    """Gaps of the inclusive range: ``first_block, last_block, blocks``, without a spine.

    Blocks are gathered by stretches of ``stretch`` numbers, which folds headers that landed more
    than once on the map side and bounds what a task holds. Gaps inside a stretch are seen there.
    A gap that runs over a border is carried: the first and last block of each stretch that has
    any, a row for every 32,768 blocks, are put in order once, between ``start`` and ``end``.
    """
    within = headers.where(
        F.col("timestamp").isNotNull() & F.col("block_number").between(start, end)
    )
    number = F.floor((F.col("block_number") - start) / stretch).cast("long")
    held = within.groupBy(number.alias("stretch")).agg(
        F.sort_array(F.collect_set("block_number")).alias("b")
    )
    neighbours = F.zip_with(
        F.slice("b", 1, F.size("b") - 1),
        F.slice("b", 2, F.size("b") - 1),
        lambda low, high: F.struct((low + 1).alias("first_block"), (high - 1).alias("last_block")),
    )
    gap = F.col("first_block") <= F.col("last_block")
    inner = held.select(F.inline(neighbours)).where(gap)

    spark = headers.sparkSession
    edges = held.select(F.get("b", F.lit(0)).alias("low"), F.get("b", F.size("b") - 1).alias("high"))
    outside = spark.range(1).select(
        F.inline(F.array(*[
            F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"))
            for low, high in ((start - 1, start - 1), (end + 1, end + 1))
        ]))
    )
    order = Window.orderBy("low")
    borders = edges.union(outside).select(
        (F.lag("high").over(order) + 1).alias("first_block"), (F.col("low") - 1).alias("last_block")
    ).where(F.col("first_block").isNotNull() & gap)
    return inner.union(borders).withColumn(
        "blocks", F.col("last_block") - F.col("first_block") + 1
    )


def block_coverage(
    spark: SparkSession,
    headers: DataFrame,
    start: int = START_BLOCK,
    end: int = END_BLOCK,
    chunk_blocks: int = CHUNK_BLOCKS,
) -> DataFrame:
    """Blocks asked for and blocks present, per chunk of the range.

    An absent block still counts as processed. Headers are counted per block
    before the join, so landing a header twice changes nothing.
    """
    present = (
        headers.where(
            F.col("timestamp").isNotNull() & F.col("block_number").between(start, end)
        )
        .groupBy("block_number")
        .agg(F.lit(True).alias("present"))
    )
    spine = block_spine(spark, start, end)
    chunk = F.floor((F.col("block_number") - start) / chunk_blocks).cast("long")
    return (
        spine.join(present, "block_number", "left")
        .groupBy(chunk.alias("chunk_id"))
        .agg(
            F.count("*").alias("blocks_processed"),
            F.count("present").alias("blocks_present"),
        )
    )

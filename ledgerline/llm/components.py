"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.worktables import WorkTables


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: every vertex hands the smallest of its neighbourhood to the others.

    The minimum is a combined aggregate that is joined back, so a vertex with very many
    links is folded before the shuffle and its links can be split by adaptive execution.
    """
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(least, "u").where(F.col("v") > F.col("u"))
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(spark: SparkSession, links: DataFrame, work: WorkTables, name: str) -> DataFrame:
    """(vertex, root) of every vertex with a link; the root is the smallest vertex reached.

    ``links`` has whole-number columns u and v, in any order and with repeats. Every round is
    stored in the shared folder; rounds grow with the logarithm of the longest chain. Nothing
    but a count and a checksum of each round comes to the driver.
    """
    directed = links.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    state = work.store(directed.distinct(), f"{name}-0")
    before, step = None, 0
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, step = now, step + 1
        moved = _star(_star(state, large=True), large=False).where(F.col("u") != F.col("v"))
        state = work.store(moved.distinct(), f"{name}-{step}")
    roots = state.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(roots)

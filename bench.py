"""Times the headline queries and prints one JSON line.

All queries run once to warm up and three times measured, into a no-op sink; the
median counts. ``distinct_plan`` is the plain form of ``daily_stats`` with
several ``count(DISTINCT)``, kept as the baseline the library is measured by.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.plans import catalog, standin  # noqa: E402

HEADLINE = [
    "decode_transfers",
    "daily_stats",
    "daily_stats_li",
    "daily_stats_raw",
    "overall_stats",
    "overall_stats_li",
    "daily_addresses",
    "daily_categories",
    "category_flags_dim",
    "touching_semi",
    "summary_stats",
    "chart_series",
    "chunk_counts",
    "block_coverage",
]
RUNS = 3


def distinct_plan(transfers: DataFrame) -> DataFrame:
    by = ("asset", "date")
    single = transfers.groupBy(*by).agg(
        F.sum("amount").alias("total_volume"),
        F.count_distinct("tx_hash").alias("transaction_count"),
        F.count("*").alias("transfer_count"),
        F.count_distinct(F.when(F.col("is_defi_transaction"), F.col("tx_hash"))).alias(
            "defi_transaction_count"
        ),
        F.count_distinct(F.when(F.col("is_rollup_transaction"), F.col("tx_hash"))).alias(
            "rollup_transaction_count"
        ),
    )
    parties = transfers.select(*by, F.explode(F.array(F.lower("from"), F.lower("to"))).alias("a"))
    addresses = parties.groupBy(*by).agg(F.count_distinct("a").alias("different_addresses"))
    return single.join(addresses, list(by)).orderBy(*by)


def seconds(frame_of) -> float:
    began = time.perf_counter()
    frame_of().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {
        name: (lambda q=catalog.QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE
    }
    baseline = {
        "distinct_plan": lambda: distinct_plan(standin.ledger(spark, sf_dir)),
        "distinct_plan_li": lambda: distinct_plan(standin.ledger_li(spark, sf_dir)),
    }
    # rounds over all of them, so that no query has a warmer JVM than another
    every = {**queries, **baseline}
    rounds = [{n: seconds(f) for n, f in every.items()} for _ in range(RUNS + 1)][1:]
    timed = {n: round(statistics.median(r[n] for r in rounds), 3) for n in every}
    total = round(sum(timed[n] for n in queries), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": total,
                "unit": "sec",
                "queries": {n: timed[n] for n in queries},
                "baseline": {n: timed[n] for n in baseline},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

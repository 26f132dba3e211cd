"""Figures over daily rows: summary statistics and chart series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import CHART_METRICS


def summary_stats(daily: DataFrame) -> DataFrame:
    """Per asset over the days present; days without rows are not zeros.

    A metric that an asset's rows lack (NULL) gives NULL figures. The summed
    transaction count is the sum of daily distinct counts.
    """
    return daily.groupBy("asset").agg(
        F.count("*").alias("days"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("transaction_count").alias("total_transactions"),
        F.avg("total_volume").alias("avg_daily_volume"),
        F.avg("transaction_count").alias("avg_daily_transactions"),
        F.avg("different_addresses").alias("avg_daily_addresses"),
        F.max("different_addresses").alias("max_daily_addresses"),
        F.avg("defi_transaction_count").alias("avg_daily_defi_transactions"),
        F.max("defi_transaction_count").alias("max_daily_defi_transactions"),
        F.avg("rollup_transaction_count").alias("avg_daily_rollup_transactions"),
        F.max("rollup_transaction_count").alias("max_daily_rollup_transactions"),
    )


def loaded_assets(daily: DataFrame) -> DataFrame:
    """Number of assets and of daily rows."""
    return daily.agg(
        F.count_distinct("asset").alias("assets"), F.count("*").alias("daily_rows")
    )


def chart_series(daily: DataFrame) -> DataFrame:
    """Tidy series: ``asset, label, date, metric, value, log10_value``.

    One series per metric and asset; an absent metric gives no points. Charts
    are drawn on a log axis, which a value of zero or less has no place on.
    """
    wide = daily.select(
        "asset", "date", *[F.col(m).cast("double").alias(m) for m in CHART_METRICS]
    )
    points = wide.unpivot(["asset", "date"], CHART_METRICS, "metric", "value")
    return points.where(F.col("value").isNotNull()).select(
        "asset",
        F.upper("asset").alias("label"),
        "date",
        "metric",
        "value",
        F.when(F.col("value") > 0, F.log10("value")).alias("log10_value"),
    )

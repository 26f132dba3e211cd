"""Reads transfers back: the Parquet table and its CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import TRANSFERS, TRANSFERS_CSV

_ASSET = r"([^/]+)_transfers\.csv(?:/part-[^/]*)?$"


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """The stored table; filters on asset and date become partition filters."""
    return spark.read.schema(TRANSFERS).parquet(path)


def read_transfers_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``{asset}_transfers.csv`` files, or folders of that name, with their asset."""
    source = (
        spark.read.schema(TRANSFERS_CSV)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    asset = F.regexp_extract("_metadata.file_path", _ASSET, 1)
    return source.select(asset.alias("asset"), *TRANSFERS_CSV.fieldNames())


def count_transfers_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows per asset, headers not counted."""
    return (
        read_transfers_csv(spark, paths)
        .groupBy("asset")
        .agg(F.count("*").alias("transfer_count"))
    )

"""Landed block headers and receipts.

Fetching from a node is outside Spark: a fetcher lands its answers as files and
these readers take over. JSON needs a full read; Parquet gets column pruning
and pushed-down block ranges, so anything read more than once should be landed
as Parquet. :data:`ledgerline.schemas.BLOCKS` is the preferred shape, because
header time and receipts in one record need no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import BLOCKS, HEADERS, RECEIPTS

_CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType, form: str) -> DataFrame:
    if form not in ("json", "parquet"):
        raise ValueError(f"unknown format: {form}")
    if form == "parquet":
        return spark.read.schema(schema).parquet(path)
    return _read_json(spark, path, schema).where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def _read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_text = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return spark.read.schema(with_text).option("columnNameOfCorruptRecord", _CORRUPT).json(path)


def corrupt_records(spark: SparkSession, path: str, schema: T.StructType = BLOCKS) -> DataFrame:
    """Landed JSON records that the readers leave out: file, record and reason.

    Broken JSON, and records with a value of another type than the schema's (such as a block
    number as text). ``schema`` is that of the reader the files are for.
    """
    rows = _read_json(spark, path, schema)
    # all columns are read, as a value is only checked where its column is
    every = F.xxhash64(*schema.fieldNames()) >= F.lit(-(2**63))
    parsed = F.try_parse_json(_CORRUPT).isNotNull()
    reason = F.when(parsed, "a value of another type").otherwise("not JSON")
    return rows.where(F.col(_CORRUPT).isNotNull() & every).select(
        F.col("_metadata.file_path").alias("file"), F.col(_CORRUPT).alias("record"),
        reason.alias("reason"),
    )


def _in_range(frame: DataFrame, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        frame = frame.where(F.col("block_number") >= start)
    if end is not None:
        frame = frame.where(F.col("block_number") <= end)
    return frame


def read_headers(
    spark: SparkSession,
    path: str,
    start: int | None = None,
    end: int | None = None,
    form: str = "json",
) -> DataFrame:
    """Block headers, one per block; a missing block has no row or a null time."""
    return _in_range(_read(spark, path, HEADERS, form), start, end)


def read_receipts(
    spark: SparkSession,
    path: str,
    start: int | None = None,
    end: int | None = None,
    form: str = "json",
) -> DataFrame:
    """All receipts of a block per record."""
    return _in_range(_read(spark, path, RECEIPTS, form), start, end)


def read_blocks(
    spark: SparkSession,
    path: str,
    start: int | None = None,
    end: int | None = None,
    form: str = "json",
) -> DataFrame:
    """Header time and receipts landed together."""
    return _in_range(_read(spark, path, BLOCKS, form), start, end)


def block_spine(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Every block number of the inclusive range."""
    return spark.range(start, end + 1).withColumnRenamed("id", "block_number")

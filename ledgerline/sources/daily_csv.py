"""Reads ``{asset}_daily_stats.csv`` files, one asset per file.

Headers differ from file to file, so the columns of each file are taken from its own first line.
One scan reads the lines, Spark's CSV parser cuts them into fields (quoted commas and quotes stay
text), and one shuffle by file brings header, rows and verdict together; there is no join and no
driver loop over files. A file has a row for each day. The readers also accept a folder of that
name holding part files, as the exporter in ``sinks`` writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import text_date
from ledgerline.schemas import DAILY

_ASSET = r"([^/]+)_daily_stats\.csv(?:/part-[^/]*)?$"
_MOST_COLUMNS = 32
_END = "\u0001"  # the field behind the last one
_COUNTS = [f.name for f in DAILY if f.dataType.typeName() == "long"]
_FIGURES = ["total_volume", "avg_transfer_size", *_COUNTS]


def _fields(line: Column) -> Column:
    """The fields of a line, trimmed; NULL where they are too many or a quote is left open.

    The parser does not tell an absent field from an empty one, so a last field of our own marks
    where the line ends.
    """
    schema = ", ".join(f"c{k} string" for k in range(_MOST_COLUMNS))
    options = {"escape": '"', "emptyValue": "", "mode": "PERMISSIVE"}
    row = F.from_csv(F.concat(F.ltrim(line, F.lit("\ufeff")), F.lit("," + _END)), schema, options)
    every = F.array(*[F.trim(F.coalesce(row[f"c{k}"], F.lit(""))) for k in range(_MOST_COLUMNS)])
    count = F.array_position(every, _END) - 1
    return F.when(count >= 0, F.slice(every, F.lit(1), F.greatest(count, F.lit(0)).cast("int")))


def _one_spelling(file: Column) -> Column:
    """Listing and scan write the root of a local path differently."""
    return F.regexp_replace(file, "^file:/+", "file:/")


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    source = spark.read.text(paths, recursiveFileLookup=True)
    return source.select(
        F.col("value").alias("line"),
        _one_spelling(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_order"),
    ).where(F.length(F.trim("line")) > 0)


def _judged(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with its figures and its file's verdict, in one pass."""
    by_file = Window.partitionBy("file")
    in_order = by_file.orderBy("block_start", "line_order")
    lines = (
        _lines(spark, paths)
        .withColumn("asset", F.regexp_extract("file", _ASSET, 1))
        .withColumn("header", F.first("line").over(in_order))
        .withColumns({"fields": _fields(F.col("line")), "names": _fields(F.col("header"))})
    )

    def text(name: Column) -> Column:
        # position 0 (no such column) becomes index -1, which ``get`` answers NULL
        return F.get("fields", F.array_position("names", name) - 1)

    def column(figure: str) -> Column:
        of_asset = figure in ("total_volume", "avg_transfer_size")
        return F.concat(F.lit(f"{figure}_"), F.col("asset")) if of_asset else F.lit(figure)

    rows = lines.withColumns(
        {
            "is_row": F.col("line") != F.col("header"),
            "date": text_date(text(F.lit("date"))),
            **{f: text(column(f)) for f in _FIGURES},
        }
    )
    unread = F.coalesce(
        *[
            F.when((F.col(f) != "") & F.col(f).try_cast("double").isNull(), column(f))
            for f in _FIGURES
        ]
    )
    # what is wrong with a row, worst first, so that the least code of a file names its fault
    fault = F.when(
        F.col("is_row"),
        F.when(F.col("fields").isNull(), F.lit("0a row cannot be taken apart"))
        .when(F.size("fields") > F.size("names"), F.lit("1more fields than the header"))
        .when(F.col("date").isNull(), F.lit("2a date cannot be read"))
        .when(unread.isNotNull(), F.concat(F.lit("3a figure is no number: "), unread)),
    )
    names = F.col("names")
    required = F.array_contains(names, column("total_volume")) & F.array_contains(names, "transaction_count")
    reason = (
        F.when(names.isNull(), "the header cannot be taken apart")
        .when(~F.array_contains(names, "date"), "no date column")
        .when(~required, "missing required columns")
        .otherwise(F.substr(F.min(fault).over(by_file), F.lit(2)))
    )
    numbers = {f: F.col(f).try_cast("double") for f in _FIGURES}
    return rows.withColumn("reason", reason).withColumns(
        numbers | {c: numbers[c].cast("long") for c in _COUNTS}
    )


def daily_csv_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, asset, reason``; reason is NULL where the file can be used.

    A file without content, without a date column, without its asset's volume or the transaction
    count, with a date that cannot be read, with a figure that is no number (an empty one is
    missing, not wrong), with a row longer than its header, or with an open quote or 32 columns
    and more is skipped as a whole; the others are unaffected.
    """
    # names come from the listing, because a scan passes over empty files
    names_listed = spark.read.text(paths, recursiveFileLookup=True).inputFiles()
    listed = spark.createDataFrame([(name,) for name in names_listed], "file string")
    listed = listed.withColumn("file", _one_spelling(F.col("file")))
    verdicts = _judged(spark, paths).groupBy("file").agg(
        F.lit(True).alias("seen"), F.first("reason").alias("reason")
    )
    return (
        listed.where(F.regexp_extract("file", _ASSET, 1) != "")
        .join(verdicts, "file", "left")
        .select(
            "file",
            F.regexp_extract("file", _ASSET, 1).alias("asset"),
            F.when(F.col("seen").isNull(), "no content").otherwise(F.col("reason")).alias("reason"),
        )
    )


def read_daily_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Daily rows of all usable files; optional columns a file lacks are NULL."""
    rows = _judged(spark, paths)
    usable = F.col("is_row") & F.col("reason").isNull() & (F.col("asset") != "")
    return rows.where(usable).select(*DAILY.fieldNames())

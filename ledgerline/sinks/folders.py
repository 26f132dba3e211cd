"""Folders of partitioned tables, in whatever store their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all below it; one that is not there is no error."""
    folder, store = _store(spark, path)
    store.delete(folder, True)


def partition_folders(spark: SparkSession, root: str, *columns: str) -> list[dict[str, str]]:
    """Values of the partition columns of every folder below ``root``, listed by name.

    A column given as ``name=value`` narrows the listing to that folder. No file is opened.
    """
    pattern = "/".join(c if "=" in c else f"{c}=*" for c in columns)
    folder, store = _store(spark, f"{root}/{pattern}")
    found = store.globStatus(folder) or []
    rows = []
    for status in found:
        parts = status.getPath().toString().split("/")[-len(columns) :]
        rows.append(dict(p.split("=", 1) for p in parts))
    return rows

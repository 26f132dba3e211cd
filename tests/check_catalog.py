"""Compares catalogue queries with their SQL: python tests/check_catalog.py [sf] [names]."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402
from ledgerline.plans import catalog  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """None if equal, else a description of the first difference."""
    frame = driver.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(driver.oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got == want:
        return None
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    return next(f"{g} != {w}" for g, w in zip(got[1], want[1]) if g != w)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(driver.oracle_sql())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    directory = f"/root/testdata/sf{sf}"
    connection = connect(directory)
    for query in names:
        began = time.time()
        try:
            outcome = compare(session, connection, query, directory)
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{query:24} {time.time() - began:6.2f}s  {outcome or 'equal'}", flush=True)

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import golden
from ledgerline.fixed_values import CHART_METRICS
from ledgerline.operators import decode, report
from ledgerline.plans import jobs
from ledgerline.schemas import TRANSFERS
from ledgerline.sinks.csv_export import daily_export_view
from ledgerline.sinks.tables import replace_assets, write_transfers
from ledgerline.sources.chain import read_blocks, read_headers, read_receipts
from ledgerline.sources.daily_csv import daily_csv_files, read_daily_csv
from ledgerline.sources.transfers import (
    count_transfers_csv,
    read_transfers,
    read_transfers_csv,
)


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    headers = read_headers(spark, golden.land(folder, "headers", golden.HEADERS))
    receipts = read_receipts(spark, golden.land(folder, "receipts", golden.RECEIPTS))
    made = jobs.extract(receipts, str(folder / "ledger"), headers)
    made.export_csv(str(folder / "csv"))
    return made, folder / "csv"


def part_lines(folder):
    parts = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    return [list(csv.reader(p.open())) for p in parts]


def test_extract_stores_the_golden_ledger(ledger):
    made, _ = ledger
    daily = [(a, str(d), *rest) for a, d, *rest in (
        (r.asset, r.date, r.total_volume, r.transaction_count, r.transfer_count,
         r.avg_transfer_size, r.different_addresses, r.defi_transaction_count,
         r.rollup_transaction_count) for r in made.daily().collect())]
    assert daily == golden.DAILY
    assert {r.asset: r.transfer_count for r in made.transfers_per_asset().collect()} == {
        "usdc": 5, "usdt": 1, "pyusd": 0, "eurc": 1,
    }
    assert made.chunk_counts(22700000, 22700003, 1).count() == 4


def test_exported_daily_text(ledger):
    _, folder = ledger
    [lines] = part_lines(folder / "usdc_daily_stats.csv")
    assert lines == [
        ["date", "total_volume_usdc", "transaction_count", "transfer_count",
         "avg_transfer_size_usdc", "different_addresses", "defi_transaction_count",
         "rollup_transaction_count"],
        ["2025-06-13", "3.50", "2", "3", "1.17", "3", "1", "0"],
        ["2025-06-14", "10.25", "1", "2", "5.12", "4", "1", "1"],
    ]
    [lines] = part_lines(folder / "eurc_daily_stats.csv")
    assert lines[1][1] == "1180591620717411.25"
    assert not (folder / "pyusd_daily_stats.csv").exists()
    assert not (folder / "pyusd_transfers.csv").exists()


def test_exported_transfers_text(ledger):
    _, folder = ledger
    parts = part_lines(folder / "usdc_transfers.csv")
    header = ["block_number", "timestamp", "tx_hash", "from", "to", "amount",
              "is_defi_transaction", "is_rollup_transaction"]
    assert all(p[0] == header for p in parts)
    body = [line for p in parts for line in p[1:]]
    assert body[1] == ["22700000", "1749859188", "A", golden.Y, golden.AAVE_V2, "2.5",
                       "True", "False"]
    assert [line[2] for line in body] == ["A", "A", "B", "D", "D"]


def test_transfers_csv_is_read_back(spark, ledger):
    _, folder = ledger
    got = read_transfers_csv(spark, f"{folder}/*_transfers.csv")
    assert got.where("is_defi_transaction").count() == 2
    counts = {r.asset: r.transfer_count for r in
              count_transfers_csv(spark, f"{folder}/*_transfers.csv").collect()}
    assert counts == {"usdc": 5, "usdt": 1, "eurc": 1}


def test_report_from_exported_files(spark, ledger):
    _, folder = ledger
    made = jobs.report(spark, f"{folder}/*_daily_stats.csv")
    assert made.files.where("reason IS NOT NULL").isEmpty()
    usdc = made.summary.where("asset = 'usdc'").first()
    assert (usdc.total_volume, usdc.avg_daily_volume, usdc.max_daily_addresses) == (13.75, 6.875, 4)
    points = made.series.where("asset = 'usdc' AND metric = 'rollup_transaction_count'")
    assert [(p.label, str(p.date), p.value, p.log10_value) for p in points.collect()] == [
        ("USDC", "2025-06-13", 0.0, None), ("USDC", "2025-06-14", 1.0, 0.0),
    ]


def test_report_is_stored_by_metric(spark, ledger, tmp_path):
    _, folder = ledger
    jobs.report(spark, f"{folder}/*_daily_stats.csv").write(str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "series").glob("metric=*")) == sorted(
        f"metric={m}" for m in CHART_METRICS
    )
    assert spark.read.parquet(str(tmp_path / "series")).count() == 4 * len(CHART_METRICS)
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 3


def test_analyse_labels(spark, ledger):
    made, _ = ledger
    got = {r.asset: (r.currency, r.transfer_count) for r in
           jobs.analyse(made.transfers(), made.registry).collect()}
    assert got == {"usdc": ("$", 5), "usdt": ("$", 1), "eurc": ("€", 1)}


def test_extract_replaces_selected_assets_only(spark, tmp_path):
    first = read_blocks(spark, golden.land(tmp_path, "one", golden.blocks()))
    root = str(tmp_path / "ledger")
    jobs.extract(first, root)
    later = golden.receipt("L", golden.transfer(golden.USDC, golden.X, golden.Y, "0x5b8d80"))
    bad = golden.receipt("M", golden.transfer(golden.USDC, golden.X, golden.Y, "0xzz"))
    record = {"block_number": 22800000, "timestamp": "0x68500000", "receipts": [later, bad]}
    second = read_blocks(spark, golden.land(tmp_path, "two", [record]))
    made = jobs.extract(second, root, assets=["usdc"])
    stored = read_transfers(spark, made.transfers_path)
    assert sorted((r.asset, r.tx_hash) for r in stored.collect()) == [
        ("eurc", "E"), ("usdc", "L"), ("usdt", "B"),
    ]
    daily = spark.read.parquet(made.daily_path)
    assert sorted(r.asset for r in daily.collect()) == ["eurc", "usdc", "usdt"]
    rejects = made.rejects().collect()
    assert [(r.tx_hash, r.data) for r in rejects] == [("M", "0xzz")]


USDT = golden.TOKEN["usdt"].lower()


def landed(spark, tmp_path, name, *receipts):
    record = {"block_number": 22800000, "timestamp": "0x68500000", "receipts": list(receipts)}
    return read_blocks(spark, golden.land(tmp_path, name, [record]))


def test_extract_of_ranges_without_transfers(spark, tmp_path):
    bad = golden.receipt("M", golden.transfer(golden.USDC, golden.X, golden.Y, "0xzz"))
    good = golden.receipt("N", golden.transfer(USDT, golden.X, golden.Y, "0x5b8d80"))
    other = golden.receipt("O", golden.transfer("0x" + "9" * 40, golden.X, golden.Y, "0x1"))
    root = str(tmp_path / "ledger")
    made = jobs.extract(landed(spark, tmp_path, "good", good), root)
    made.export_csv(str(tmp_path / "csv"))
    assert (tmp_path / "csv" / "usdt_daily_stats.csv").exists()
    for name, receipts, rejects in (("bad", [bad], ["M"]), ("other", [other], []), ("none", [], [])):
        made = jobs.extract(landed(spark, tmp_path, name, *receipts), root)
        assert made.transfers().isEmpty() and made.daily().isEmpty()
        assert [r.tx_hash for r in made.rejects().collect()] == rejects
    made.export_csv(str(tmp_path / "csv"))
    assert not (tmp_path / "csv" / "usdt_daily_stats.csv").exists()
    assert not (tmp_path / "csv" / "usdt_transfers.csv").exists()
    assert not list((tmp_path / "ledger").glob("staged-*"))


def test_extract_keeps_rejects_of_other_assets(spark, tmp_path):
    usdc, usdt = (golden.receipt(n, golden.transfer(t, golden.X, golden.Y, "0xzz"))
                  for n, t in (("C", golden.USDC), ("T", USDT)))
    root = str(tmp_path / "ledger")
    jobs.extract(landed(spark, tmp_path, "both", usdc, usdt), root)
    made = jobs.extract(landed(spark, tmp_path, "again"), root, assets=["usdc"])
    assert made.rejects().isEmpty()
    every = jobs.Ledger(spark, root, made.registry, ("usdc", "usdt"))
    assert [r.tx_hash for r in every.rejects().collect()] == ["T"]


def shaped(spark, rows):
    return spark.createDataFrame(rows, TRANSFERS)


def make_row(asset, day, i):
    return (i, i * 12, f"t{i}", golden.X, golden.Y, 1.0, False, False, None, None, 0, i, asset, day)


def test_overwrite_keeps_other_partitions_and_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = dt.date(2025, 6, 1), dt.date(2025, 6, 2)
    write_transfers(shaped(spark, [make_row("a", one, 1), make_row("a", two, 2)]), path)
    write_transfers(shaped(spark, [make_row("a", two, 3)]), path)
    write_transfers(shaped(spark, [make_row("a", two, 4)]), path, mode="append")
    got = sorted((str(r.date), r.block_number) for r in read_transfers(spark, path).collect())
    assert got == [("2025-06-01", 1), ("2025-06-02", 3), ("2025-06-02", 4)]
    write_transfers(shaped(spark, [make_row("c", one, 5)]), path)
    replace_assets(shaped(spark, [make_row("b", two, 6)]), path, ["a", "b"], ["block_number"])
    got = sorted((r.asset, str(r.date), r.block_number) for r in read_transfers(spark, path).collect())
    assert got == [("b", "2025-06-02", 6), ("c", "2025-06-01", 5)]


def test_a_hot_day_is_written_as_several_sorted_files(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        rows = spark.range(0, 40000, 1, 8).select(
            F.col("id").alias("block_number"), (F.col("id") * 12).alias("timestamp"),
            F.sha2(F.col("id").cast("string"), 256).alias("tx_hash"),
            F.uuid().alias("from"), F.uuid().alias("to"), F.lit(1.0).alias("amount"),
            F.lit(False).alias("is_defi_transaction"),
            F.lit(False).alias("is_rollup_transaction"),
            F.lit(1).cast("decimal(38,0)").alias("amount_raw"),
            F.lit(0).alias("tx_pos"), F.lit(0).alias("log_pos"), F.lit("a").alias("asset"),
            F.lit(dt.date(2025, 6, 1)).alias("date"),
        )
        write_transfers(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(key, before)
    folder = tmp_path / "t" / "asset=a" / "date=2025-06-01"
    files = sorted(folder.glob("*.parquet"))
    assert len(files) > 3
    for file in files:
        numbers = [r.block_number for r in spark.read.parquet(str(file)).collect()]
        assert numbers == sorted(numbers)
    assert read_transfers(spark, str(tmp_path / "t")).count() == 40000


def test_partition_filter_reaches_the_scan(spark, ledger):
    made, _ = ledger
    narrow = made.transfers().where("date = '2025-06-14'").select("amount")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "date" in scan.split("PushedFilters")[0] and "asset" in scan.split("PushedFilters")[0]
    assert "ReadSchema: struct<amount:double>" in plan


def test_daily_money_text_follows_python(spark):
    rng = random.Random(2)
    rows = [("a", dt.date(2025, 1, 1), rng.random() * 10**9, 1, rng.randrange(1, 64), None, 1, 0, 0)
            for _ in range(300)]
    rows = [(*r[:5], r[2] / r[4], *r[6:]) for r in rows]
    from ledgerline.schemas import DAILY

    view = daily_export_view(spark.createDataFrame(rows, DAILY), "a").collect()
    assert [(v.total_volume_a, v.avg_transfer_size_a) for v in view] == [
        (f"{r[2]:.2f}", f"{r[5]:.2f}") for r in rows
    ]


FULL = "date,total_volume_{a},transaction_count,transfer_count,avg_transfer_size_{a}," \
       "different_addresses,defi_transaction_count,rollup_transaction_count"


@pytest.fixture
def uneven(tmp_path):
    def put(name, *lines, end="\r\n"):
        (tmp_path / name).write_text("".join(line + end for line in lines))

    put("full_daily_stats.csv", FULL.format(a="full"),
        "2025-06-13,3.50,2,3,1.17,3,1,0", "2025-06-14,10.25,1,2,5.12,4,1,1")
    put("old_daily_stats.csv", "transaction_count,date,total_volume_old", "7,2025-06-13,1.50",
        end="\n")
    put("renamed_daily_stats.csv", FULL.format(a="other"), "2025-06-13,1,1,1,1,1,1,1")
    put("undated_daily_stats.csv", "day,total_volume_undated,transaction_count", "x,1,1")
    put("baddate_daily_stats.csv", "date,total_volume_baddate,transaction_count",
        "2025-06-13,1,1", "soon,1,1")
    put("long_daily_stats.csv", "date,total_volume_long,transaction_count", "2025-06-13,1,1,9")
    put("empty_daily_stats.csv")
    put("notes.csv", "date", "2025-06-13")
    return str(tmp_path / "*_daily_stats.csv")


def test_daily_files_are_judged_one_by_one(spark, uneven):
    got = {r.asset: r.reason for r in daily_csv_files(spark, uneven).collect()}
    assert got == {
        "full": None,
        "old": None,
        "renamed": "missing required columns",
        "undated": "no date column",
        "baddate": "a date cannot be read",
        "long": "more fields than the header",
        "empty": "no content",
    }


def test_usable_daily_files_are_read_by_name(spark, uneven):
    got = sorted(map(tuple, read_daily_csv(spark, uneven).collect()))
    day = dt.date(2025, 6, 13)
    assert got[:1] + got[2:] == [
        ("full", day, 3.5, 2, 3, 1.17, 3, 1, 0),
        ("old", day, 1.5, 7, None, None, None, None, None),
    ]


def test_figures_are_judged_and_quoted_commas_read(spark, tmp_path):
    def put(asset, header, *lines):
        text = "\n".join([header.format(a=asset), *lines])
        (tmp_path / f"{asset}_daily_stats.csv").write_text(text)

    plain = "note,date,total_volume_{a},transaction_count"
    put("quoted", plain, '"a, ""b"", c",2025-06-13,1.5,7', '"",2025-06-14,"2.5",8')
    put("bad", plain, "x,2025-06-13,1.5,7", "x,2025-06-14,n/a,8")
    put("comma", plain, 'x,2025-06-13,"1,500",7')
    put("count", plain + ",transfer_count", "x,2025-06-13,1.5,7,many")
    put("missing", plain + ",transfer_count", "x,2025-06-13,1.5,7,", "x,2025-06-14,1.5,7")
    put("other", plain + ",comment", "x,2025-06-13,1.5,7,no number at all")
    put("wide", plain + "".join(f",c{k}" for k in range(70)), "x,2025-06-13,1.5,7")
    put("marked", "\ufeff" + plain, "x,2025-06-13,1.5,7")
    put("header", plain)
    put("open", plain, 'x,2025-06-13,1.5,7', '"x,2025-06-13,1.5,7')
    put("gaps", "note,transaction_count,,date,total_volume_{a}", ",7,,2025-06-13,")
    (tmp_path / "tail_daily_stats.csv").write_text("date,total_volume_tail,transaction_count\n2025-06-13,1,1,")
    paths = str(tmp_path / "*_daily_stats.csv")
    assert {r.asset: r.reason for r in daily_csv_files(spark, paths).collect()} == {
        "quoted": None, "missing": None, "other": None, "marked": None, "header": None, "gaps": None,
        "bad": "a figure is no number: total_volume_bad",
        "comma": "a figure is no number: total_volume_comma",
        "count": "a figure is no number: transfer_count",
        "wide": "the header cannot be taken apart", "open": "a row cannot be taken apart",
        "tail": "more fields than the header",
    }
    got = sorted(tuple(r)[:5] for r in read_daily_csv(spark, paths).collect())
    day, next_day = dt.date(2025, 6, 13), dt.date(2025, 6, 14)
    assert got == [
        ("gaps", day, None, 7, None), ("marked", day, 1.5, 7, None), ("missing", day, 1.5, 7, None), ("missing", next_day, 1.5, 7, None),
        ("other", day, 1.5, 7, None), ("quoted", day, 1.5, 7, None), ("quoted", next_day, 2.5, 8, None),
    ]


def test_daily_files_are_scanned_once(spark, uneven):
    plan = read_daily_csv(spark, uneven)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_absent_metrics_give_no_points_and_no_figures(spark, uneven):
    daily = read_daily_csv(spark, uneven)
    points = report.chart_series(daily).where("asset = 'old'").collect()
    assert sorted(p.metric for p in points) == ["total_volume", "transaction_count"]
    old = report.summary_stats(daily).where("asset = 'old'").first()
    assert (old.total_transactions, old.avg_daily_addresses) == (7, None)
    assert tuple(report.loaded_assets(daily).first()) == (2, 3)


def test_chain_order_needs_no_single_task(spark, ledger):
    made, _ = ledger
    plan = decode.in_chain_order(made.transfers())._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(block_number" in plan and "tx_pos" in plan and "log_pos" in plan

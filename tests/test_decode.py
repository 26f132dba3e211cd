import pytest
from pyspark.sql import functions as F

import golden
from ledgerline.operators import decode, rollups, totals
from ledgerline.operators.report import summary_stats
from ledgerline.schemas import TRANSFERS
from ledgerline.sources.chain import read_blocks, read_headers, read_receipts
from ledgerline.sources.registry import protocol_dimension, select_tokens, token_registry


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("chain")
    return {
        "headers": read_headers(spark, golden.land(folder, "headers", golden.HEADERS)),
        "receipts": read_receipts(spark, golden.land(folder, "receipts", golden.RECEIPTS)),
        "blocks": read_blocks(spark, golden.land(folder, "blocks", golden.blocks())),
    }


def transfers(spark, landed, together=False, **options):
    registry = token_registry(spark)
    if together:
        return decode.decode_transfers(landed["blocks"], registry, **options)
    return decode.decode_transfers(
        landed["receipts"], registry, landed["headers"], **options
    )


def rows(frame):
    kept = decode.in_chain_order(frame).select(
        "block_number", "tx_hash", "asset", "from", "to", "amount",
        "is_defi_transaction", "is_rollup_transaction",
    )
    return [tuple(r) for r in kept.collect()]


@pytest.mark.parametrize("together", [False, True])
def test_golden_transfers_in_chain_order(spark, landed, together):
    decoded = transfers(spark, landed, together)
    assert rows(decoded) == golden.TRANSFERS
    assert decoded.schema.fieldNames() == TRANSFERS.fieldNames()
    assert [f.dataType for f in decoded.schema] == [f.dataType for f in TRANSFERS]


def test_golden_daily(spark, landed):
    got = [tuple(r) for r in rollups.daily_stats(transfers(spark, landed)).collect()]
    assert [(a, str(d), *rest) for a, d, *rest in got] == golden.DAILY


def test_golden_overall(spark, landed):
    stats = totals.with_labels(
        rollups.overall_stats(transfers(spark, landed)), token_registry(spark)
    )
    usdc = stats.where("asset = 'usdc'").first()
    assert (usdc.transfer_count, usdc.total_volume, usdc.transaction_count) == (5, 13.75, 3)
    assert (usdc.defi_transaction_count, usdc.rollup_transaction_count) == (2, 1)
    assert (usdc.different_addresses, usdc.currency) == (6, "$")
    assert stats.where("asset = 'eurc'").first().currency == "€"


def test_golden_overall_from_stored_partials(spark, landed):
    partials = rollups.key_partials(transfers(spark, landed))
    daily, overall = rollups.daily_and_overall(partials)
    assert daily.count() == 4
    direct = rollups.overall_stats(transfers(spark, landed))
    assert sorted(map(tuple, overall.collect())) == sorted(map(tuple, direct.collect()))


def test_golden_summary(spark, landed):
    got = summary_stats(rollups.daily_stats(transfers(spark, landed)))
    usdc = got.where("asset = 'usdc'").first().asDict()
    assert usdc == {
        "asset": "usdc", "days": 2, "total_volume": 13.75, "total_transactions": 3,
        "avg_daily_volume": 6.875, "avg_daily_transactions": 1.5,
        "avg_daily_addresses": 3.5, "max_daily_addresses": 4,
        "avg_daily_defi_transactions": 1.0, "max_daily_defi_transactions": 1,
        "avg_daily_rollup_transactions": 0.5, "max_daily_rollup_transactions": 1,
    }


def test_other_time_zone_moves_the_day(spark, landed):
    decoded = transfers(spark, landed, zone="Asia/Tokyo")
    daily = rollups.daily_stats(decoded).where("asset = 'usdc'").collect()
    assert [(str(r.date), r.transaction_count, r.different_addresses) for r in daily] == [
        ("2025-06-14", 3, 6)
    ]


def test_asset_without_transfers_counts_zero(spark, landed):
    got = totals.transfers_per_asset(transfers(spark, landed), token_registry(spark))
    counts = {r.asset: r.transfer_count for r in got.collect()}
    assert counts == {"usdc": 5, "usdt": 1, "pyusd": 0, "eurc": 1}


def test_block_coverage(spark, landed):
    got = totals.block_coverage(spark, landed["headers"], 22700000, 22700004, 2)
    assert sorted(map(tuple, got.collect())) == [(0, 2, 2), (1, 2, 1), (2, 1, 0)]
    missing = totals.missing_blocks(spark, landed["headers"], 22700000, 22700004)
    assert sorted(r.block_number for r in missing.collect()) == [22700002, 22700004]


def test_chunk_counts(spark, landed):
    got = totals.chunk_counts(transfers(spark, landed), 22700000, 22700001, 10)
    assert sorted(map(tuple, got.collect())) == [
        (0, 22700000, 22700001, "eurc", 1),
        (0, 22700000, 22700001, "usdc", 5),
        (0, 22700000, 22700001, "usdt", 1),
    ]


def test_undecodable_logs_are_kept_apart(spark, tmp_path):
    def of(tx, **fields):
        one = golden.transfer(golden.USDC, golden.X, golden.Y, "0x1")
        return {**golden.receipt(tx, {**one, **fields})}

    topics = [golden.T, None, golden.topic(golden.Y)]
    no_data = golden.transfer(golden.USDC, golden.X, golden.Y, None)
    records = [
        {"block_number": 1, "timestamp": "0x10", "receipts": [
            of("bad", data="0xzz"), of("empty", data=""), of("fine"),
            golden.receipt("none", no_data), golden.receipt(None, no_data),
            of("topic", topics=topics), of("wide", data="0x" + "0" * 90 + "5"),
            of("huge", data="0x" + "f" * 300),
        ]},
        {"block_number": 2, "timestamp": "soon", "receipts": [of("time")]},
    ]
    blocks = read_blocks(spark, golden.land(tmp_path, "blocks", records))
    decoded = decode.decode_logs(blocks, token_registry(spark))
    reasons = {r.tx_hash: r.reject_reason for r in decode.rejected(decoded).collect()}
    assert reasons == {
        "bad": "amount is not hexadecimal",
        "empty": "amount is not hexadecimal",
        "none": "amount is not hexadecimal",
        None: "no transaction hash",
        "topic": "null topic",
        "huge": "amount exceeds a double",
        "time": "block time is not hexadecimal",
    }
    good = decode.accepted(decoded).collect()
    assert sorted((r.tx_hash, r.amount) for r in good) == [("fine", 1e-6), ("wide", 5e-6)]


def test_eighteen_decimals(spark, tmp_path):
    tokens = [("dai", golden.TOKEN["dai"], 18, "DAI", True)]
    amount = 123456789012345678901234567
    one = golden.transfer(golden.TOKEN["dai"], golden.X, golden.Y, hex(amount))
    record = {"block_number": 1, "timestamp": "0x10", "receipts": [golden.receipt("t", one)]}
    blocks = read_blocks(spark, golden.land(tmp_path, "blocks", [record]))
    got = decode.decode_transfers(blocks, token_registry(spark, tokens=tokens)).first()
    assert (int(got.amount_raw), got.amount) == (amount, amount / 10**18)


def test_asset_selection(spark):
    names = [t[0] for t in select_tokens()]
    assert names == ["usdc", "usdt", "pyusd", "eurc"]
    assert [t[0] for t in select_tokens([])] == names
    assert [t[0] for t in select_tokens(["all", "usdc"])] == names
    assert [t[0] for t in select_tokens(["eurc", "usdc"])] == ["usdc", "eurc"]
    for bad in ("dai", "unknown"):
        with pytest.raises(ValueError):
            select_tokens(["usdc", bad])
    assert token_registry(spark, ["usdt"]).select("address").first()[0] == (
        golden.TOKEN["usdt"].lower()
    )


def test_protocol_dimension(spark):
    got = protocol_dimension(spark)
    counts = {r["category"]: r["count"] for r in got.groupBy("category").count().collect()}
    assert counts == {"defi": 10, "rollup": 9}
    assert got.where(F.col("address") != F.lower("address")).isEmpty()


def test_registry_is_broadcast_by_its_size(spark, landed):
    plan = transfers(spark, landed)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [address" in plan


def test_block_range_and_columns_reach_a_parquet_scan(spark, landed, tmp_path):
    path = str(tmp_path / "blocks")
    landed["blocks"].withColumn("miner", F.lit("unused")).write.parquet(path)
    some = read_blocks(spark, path, 22700001, 22700001, form="parquet")
    assert [r.block_number for r in some.collect()] == [22700001]
    plan = decode.explode_logs(some)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(block_number,22700001)" in plan
    assert "LessThanOrEqual(block_n" in plan
    assert "miner" not in plan
    decoded = decode.decode_transfers(some, token_registry(spark))
    assert rows(decoded) == golden.TRANSFERS[4:]


def test_many_records_of_one_block_add_up(spark, landed):
    """A block may be landed in pieces, one receipt per record."""
    pieces = landed["blocks"].withColumn("receipts", F.explode("receipts")).withColumn(
        "receipts", F.array("receipts")
    )
    decoded = decode.decode_transfers(pieces, token_registry(spark))
    assert sorted(rows(decoded)) == sorted(golden.TRANSFERS)

import datetime as dt
import random
import zoneinfo

import pytest
from pyspark.sql import functions as F

from ledgerline import functions as L
from ledgerline.operators.decode import decode_amounts


def values(spark, rows, schema, **columns):
    frame = spark.createDataFrame(rows, schema)
    return frame.select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_block_key(spark):
    numbers = [0, 1, 255, 22700000, 2**40 + 7]
    got = values(spark, [(n,) for n in numbers], "n long", k=L.block_key(F.col("n")))
    assert [r.k for r in got] == [hex(n) for n in numbers]


def test_hex_to_long(spark):
    texts = ["0x684cbb74", "0x0", "0x", "0xFF", "0xzz", None, "", "ff"]
    got = values(spark, [(t,) for t in texts], "t string", v=L.hex_to_long(F.col("t")))
    assert [r.v for r in got] == [0x684CBB74, 0, 0, 255, None, None, None, 255]


def test_topic_address(spark):
    rows = [(["T", "0x" + "0" * 24 + "Ab" * 20],), (["T", "abc"],), (["T"],), (None,)]
    got = values(spark, rows, "t array<string>", a=L.topic_address(F.col("t"), 1))
    assert [r.a for r in got] == ["0x" + "Ab" * 20, "0xabc", None, None]


def amounts():
    rng = random.Random(7)
    fixed = [0, 1, 10**6, 2**53 - 1, 2**53, 2**53 + 1, 2**60 - 1, 2**60, 2**64, 2**70,
             10**18, 2**120 - 1, 2**120, 2**256 - 1, 10**38]
    return fixed + [rng.getrandbits(rng.randint(1, 256)) for _ in range(400)]


@pytest.mark.parametrize("decimals", [6, 18])
def test_amount_decoding(spark, decimals):
    numbers = amounts()
    texts = [f"0x{n:x}" for n in numbers] + [f"0x{n:064x}" for n in numbers] + ["0x"]
    numbers = numbers + numbers + [0]
    frame = spark.createDataFrame([(t,) for t in texts], "data string")
    got = decode_amounts(frame.withColumn("decimals", F.lit(decimals)))
    got = got.select(F.col("amount_raw").alias("raw"), "amount").collect()
    for number, row in zip(numbers, got):
        expected = number / 10**decimals
        if number < 2**120:
            assert int(row.raw) == number
            assert row.amount == expected  # the very same double
        else:
            assert row.raw is None
            assert abs(row.amount - expected) <= expected * 2**-52


def test_only_amounts_too_large_for_a_double_are_refused(spark):
    rows = [("0x" + "0" * 255 + "5", 6, False), ("0x" + "0" * 999 + "ff", 18, False),
            ("0x" + "f" * 255, 6, False), ("0x" + "f" * 255, 0, False),
            ("0x1" + "0" * 256, 18, False), ("0x1" + "0" * 256, 0, True),
            ("0x" + "f" * 300, 6, True), ("0x1" + "0" * 600, 18, True)]
    frame = spark.createDataFrame(rows, "data string, decimals int, large boolean")
    digits = L.significant_digits(F.col("data"))
    got = decode_amounts(frame.withColumn("refused", L.exceeds_double(digits, F.col("decimals"))))
    for row in got.collect():
        number = int(row.data, 16)
        assert row.refused == row.large
        if not row.large:
            want = number / 10**row.decimals
            assert abs(row.amount - want) <= want * 2**-52
            assert int(row.amount_hex, 16) == number if row.amount_raw is None else row.amount_raw == number


@pytest.mark.parametrize("text", ["0xzz", "", "0x 1", "-0x1", None])
def test_bad_hex_has_no_digits(spark, text):
    [row] = values(spark, [(text,)], "t string", d=L.hex_digits(F.col("t")))
    assert row.d is None


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York", "Asia/Kathmandu"])
def test_epoch_date_ignores_session_zone(spark, zone):
    rng = random.Random(3)
    seconds = [0, 86399, 86400, 0x684CBB74, 0x684CBB80, 1710054000, 1730613600]
    seconds += [rng.randrange(0, 2**31) for _ in range(200)]
    got = values(
        spark, [(s,) for s in seconds], "s long", d=L.epoch_date(F.col("s"), zone)
    )
    info = zoneinfo.ZoneInfo(zone)
    assert [r.d for r in got] == [dt.datetime.fromtimestamp(s, info).date() for s in seconds]


def test_text_date(spark):
    rows = [("2025-06-13",), ("nonsense",), (None,)]
    got = values(spark, rows, "t string", d=L.text_date(F.col("t")))
    assert [r.d for r in got] == [dt.date(2025, 6, 13), None, None]


def test_money_text_matches_exact_binary_rounding(spark):
    rng = random.Random(11)
    numbers = [0.0, 0.125, 0.375, 2.675, 5.125, 1.005, 0.995, 0.996, 99.999,
               1180591620717411.25, 2.0**52 + 0.5, 1e15 + 0.125, -2.675, -0.125,
               2.0**63, -(2.0**63), 2.0**63 - 1024, 1e19, 1.5e20, 1e22, 1e23, 2.0**1023, 1.7e308]
    numbers += [rng.random() * 10 ** rng.randint(18, 300) for _ in range(200)]
    numbers += [rng.random() * 10 ** rng.randint(0, 14) for _ in range(1000)]
    numbers += [rng.randrange(10**7) / 200 for _ in range(1000)]
    got = values(spark, [(x,) for x in numbers], "x double", t=L.money_text(F.col("x")))
    assert [r.t for r in got] == [f"{x:.2f}" for x in numbers]


def test_whole_number_matches_half_even(spark):
    numbers = [0.5, 1.5, 2.5, 0.49999999999999994, 1e15 + 0.5, 7.0]
    got = values(spark, [(x,) for x in numbers], "x double", w=L.whole_number(F.col("x")))
    assert [int(r.w) for r in got] == [int(f"{x:.0f}") for x in numbers]


def test_currency_mark(spark):
    rows = [("EURC",), ("USDC",)]
    got = values(spark, rows, "s string", m=L.currency_mark(F.col("s")))
    assert [r.m for r in got] == ["€", "$"]

"""Views that map the test tables onto the transfer schema.

The test tables hold no chain data. ``ledger`` reads events, ``ledger_li`` reads
line items with their orders, and ``raw_blocks`` writes events back as undecoded
receipts. All are row-wise; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.fixed_values import TRANSFER_TOPIC
from ledgerline.operators.contacts import flag_contacts, flag_contacts_from_table

BLOCK_SECONDS = 21600
ASSETS = ("click", "error", "purchase", "signup", "view")
DEFI_PARTIES = {"amber": [3, 7], "basalt": [11]}
ROLLUP_PARTIES = {"cobalt": [20], "dune": [21]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    """``0x`` and ``width`` lower-case digits; a long fills at most 16 of them."""
    digits = F.lpad(F.lower(F.hex(number)), 16, "0")
    return F.concat(F.lit("0x" + "0" * (width - 16)), digits)


def address(number: Column) -> Column:
    return _padded(number, 40)


def hash_text(number: Column) -> Column:
    return _padded(number, 64)


def address_of(number: int) -> str:
    return f"0x{number:040x}"


def contracts() -> dict[str, dict[str, list[str]]]:
    return {
        category: {p: [address_of(n) for n in numbers] for p, numbers in parties.items()}
        for category, parties in (("defi", DEFI_PARTIES), ("rollup", ROLLUP_PARTIES))
    }


def token_rows() -> list[tuple]:
    """A registry whose contracts are numbered from 1000; the last has no rows."""
    live = [(a, address_of(1000 + i), 6, a.upper(), True) for i, a in enumerate(ASSETS)]
    return live + [("unused", address_of(1999), 6, "EURC", True)]


def block_of(ts: Column) -> Column:
    """Six-hour blocks, counted from the epoch on the clock the table is written in."""
    return F.unix_date(ts.cast("date")).cast("long") * 4 + F.floor(F.hour(ts) / 6)


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    block = block_of(F.col("ts"))
    return events.select(
        "event_id",
        F.col("event_type").alias("asset"),
        block.alias("block_number"),
        (block * BLOCK_SECONDS).alias("timestamp"),
        (block * 1000000 + F.col("user_id")).alias("tx_number"),
        F.col("user_id").alias("from_number"),
        F.get_json_object("props", "$.k").cast("long").alias("to_number"),
        F.col("value").alias("amount"),
    )


def plain_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transfers, before flags."""
    events = numbered_events(spark, sf_dir)
    return events.select(
        "asset",
        F.date_from_unix_date(F.floor(F.col("block_number") / 4).cast("int")).alias("date"),
        "block_number",
        "timestamp",
        hash_text(F.col("tx_number")).alias("tx_hash"),
        address(F.col("from_number")).alias("from"),
        address(F.col("to_number")).alias("to"),
        "amount",
        F.lit(0).alias("tx_pos"),
        F.col("event_id").alias("log_pos"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flagged transfers."""
    return flag_contacts(plain_ledger(spark, sf_dir), contracts())


def plain_ledger_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transfers from supplier to customer, before flags."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("asset"),
        F.col("l_shipdate").cast("date").alias("date"),
        "l_orderkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("amount"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "asset",
        "date",
        "amount",
        hash_text(F.col("l_orderkey")).alias("tx_hash"),
        address(F.col("l_suppkey")).alias("from"),
        # customers and suppliers are numbered alike; keep their addresses apart
        address(F.col("o_custkey") + 2**40).alias("to"),
    )


def supplier_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by region of their nation: ASIA is DeFi, EUROPE is rollup."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    located = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return located.select(
        F.when(F.col("r_name") == "ASIA", "defi").otherwise("rollup").alias("category"),
        address(F.col("s_suppkey")).alias("address"),
    )


def ledger_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_contacts_from_table(
        plain_ledger_li(spark, sf_dir), supplier_dimension(spark, sf_dir)
    )


_LOGS = "array<struct<address:string,topics:array<string>,data:string>>"
_RECEIPT = f"struct<transactionHash:string,logs:{_LOGS}>"

# What makes an event's log undecodable; see raw_receipts.
NO_HEADER_DAY = 13


def raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as undecoded receipts: ``event_id, block_number, receipts``.

    Each event becomes a record of three receipts: a null one, one without logs,
    and one with three logs of which the middle one is the event. The event's
    log is spoilt for receivers from 90 up (wrong signature) and from 80 to 89
    (too few topics), for errors (unregistered token), and for values under 5
    (amount text that is not hexadecimal).
    """
    events = numbered_events(spark, sf_dir)
    names = list(token_addresses().items())
    token = F.lit(None).cast("string")
    for asset, contract in names:
        token = F.when(F.col("asset") == asset, contract).otherwise(token)
    token = F.when(F.col("asset") == "error", address_of(7)).otherwise(token)
    receiver_number = F.col("to_number")
    signature = F.when(receiver_number >= 90, TRANSFER_TOPIC.upper()).otherwise(TRANSFER_TOPIC)
    sender, receiver = hash_text(F.col("from_number")), hash_text(receiver_number)
    parties = F.array(signature, sender, receiver)
    topics = F.when(receiver_number.between(80, 89), F.array(signature, sender))
    units = F.round(F.col("amount") * 1000000).cast("long")
    data = F.when(F.col("amount") < 5, F.lit("0xnothex")).otherwise(hash_text(units))

    def log(log_topics: Column, log_data: Column) -> Column:
        return F.struct(
            F.concat(F.lit("0x"), F.upper(F.substring(token, 3, 40))).alias("address"),
            log_topics.alias("topics"),
            log_data.alias("data"),
        )

    logs = F.array(
        log(F.array(F.lit("0x" + "ab" * 32), sender, receiver), F.lit("0x01")),
        log(topics.otherwise(parties), data),
        log(F.array().cast("array<string>"), F.lit("0x02")),
    )
    tx_hash = hash_text(F.col("tx_number")).alias("transactionHash")
    receipts = F.array(
        F.lit(None).cast(_RECEIPT),
        F.struct(tx_hash, F.lit(None).cast(_LOGS).alias("logs")).cast(_RECEIPT),
        F.struct(tx_hash, logs.alias("logs")).cast(_RECEIPT),
    )
    return events.select("event_id", "block_number", receipts.alias("receipts"))


def token_addresses() -> dict[str, str]:
    return {row[0]: row[1] for row in token_rows()}


def _header_time() -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(F.col("block_number") * BLOCK_SECONDS)))


def raw_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header per block with events; those of one day a month are null."""
    blocks = numbered_events(spark, sf_dir).select("block_number").distinct()
    day = F.day(F.date_from_unix_date(F.floor(F.col("block_number") / 4).cast("int")))
    return blocks.select(
        "block_number", F.when(day != NO_HEADER_DAY, _header_time()).alias("timestamp")
    )


def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts landed together with their header time."""
    return raw_receipts(spark, sf_dir).withColumn("timestamp", _header_time())

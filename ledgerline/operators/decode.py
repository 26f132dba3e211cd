"""Receipts to typed transfers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import TRANSFER_TOPIC
from ledgerline.functions import (
    decimal_amount,
    epoch_date,
    exceeds_double,
    hex_to_long,
    is_hex,
    low_limb,
    raw_amount,
    significant_digits,
    topic_address,
)
from ledgerline.operators.contacts import flag_contacts
from ledgerline.schemas import TRANSFERS
from ledgerline.sources.registry import CONTRACTS


def explode_logs(receipts: DataFrame) -> DataFrame:
    """One row per log, with its place in the block kept as an order key.

    Null receipt lists, null receipts and receipts without logs give no rows.
    Every other column of the record is carried along.

    Between the two explodes the receipt is cut into its hash and its logs, so
    that a log row does not drag all logs of its receipt along. The outer form
    with explicit filters gives the same rows as the inner one, without the
    array checks that Catalyst derives from the latter.
    """
    carried = [c for c in receipts.columns if c != "receipts"]
    opened = receipts.where(F.col("receipts").isNotNull()).select(
        *carried, F.posexplode_outer("receipts").alias("tx_pos", "_receipt")
    )
    split = opened.select(
        *carried,
        "tx_pos",
        F.col("_receipt.transactionHash").alias("tx_hash"),
        F.col("_receipt.logs").alias("_logs"),
    ).where(F.col("_logs").isNotNull())
    logs = split.select(
        *carried, "tx_pos", "tx_hash", F.posexplode_outer("_logs").alias("log_pos", "_log")
    ).where(F.col("_log").isNotNull())
    return logs.select(
        *carried,
        "tx_pos",
        "log_pos",
        "tx_hash",
        F.col("_log.address").alias("address"),
        F.col("_log.topics").alias("topics"),
        F.col("_log.data").alias("data"),
    )


def transfer_events(logs: DataFrame) -> DataFrame:
    """Logs whose first topic is the transfer signature, compared case-sensitively."""
    return logs.where(F.get("topics", F.lit(0)) == TRANSFER_TOPIC)


def attribute_assets(logs: DataFrame, registry: DataFrame) -> DataFrame:
    """Keeps logs of registered tokens and names their asset.

    No hint: a registry built from rows has exact statistics, so Spark
    broadcasts it below its threshold and shuffles (with skew splitting) above.
    """
    tokens = registry.select("asset", "address", "decimals")
    return logs.withColumn("address", F.lower("address")).join(tokens, "address")


def with_both_parties(logs: DataFrame) -> DataFrame:
    """Logs with at least three topics; a fourth is tolerated."""
    return logs.where(F.size("topics") >= 3)


def block_times(headers: DataFrame) -> DataFrame:
    """Hex block time as epoch seconds; absent blocks (null time) are dropped.

    Once per block, before its logs are taken apart. A time that is not
    hexadecimal becomes NULL, for which the logs of the block are rejected.
    """
    present = headers.where(F.col("timestamp").isNotNull())
    return present.withColumn("timestamp", hex_to_long(F.col("timestamp")))


def attach_time(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Inner join to present block headers.

    A block landed more than once counts once, with its earliest readable time.
    Joined after filtering, so what is shuffled is decoded transfers and not
    whole blocks. A block holding a large share of the rows is split by the
    adaptive skew join. That needs a plain exchange below the join on both
    sides, so headers are folded by a struct of the block number: its
    partitioning is not taken for that of the join.
    """
    times = block_times(headers.select("block_number", "timestamp"))
    folded = times.groupBy(F.struct("block_number").alias("block")).agg(
        F.min("timestamp").alias("timestamp")
    )
    once = folded.select(F.col("block.block_number").alias("block_number"), "timestamp")
    return rows.join(once, "block_number")


def decode_logs(
    receipts: DataFrame, registry: DataFrame, headers: DataFrame | None = None
) -> DataFrame:
    """Decodes the transfer logs of registered tokens.

    ``receipts`` either has a ``timestamp`` column (landed together) or needs
    ``headers``. Rows that cannot be decoded are kept with ``reject_reason``.
    """
    if headers is None:
        receipts = block_times(receipts)
    logs = with_both_parties(
        attribute_assets(transfer_events(explode_logs(receipts)), registry)
    )
    decoded = logs.select(
        *[c for c in logs.columns if c not in ("address", "topics")],
        topic_address(F.col("topics"), 1).alias("from"),
        topic_address(F.col("topics"), 2).alias("to"),
    )
    if headers is not None:
        decoded = attach_time(decoded, headers)
    reason = (
        F.when(F.col("tx_hash").isNull(), "no transaction hash")
        .when(F.col("from").isNull() | F.col("to").isNull(), "null topic")
        .when(F.coalesce(~is_hex(F.col("data")), F.lit(True)), "amount is not hexadecimal")
        .when(
            exceeds_double(significant_digits(F.col("data")), F.col("decimals")),
            "amount exceeds a double",
        )
        .when(F.col("timestamp").isNull(), "block time is not hexadecimal")
    )
    return decoded.withColumn("reject_reason", reason)


def decode_amounts(rows: DataFrame) -> DataFrame:
    """Adds ``amount_raw``, ``amount_hex`` and ``amount`` from ``data`` and ``decimals``.

    An integer of more than 120 bits is kept as hexadecimal digits in
    ``amount_hex``, any other as a number in ``amount_raw``.

    ``data`` must have been checked by ``is_hex``, as accepted rows are.
    Shared pieces are columns of their own stages, so each is computed once per
    row instead of once per mention; Catalyst keeps the stages in one codegen
    span and does not inline an expensive column that is used twice.
    """
    pieces = rows.withColumn("_digits", significant_digits(F.col("data")))
    pieces = pieces.withColumn("_low", low_limb(F.col("_digits")))
    pieces = pieces.withColumn("amount_raw", raw_amount(F.col("_digits"), F.col("_low")))
    pieces = pieces.withColumn(
        "amount_hex", F.when(F.col("amount_raw").isNull(), F.lower(F.col("_digits")))
    )
    amount = decimal_amount(
        F.col("_digits"), F.col("_low"), F.col("amount_raw"), F.col("decimals")
    )
    return pieces.withColumn("amount", amount).drop("_digits", "_low")


def accepted(
    decoded: DataFrame,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
    zone: str = "UTC",
) -> DataFrame:
    """Valid decoded logs as transfers: flagged, dated, in schema order."""
    valid = decode_amounts(decoded.where(F.col("reject_reason").isNull()))
    dated = valid.withColumn("date", epoch_date(F.col("timestamp"), zone))
    return flag_contacts(dated, contracts).select(*TRANSFERS.fieldNames())


def accepted_and_rejected(
    decoded: DataFrame,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
    zone: str = "UTC",
) -> DataFrame:
    """All decoded logs in one table, for one pass over the blocks.

    Transfers have no ``reject_reason``; rejects have one, and no amounts.
    """
    good = F.col("reject_reason").isNull()
    checked = decoded.withColumn("_text", F.col("data"))
    # what is no amount is not taken for one
    checked = checked.withColumn("data", F.when(good, F.col("data")).otherwise("0x0"))
    amounts = decode_amounts(checked)
    figures = ("amount", "amount_raw", "amount_hex")
    dated = amounts.withColumns(
        {
            **{c: F.when(good, F.col(c)) for c in figures},
            "data": F.col("_text"),
            "date": epoch_date(F.col("timestamp"), zone),
        }
    )
    return flag_contacts(dated, contracts).select(
        *TRANSFERS.fieldNames(), "data", "reject_reason"
    )


def rejected(decoded: DataFrame) -> DataFrame:
    """Logs that could not be decoded, with the reason and the raw amount text."""
    return decoded.where(F.col("reject_reason").isNotNull()).select(
        "block_number", "tx_pos", "log_pos", "tx_hash", "asset", "from", "to", "data",
        "reject_reason",
    )


def decode_transfers(
    receipts: DataFrame,
    registry: DataFrame,
    headers: DataFrame | None = None,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
    zone: str = "UTC",
) -> DataFrame:
    """Receipts to transfers in one lazy plan."""
    return accepted(decode_logs(receipts, registry, headers), contracts, zone)


CHAIN_ORDER = ("block_number", "tx_pos", "log_pos")


def in_chain_order(transfers: DataFrame) -> DataFrame:
    """Block, then receipt, then log.

    The positions are part of the range key, so one crowded block still spreads
    over several sort tasks.
    """
    return transfers.orderBy(*CHAIN_ORDER)

"""Does a transfer touch a known contract, on either side?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.sizing import fits_broadcast, key_filter, left_lookup, may_match
from ledgerline.sources.registry import CONTRACTS, contract_addresses

FLAGS = {"defi": "is_defi_transaction", "rollup": "is_rollup_transaction"}


def touches(addresses: Sequence[str]) -> Column:
    """``from`` or ``to`` is one of ``addresses``, whatever its letter case."""
    known = [a.lower() for a in addresses]
    if not known:
        return F.lit(False)
    return F.lower("from").isin(known) | F.lower("to").isin(known)


def flag_contacts(
    transfers: DataFrame,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
) -> DataFrame:
    """One flag column per category, by membership in literal lists.

    Categories are independent: a transfer may carry several flags.
    """
    return transfers.withColumns(
        {FLAGS[c]: touches(contract_addresses(p)) for c, p in contracts.items()}
    )


def either_flag() -> Column:
    return F.col("is_defi_transaction") | F.col("is_rollup_transaction")


def flag_contacts_from_table(
    transfers: DataFrame,
    dimension: DataFrame,
    categories: Mapping[str, str] = FLAGS,
    broadcast: bool | None = None,
) -> DataFrame:
    """The same flags from a ``category, address`` table of any size.

    ``broadcast`` is decided by measuring the table unless given; repeated
    addresses count in that measure, so it errs on the side of shuffling.
    A table that is too large is probed first through a filter of bounded size:
    only transfers that may touch a contract are moved, the rest has its flags
    where it lies.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dimension, "address")
    if broadcast:
        return _looked_up(transfers, dimension, categories, True)
    possible, rest = _possible_contacts(transfers, dimension)
    found = _looked_up(possible, dimension, categories, False)
    return found.unionByName(rest.withColumns({flag: F.lit(False) for flag in categories.values()}))


def _possible_contacts(transfers: DataFrame, dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transfers that may have a listed address on a side, and those that have none for sure."""
    words, size = key_filter(dimension.select(F.lower("address").alias("address")), "address")
    sides = {f"_may_{side}": F.lower(side) for side in ("from", "to")}
    probed = may_match(transfers, sides, words, size)
    either = F.col("_may_from") | F.col("_may_to")
    return probed.where(either).drop(*sides), probed.where(~either).drop(*sides)


def _looked_up(
    transfers: DataFrame, dimension: DataFrame, categories: Mapping[str, str], broadcast: bool
) -> DataFrame:
    by_address = dimension.groupBy(F.lower("address").alias("_address")).agg(
        *[F.bool_or(F.col("category") == c).alias(f"_{c}") for c in categories]
    )
    flagged = transfers
    for side in ("from", "to"):
        found = by_address.withColumnsRenamed({f"_{c}": f"_{c}_{side}" for c in categories})
        flagged = left_lookup(
            flagged.withColumn("_address", F.lower(side)), found, "_address", broadcast
        ).drop("_address")
    flags = {
        flag: F.coalesce(F.col(f"_{c}_from"), F.lit(False))
        | F.coalesce(F.col(f"_{c}_to"), F.lit(False))
        for c, flag in categories.items()
    }
    extra = [f"_{c}_{side}" for c in categories for side in ("from", "to")]
    return flagged.withColumns(flags).drop(*extra)


def touching(
    transfers: DataFrame, addresses: DataFrame, broadcast: bool | None = None
) -> DataFrame:
    """Only the transfers with an address of the one-column table on either side.

    Two equality lookups and a filter: an OR of two semi-joins has no equality
    to hash on and would become a nested loop.
    """
    listed = addresses.select(F.lit("listed").alias("category"), "address")
    if broadcast is None:
        broadcast = fits_broadcast(listed, "address")
    if not broadcast:
        transfers, _ = _possible_contacts(transfers, listed)
    marked = _looked_up(transfers, listed, {"listed": "_listed"}, broadcast)
    return marked.where("_listed").drop("_listed")

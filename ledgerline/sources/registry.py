"""Token registry and contract dimension, from fixed values or from the caller."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.fixed_values import DEFI_CONTRACTS, ROLLUP_CONTRACTS, TOKENS
from ledgerline.schemas import REGISTRY

CONTRACTS = {"defi": DEFI_CONTRACTS, "rollup": ROLLUP_CONTRACTS}


def select_tokens(
    assets: Iterable[str] | None = None, tokens: Sequence[tuple] = TOKENS
) -> list[tuple]:
    """Chosen enabled tokens in registry order; no choice or ``all`` means every one.

    A name that is unknown or disabled is an error rather than "everything".
    """
    chosen = set(assets or ())
    enabled = [t for t in tokens if t[4]]
    if not chosen or "all" in chosen:
        return enabled
    unknown = chosen - {t[0] for t in enabled}
    if unknown:
        raise ValueError(f"not an enabled asset: {', '.join(sorted(unknown))}")
    return [t for t in enabled if t[0] in chosen]


def token_registry(
    spark: SparkSession,
    assets: Iterable[str] | None = None,
    tokens: Sequence[tuple] = TOKENS,
) -> DataFrame:
    """Selected tokens as a table with lower-case addresses.

    Passed as Arrow data, so that Spark holds it as a local relation with an
    exact size and chooses broadcast or shuffle by that size. A list of rows
    would become an RDD of unknown size, which is never broadcast.
    """
    rows = select_tokens(assets, tokens)
    columns = zip(*rows) if rows else [[]] * len(REGISTRY)
    table = pa.table({f.name: list(c) for f, c in zip(REGISTRY, columns)})
    frame = spark.createDataFrame(table, REGISTRY)
    return frame.withColumn("address", F.lower("address"))


def protocol_dimension(
    spark: SparkSession,
    contracts: Mapping[str, Mapping[str, Sequence[str]]] = CONTRACTS,
) -> DataFrame:
    """``category, protocol, address``: one row per contract, lower-case."""
    nested = spark.createDataFrame(
        [(category, dict(protocols)) for category, protocols in contracts.items()],
        "category string, protocols map<string, array<string>>",
    )
    listed = nested.select("category", F.explode("protocols").alias("protocol", "addresses"))
    single = listed.select("category", "protocol", F.explode("addresses").alias("address"))
    return single.withColumn("address", F.lower("address"))


def contract_addresses(protocols: Mapping[str, Sequence[str]]) -> list[str]:
    """Lower-case addresses of one category, for literal membership tests."""
    return [a.lower() for addresses in protocols.values() for a in addresses]

"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def fits_broadcast(
    dimension: DataFrame,
    key: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """Counts rows and key bytes of a dimension (one distributed aggregate)."""
    size = dimension.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.octet_length(F.col(key))), F.lit(0)).alias("n_bytes"),
    ).first()
    return size.n_rows <= max_rows and size.n_bytes <= max_bytes


MOST_WORDS = 1 << 20


def key_filter(dimension: DataFrame, key: str, most_words: int = MOST_WORDS) -> tuple[DataFrame, int]:
    """A filter of the keys of a dimension as ``word, bits``, and its number of bits.

    Two bits of a key's hash are set, in words of 64; words without any are left out. There are
    16 to 32 bits for each row, but at most ``most_words`` words, which bounds what a probe
    broadcasts: a dimension that is too large for it only lets more through.
    """
    rows = dimension.agg(F.count("*")).first()[0]
    size = 64
    while size < 64 * most_words and size < 16 * rows:
        size *= 2
    places = dimension.select(F.explode(F.array(*_places(F.col(key), size))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    return words, size


def _places(key: Column, size: int) -> list[Column]:
    # the third part of the hash is free for the join that may follow
    code = F.xxhash64(key, F.lit(size))
    mask = F.lit(size - 1)
    return [code.bitwiseAND(mask), F.shiftrightunsigned(code, 32).bitwiseAND(mask)]


def may_match(facts: DataFrame, keys: dict[str, Column], words: DataFrame, size: int) -> DataFrame:
    """The facts with one flag for each key: False where the filter rules it out.

    The words are broadcast, as their number is bounded; no fact is moved.
    """
    for flag, key in keys.items():
        for k, place in enumerate(_places(key, size)):
            facts = facts.withColumn(f"_place{k}", place)
        passed = F.lit(True)
        for k in range(2):
            found = words.select(F.col("word").alias(f"_word{k}"), F.col("bits").alias(f"_bits{k}"))
            facts = facts.join(
                F.broadcast(found), F.shiftright(f"_place{k}", 6) == F.col(f"_word{k}"), "left"
            )
            bit = F.col(f"_place{k}").bitwiseAND(F.lit(63)).cast("int")
            there = F.call_function("shiftrightunsigned", F.col(f"_bits{k}"), bit).bitwiseAND(F.lit(1)) == 1
            passed = passed & F.coalesce(there, F.lit(False))
        facts = facts.withColumn(flag, passed).drop(
            *[f"_{name}{k}" for name in ("place", "word", "bits") for k in range(2)]
        )
    return facts


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    broadcast: bool,
    salts: int = SALTS,
) -> DataFrame:
    """Left join of facts to a dimension that is unique on ``key``.

    Small dimensions are broadcast. Large ones are shuffled on (key, salt): the
    dimension is repeated once per salt and each input partition of the facts
    goes to one salt, so a key held by a third of all rows is met by ``salts``
    tasks. The partition number is a safe salt: unlike a random one it is the
    same when a lost executor's task runs again.
    """
    if broadcast:
        return facts.join(F.broadcast(dimension), key, "left")
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = facts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.join(repeated.hint("merge"), [key, "_salt"], "left").drop("_salt")

"""Rounding and marks used when money leaves the tables as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_text(amount: Column) -> Column:
    """Two-decimal text of a double: nearest value, exact ties to even.

    The whole part is split off first. Both parts are exact doubles, so the
    formatter decides on the true binary fraction even for amounts whose
    shortest decimal spelling has fewer digits than the number itself. From 2^63
    on there is no fraction, and the digits are worked out in limbs. NULL for
    NULL; infinities and NaN have no money text and give NULL.
    """
    finite = F.abs(amount) < F.lit(float("inf"))
    size = F.when(finite & (F.abs(amount) < F.lit(2.0**63)), F.abs(amount))
    whole = F.floor(size)
    cents = F.format_number(size - whole, 2)
    carried = whole + F.when(cents.startswith("1"), F.lit(1)).otherwise(F.lit(0))
    sign = F.when(amount < 0, F.lit("-")).otherwise(F.lit(""))
    text = F.concat(carried.cast("string"), F.right(cents, F.lit(3)))
    large = F.concat(_large_whole(F.when(finite, F.abs(amount))), F.lit(".00"))
    return F.concat(sign, F.when(size.isNotNull(), text).when(finite, large))


def _large_whole(size: Column) -> Column:
    """All digits of a double from 2^63 on: a long times a power of two.

    The number is kept in limbs of nine digits, least first, and multiplied by 2^30 as often
    as it takes.
    """
    power = F.greatest(F.floor(F.log2(size)) - 60, F.lit(0)).cast("int")
    whole = F.floor(size / F.pow(F.lit(2.0), power)).cast("long")
    limb = F.lit(10**9)

    def times(limbs: Column, factor: Column) -> Column:
        def step(done: Column, digit: Column) -> Column:
            value = digit * factor + done["carry"]
            return F.struct(
                F.concat(done["limbs"], F.array(value % limb)).alias("limbs"),
                F.call_function("div", value, limb).alias("carry"),
            )

        start = F.struct(
            F.array().cast("array<bigint>").alias("limbs"), F.lit(0).cast("long").alias("carry")
        )
        return F.aggregate(
            limbs, start, step, lambda done: F.concat(done["limbs"], F.array(done["carry"]))
        )

    first = F.array(
        whole % limb,
        F.call_function("div", whole, limb) % limb,
        F.call_function("div", F.call_function("div", whole, limb), limb),
    )
    rounds = F.call_function("div", power, F.lit(30))
    repeated = F.when(rounds > 0, F.sequence(F.lit(1).cast("long"), rounds)).otherwise(
        F.array().cast("array<bigint>")
    )
    many = F.aggregate(repeated, first, lambda limbs, _: times(limbs, F.lit(2**30)))
    rest = F.pow(F.lit(2.0), power % 30).cast("long")
    digits = F.transform(
        F.reverse(times(many, rest)), lambda x: F.lpad(x.cast("string"), 9, "0")
    )
    return F.ltrim(F.array_join(digits, ""), F.lit("0"))


def whole_number(value: Column) -> Column:
    """Nearest whole number, exact ties to even."""
    return F.rint(value)


def currency_mark(symbol: Column) -> Column:
    return F.when(symbol == "EURC", F.lit("€")).otherwise(F.lit("$"))

"""Hexadecimal text, as a chain node returns it, to Spark values.

``conv`` is only applied to checked text of at most 15 digits (60 bits): past
64 bits it raises under ANSI mode, and on bad text it returns a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB = 15
_LIMB_BASE = 16**_LIMB
# 255 digits are below 2^1020, so a double; over 520 they are none for any decimals
_SURE_DIGITS, _MOST_DIGITS = 255, 520
_SHIFT = 1000
_EXACT_DOUBLE = 2**53


def block_key(number: Column) -> Column:
    """A block number as a node expects it: ``0x``, lower case, no padding."""
    return F.concat(F.lit("0x"), F.lower(F.hex(number)))


def is_hex(text: Column) -> Column:
    """Hexadecimal number text; the prefix is optional, ``0x`` alone is zero."""
    return text.rlike("^(0x|(0[xX])?[0-9a-fA-F]+)$")


def significant_digits(text: Column) -> Column:
    """Hex text without prefix and leading zeros; ``''`` for zero. Not checked."""
    prefixed = text.startswith("0x") | text.startswith("0X")
    body = F.when(prefixed, F.substring(text, 3, 2**30)).otherwise(text)
    return F.ltrim(body, F.lit("0"))


def hex_digits(text: Column) -> Column:
    """Significant digits of hex text, NULL if it is not a number."""
    return F.when(is_hex(text), significant_digits(text))


def _limb(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def low_limb(digits: Column) -> Column:
    """The last 15 digits as a long; the number itself if it has no more."""
    return F.when(digits == "", F.lit(0).cast("long")).otherwise(
        _limb(F.right(digits, F.lit(_LIMB)))
    )


def hex_to_long(text: Column) -> Column:
    """Hex text as a long; NULL if it is not a number or exceeds 60 bits."""
    digits = hex_digits(text)
    return F.when(F.length(digits) <= _LIMB, low_limb(digits))


def topic_address(topics: Column, position: int) -> Column:
    """Address in an indexed topic: its last 40 characters, case untouched."""
    return F.concat(F.lit("0x"), F.right(F.get(topics, F.lit(position)), F.lit(40)))


def raw_amount(digits: Column, low: Column) -> Column:
    """Integer amount as ``decimal(38,0)``; NULL where it needs over 120 bits."""
    size = F.length(digits)
    high = _limb(F.substring(digits, F.lit(1), size - F.lit(_LIMB))).cast("decimal(19,0)")
    wide = high * F.lit(_LIMB_BASE).cast("decimal(19,0)") + low.cast("decimal(19,0)")
    return F.when(size <= _LIMB, low.cast("decimal(38,0)")).when(
        size <= 2 * _LIMB, wide.cast("decimal(38,0)")
    )


def decimal_amount(digits: Column, low: Column, raw: Column, decimals: Column) -> Column:
    """``integer / 10**decimals`` as the nearest double.

    - below 2^53 both operands are exact doubles, so one division is exact
      rounding (this is nearly every row);
    - up to 120 bits the decimal text with an exponent is parsed, which rounds
      once;
    - beyond, the hex text is parsed as a hexadecimal float and divided, which
      rounds twice; from 2^1020 on it is parsed 2^1000 times smaller, so that only
      an amount that is itself too large becomes infinite.
    """
    size = F.length(digits)
    scale = F.pow(F.lit(10.0), decimals)
    small = F.concat(F.lit("0x"), F.left(digits, F.lit(_MOST_DIGITS)), F.lit(f"p-{_SHIFT}"))
    parsed = F.concat(raw.cast("string"), F.lit("E-"), decimals.cast("string"))
    hex_float = F.concat(F.lit("0x"), digits, F.lit("p0"))
    return (
        F.when((size <= _LIMB) & (low < _EXACT_DOUBLE), low.cast("double") / scale)
        .when(size <= 2 * _LIMB, parsed.cast("double"))
        .when(size <= _SURE_DIGITS, hex_float.cast("double") / scale)
        .otherwise(small.cast("double") / scale * F.lit(2.0**_SHIFT))
    )


def exceeds_double(digits: Column, decimals: Column) -> Column:
    """Whether an amount of these significant digits is too large for a double."""
    size = F.length(digits)
    nothing = F.lit(None).cast("decimal(38,0)")
    amount = decimal_amount(digits, F.lit(0).cast("long"), nothing, decimals)
    infinite = F.abs(amount) == F.lit(float("inf"))
    return (size > _MOST_DIGITS) | ((size > _SURE_DIGITS) & infinite)

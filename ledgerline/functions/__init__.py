"""Column expressions. All are built-in Spark functions; none is a UDF."""

from ledgerline.functions.dates import epoch_date, text_date
from ledgerline.functions.hexadecimal import (
    block_key,
    decimal_amount,
    exceeds_double,
    hex_digits,
    hex_to_long,
    is_hex,
    low_limb,
    raw_amount,
    significant_digits,
    topic_address,
)
from ledgerline.functions.money import currency_mark, money_text, whole_number

__all__ = [
    "block_key",
    "currency_mark",
    "decimal_amount",
    "exceeds_double",
    "epoch_date",
    "hex_digits",
    "hex_to_long",
    "is_hex",
    "low_limb",
    "money_text",
    "raw_amount",
    "significant_digits",
    "text_date",
    "topic_address",
    "whole_number",
]

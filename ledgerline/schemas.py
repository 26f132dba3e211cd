"""Table schemas. The narrow read schemas are the column pruning for JSON."""

from pyspark.sql import types as T

LOG = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("data", T.StringType()),
    ]
)

RECEIPT = T.StructType(
    [
        T.StructField("transactionHash", T.StringType()),
        T.StructField("logs", T.ArrayType(LOG)),
    ]
)

HEADERS = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

RECEIPTS = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("receipts", T.ArrayType(RECEIPT)),
    ]
)

# One record per block holding header time and receipts together. Landing
# blocks this way makes the header join, and its shuffle, unnecessary.
BLOCKS = T.StructType(HEADERS.fields + [RECEIPTS["receipts"]])

REGISTRY = T.StructType(
    [
        T.StructField("asset", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("decimals", T.IntegerType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("enabled", T.BooleanType(), False),
    ]
)

TRANSFERS_CSV = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("tx_hash", T.StringType()),
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("is_defi_transaction", T.BooleanType()),
        T.StructField("is_rollup_transaction", T.BooleanType()),
    ]
)

TRANSFERS = T.StructType(
    TRANSFERS_CSV.fields
    + [
        T.StructField("amount_raw", T.DecimalType(38, 0)),
        T.StructField("amount_hex", T.StringType()),
        T.StructField("tx_pos", T.IntegerType()),
        T.StructField("log_pos", T.IntegerType()),
        T.StructField("asset", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("tx_pos", T.IntegerType()),
        T.StructField("log_pos", T.IntegerType()),
        T.StructField("tx_hash", T.StringType()),
        T.StructField("asset", T.StringType()),
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

DAILY = T.StructType(
    [
        T.StructField("asset", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("transfer_count", T.LongType()),
        T.StructField("avg_transfer_size", T.DoubleType()),
        T.StructField("different_addresses", T.LongType()),
        T.StructField("defi_transaction_count", T.LongType()),
        T.StructField("rollup_transaction_count", T.LongType()),
    ]
)

"""The transaction table: its columns, their types, and the corrupt-row column of the CSV reader."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

# The columns of the input, in file order.
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("customer_id", LongType()),
    StructField("customer_name", StringType()),
    StructField("city", StringType()),
    StructField("customer_type", StringType()),
    StructField("product_name", StringType()),
    StructField("category", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
    StructField("total_amount", DoubleType()),
])

TRANSACTION_COLUMNS = TRANSACTION_SCHEMA.fieldNames()

CORRUPT_COLUMN = "_corrupt_record"

#: The order of purchases: time first, then the id, so that tied times have one order.
PURCHASE_ORDER = ("timestamp", "transaction_id")

"""The given star-schema and event tables, seen as transactions.

Every fact row becomes a transaction: dimensions join from the left, and what they do not have is null.

Both facts, lines and orders, grow with the data, so they always meet by sort-merge join, whatever the size estimate of
orders says; a hot order is split by the adaptive skew join. No dimension carries a broadcast hint: Spark broadcasts one
only when its own size estimate is below ``spark.sql.autoBroadcastJoinThreshold``, and past that it shuffles and splits
hot keys. Customers meet orders before lines do, so the widest table is shuffled once on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.schema import TRANSACTION_COLUMNS

# The columns of the given tables. With them a query starts without a job that looks up the schema.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# The market segments that count as business customers.
BUSINESS_SEGMENTS = ("MACHINERY", "BUILDING", "AUTOMOBILE")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    customer = _table(spark, folder, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "city",
        F.when(F.col("c_mktsegment").isin(*BUSINESS_SEGMENTS), "B2B").otherwise("B2C").alias("customer_type"),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit(" Product_"), "p_size").alias("product_name"),
        F.concat("p_type", F.lit(" > "), "p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def lineitems_as_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order line."""
    orders = (
        _table(spark, folder, "orders")
        .select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("timestamp"))
        .join(_customers(spark, folder), "customer_id", "left")
    )
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    # Put together after the joins: its numbers are smaller on the way than its text.
    transaction_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity")
    return (
        lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"], "left")
        .join(_products(spark, folder), F.col("l_partkey") == F.col("p_partkey"), "left")
        .withColumn("transaction_id", transaction_id)
        .select(*TRANSACTION_COLUMNS)
    )


def events_as_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per event: its ``k`` property names the product and the quantity."""
    events = _table(spark, folder, "events").select(
        F.concat(F.lit("E"), "event_id").alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("int").alias("quantity"),
        F.col("value").alias("total_amount"),
    )
    return (
        events.join(_customers(spark, folder), "customer_id", "left")
        .join(_products(spark, folder), F.col("quantity").cast("long") == F.col("p_partkey"), "left")
        .select(*TRANSACTION_COLUMNS)
    )

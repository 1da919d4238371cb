"""One customer, product, day and copy hold much of the table: results stay whole and hot joins are split."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope import sources
from salescope.operators import cleaning, clustering, customers, encoding, exploration, sampling, spending
from salescope.plans.registry import ev
from salescope.sources import star


@pytest.fixture(scope="module")
def hot(spark, sf):
    """Two thirds of the events belong to customer 7, in the same city, at one time, with one product."""
    rows = ev(spark, sf)
    is_hot = F.pmod(F.hash("transaction_id"), F.lit(3)) > 0
    seven = {"customer_id": F.lit(7).cast("long"), "customer_name": F.lit("Seven"), "city": F.lit("X"),
             "customer_type": F.lit("B2B"), "product_name": F.lit("P Product_1"), "category": F.lit("A > B"),
             "timestamp": F.lit("2024-01-05 06:07:08").cast("timestamp_ntz")}
    rows = rows.withColumns({c: F.when(is_hot, v).otherwise(F.col(c)) for c, v in seven.items()})
    return sources.materialise(rows.repartition(5), "hot")


def test_windows_over_a_hot_customer(hot):
    """The same as one window per customer."""
    whole = Window.partitionBy("customer_id").orderBy("timestamp", "transaction_id")
    plain = hot.withColumns({
        "next_amount": F.lead("total_amount").over(whole),
        "sequence": F.collect_list("total_amount").over(whole.rowsBetween(-4, 0)),
    }).where(F.size("sequence") == 5)
    chunked = customers.amount_sequences(hot)
    plain = plain.select(*chunked.columns)
    assert plain.exceptAll(chunked).count() == 0 == chunked.exceptAll(plain).count()


def test_a_hot_customer_is_spread_over_chunks(spark, hot):
    """With small target partitions the hot customer's rows lie in several chunks, none with more than half of them."""
    seen = {}
    materialise = sources.scratch.materialise

    def watch(df, name):
        result = materialise(df, name)
        if name == "chunks":
            seen.update({r["_chunk"]: r["count"] for r in result.groupBy("_chunk").count().collect()})
        return result

    from salescope.operators import ordering

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    original, ordering.materialise = ordering.materialise, watch
    try:
        customers.amount_sequences(hot).count()
    finally:
        ordering.materialise = original
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before or "64MB")
    assert len(seen) >= 4 and max(seen.values()) <= sum(seen.values()) / 2


def test_aggregates_and_samples_stay_whole(hot):
    n = hot.count()
    copies = hot.unionByName(hot.where("customer_id = 7")).unionByName(hot)
    assert cleaning.clean(copies).count() == n
    assert exploration.histogram(hot, "customer_type").agg(F.sum("n")).head()[0] == n
    means = spending.mean_customer_quantity(cleaning.enrich(hot), "customer_type").collect()
    assert {r.customer_type for r in means} == {"B2B", "B2C"}
    assert sampling.every_nth(hot, 40).count() == -(-n // 40)
    assert encoding.with_indexes(hot, {"city": "i"}).count() == n
    assert clustering.time_clusters(hot, k=2).count() == n


def test_hot_keys_in_the_adapter_joins_are_split(spark, tmp_path):
    """The order key of most lines: the adaptive skew join cuts its partition into several."""
    folder = str(tmp_path)

    def table(name, frame):
        frame.write.parquet(f"{folder}/{name}.parquet")

    table("nation", spark.createDataFrame([(0, "N", 0)], star.TABLES["nation"]))
    table("customer", spark.createDataFrame([(i, f"C{i}", 0, 0.0, "BUILDING") for i in range(50)], star.TABLES["customer"]))
    table("part", spark.createDataFrame([(0, "p", "b", "t", 1, 1.0)], star.TABLES["part"]))
    orders = spark.range(50).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1").alias("o_orderpriority"),
    )
    table("orders", orders)
    lines = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("l_orderkey"),
        F.lit(0).cast("long").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.rand(1).alias("l_quantity"), F.rand(2).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    table("lineitem", lines)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "200k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {n: spark.conf.get(n) for n in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        report = spending.top_spenders(sources.lineitems_as_transactions(spark, folder))
        rows = report.collect()
        text = report._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert rows[0].customer_id == 7
    assert "SortMergeJoin(skew=true)" in text

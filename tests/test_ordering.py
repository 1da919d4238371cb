"""Positions and neighbours, against plain Python on small hand-made frames."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from salescope.operators.ordering import with_neighbours, with_position
from salescope.operators.sampling import every_nth, last_rows
from salescope.plans.registry import ev, tx


def purchases(spark, seed=5, hot=400):
    """One customer with most rows, one with tied times only, some with few rows, and null amounts."""
    rng = random.Random(seed)
    rows = []
    for customer, count in [(1, hot), (2, hot // 2), (3, 4), (4, 1), (5, 30), (None, 7)]:
        for i in range(count):
            second = 0 if customer == 2 else rng.randrange(40)
            amount = None if rng.random() < 0.1 else round(rng.uniform(1, 100), 2)
            rows.append((customer, second, f"T{customer}-{i:05d}", amount))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "customer_id long, second int, transaction_id string, total_amount double")
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, second)")
    return frame.withColumn("timestamp", stamp).select("customer_id", "timestamp", "transaction_id", "total_amount")


def brute_force(rows, length):
    key = lambda r: (r.customer_id is None, r.customer_id or 0)
    ordered = sorted(rows, key=lambda r: (key(r), r.timestamp, r.transaction_id))
    out = {}
    for _, group in itertools.groupby(ordered, key=key):
        group = list(group)
        for i, r in enumerate(group):
            after = group[i + 1] if i + 1 < len(group) else None
            run = [g.total_amount for g in group[max(0, i - length + 1): i + 1] if g.total_amount is not None]
            out[r.transaction_id] = (after and after.timestamp, after and after.total_amount, run)
    return out


@pytest.mark.parametrize("length", [1, 2, 5, 9])
def test_neighbours_of_hot_and_ordinary_customers(spark, length):
    df = purchases(spark).repartition(3)
    result = with_neighbours(
        df,
        following={"next_time": "timestamp", "next_amount": "total_amount"},
        trailing={"run": "total_amount"},
        length=length,
    )
    assert result.columns == [*df.columns, "next_time", "next_amount", "run"]
    got = {r.transaction_id: (r.next_time, r.next_amount, r.run) for r in result.collect()}
    assert got == brute_force(df.collect(), length)


def test_many_chunks_shorter_than_the_run(spark):
    """More range partitions than rows per customer: the carried rows come from several chunks back."""
    df = purchases(spark, hot=40)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        result = with_neighbours(
            df, following={"n": "timestamp", "a": "total_amount"}, trailing={"run": "total_amount"}, length=6,
        )
        got = {r.transaction_id: (r.n, r.a, r.run) for r in result.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == brute_force(df.collect(), 6)


def test_only_following_or_only_trailing(spark):
    df = purchases(spark)
    want = brute_force(df.collect(), 3)
    after = with_neighbours(df, following={"n": "timestamp"})
    assert {r.transaction_id: r.n for r in after.collect()} == {k: v[0] for k, v in want.items()}
    run = with_neighbours(df, trailing={"run": "total_amount"}, length=3)
    assert {r.transaction_id: r.run for r in run.collect()} == {k: v[2] for k, v in want.items()}


def test_many_hot_customers_and_a_hot_null(spark):
    """6,000 customers with as many rows each, and a third of all rows without a customer, in many chunks."""
    rows = spark.range(6000 * 12).selectExpr(
        "case when id % 3 = 0 then null else id % 6000 end as customer_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 977) as timestamp",
        "concat('T', id) as transaction_id", "cast(id as double) as total_amount",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = with_neighbours(rows, following={"n": "timestamp", "a": "total_amount"},
                               trailing={"run": "total_amount"}, length=4)
        got = {r.transaction_id: (r.n, r.a, r.run) for r in made.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_force(rows.collect(), 4)


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_follow_the_order(spark, partitions):
    df = purchases(spark).repartition(partitions)
    got = [r.transaction_id for r in with_position(df, "timestamp", "transaction_id").orderBy("position").collect()]
    assert got == [r.transaction_id for r in df.orderBy("timestamp", "transaction_id").collect()]
    positions = [r.position for r in with_position(df, F.desc("total_amount"), "transaction_id").collect()]
    assert sorted(positions) == list(range(df.count()))


def test_sampling(spark):
    df = purchases(spark)
    ordered = [r.transaction_id for r in df.orderBy("timestamp", "transaction_id").collect()]
    assert sorted(r.transaction_id for r in every_nth(df, 40).collect()) == sorted(ordered[::40])
    assert [r.transaction_id for r in last_rows(df, 10).collect()] == ordered[::-1][:10]
    assert every_nth(df.limit(0), 40).count() == 0


def test_given_tables_need_no_cleaning(spark, sf):
    for frame in (tx(spark, sf), ev(spark, sf)):
        ids = frame.agg(F.count("*"), F.countDistinct("transaction_id"), *[F.count(c) for c in frame.columns]).head()
        assert len(set(ids)) == 1

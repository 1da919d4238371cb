"""Edge cases of cleaning, columns, aggregates and the median, on small hand-made frames."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from salescope import functions as fn
from salescope.operators import cleaning, customers, exploration, spending
from salescope.plans.registry import tx
from salescope.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

WHEN = dt.datetime(2024, 2, 29, 23, 59, 58, 999999)


def row(**changes):
    base = dict(
        transaction_id="T1", timestamp=WHEN, customer_id=1, customer_name="A", city="X", customer_type="B2B",
        product_name="Lamp Product_12", category="Home > Light", price=2.0, quantity=3, total_amount=6.0,
    )
    return tuple({**base, **changes}[c] for c in TRANSACTION_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSACTION_SCHEMA)


def test_clean_drops_nulls_and_copies(spark):
    broken = [row(transaction_id=f"N{c}", **{c: None}) for c in TRANSACTION_COLUMNS if c != "transaction_id"]
    broken.append(row(transaction_id=None))
    df = frame(spark, row(), row(), row(transaction_id="T2"), *broken)
    assert sorted(r.transaction_id for r in cleaning.clean(df).collect()) == ["T1", "T2"]
    assert cleaning.drop_incomplete(df).count() == 3
    assert cleaning.drop_duplicates(df).count() == 2 + len(broken)
    assert cleaning.clean(df.limit(0)).count() == 0
    odd = frame(spark, row(), row(price=float("nan")), row(quantity=None))
    assert cleaning.drop_incomplete(odd).collect() == odd.na.drop("any").collect()


@pytest.mark.parametrize("by", [(), ("transaction_id",), ("price", "quantity")])
def test_clean_in_parts_has_the_rows_of_clean(spark, by):
    """Copies share a part, also those of which one has a zero with a sign."""
    rows = [row(transaction_id=f"T{i % 40}", price=float(i % 4), quantity=i % 3) for i in range(200)]
    rows += [row(price=0.0), row(price=-0.0), row(price=float("nan")), row(quantity=None), row(transaction_id=None)]
    df = frame(spark, *rows)
    want = sorted(map(str, cleaning.clean(df).collect()))
    assert len(want) == len(set(want)) == 121
    assert all(sorted(map(str, cleaning.clean_in_parts(df, by, parts).collect())) == want for parts in (1, 5))
    assert cleaning.clean_in_parts(df.limit(0), by, 2).count() == 0


def test_category_without_a_second_part(spark):
    df = frame(spark, row(), row(transaction_id="T2", category="Home"), row(transaction_id="T3", category=None))
    got = {r.transaction_id: (r.main_category, r.sub_category) for r in cleaning.enrich(df).collect()}
    assert got == {"T1": ("Home", "Light"), "T2": ("Home", None), "T3": (None, None)}


def test_calendar(spark):
    got = cleaning.enrich(frame(spark, row())).head()
    assert (got.month, got.weekday) == (2, 5)  # a Thursday, Sunday being 1
    parts = frame(spark, row()).select(*[c.alias(n) for n, c in fn.date_parts("timestamp").items()]).head()
    assert tuple(parts) == (WHEN.date(), 2024, 2, 5, 23)
    assert frame(spark, row()).select(fn.day_name("timestamp")).head()[0] == "Thursday"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Apia"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    # Across the change to summer time in New York: two hours on the wall clock.
    text = spark.createDataFrame([("2024-03-10 01:30:00.9", "2024-03-10 03:30:00.1")], "a string, b string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = text.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        hours = times.select(fn.hours_between("a", "b")).head()[0]
        seconds = times.select(fn.seconds_of("a")).head()[0]
        skipped = text.select(fn.parse_timestamp(F.lit("2024-03-10 02:30:00.5"))).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours == 2.0
    assert skipped == dt.datetime(2024, 3, 10, 2, 30, 0, 500000)
    assert seconds == int(dt.datetime(2024, 3, 10, 1, 30, tzinfo=dt.timezone.utc).timestamp())


def test_small_column_expressions(spark):
    df = spark.createDataFrame(
        [("Deck & Cabin > Hammock", "Hammock Product_1", [0.0, 2.0], 1, 0.0, "2024-01-02 03:04:05.678901"),
         ("Charts", "Product_7 Lamp", [], 0, 1.0, "nonsense")],
        "category string, product string, a array<double>, label int, predicted double, text string",
    )
    first, second = df.select(
        fn.clean_category("category").alias("c"), fn.clean_product("product").alias("p"), fn.strings_of("a").alias("s"),
        fn.class_weight("label").alias("w"), fn.prediction_error("predicted", "label").alias("e"),
        fn.file_label("category").alias("f"), fn.parse_timestamp("text").alias("t"),
    ).collect()
    assert tuple(first) == ("Deck & Cabin", "Hammock", ["0.0", "2.0"], 1.0, 1.0, "Deck_&_Cabin_>_Hammock",
                            dt.datetime(2024, 1, 2, 3, 4, 5, 678901))
    assert tuple(second) == ("Charts", "Product_7 Lamp", [], 2.0, 1.0, "Charts", None)


def test_repurchase_flag(spark):
    base = dt.datetime(2024, 1, 1)
    minutes = [0, 60, 121]
    df = frame(spark, *[row(transaction_id=f"T{i}", timestamp=base + dt.timedelta(minutes=m))
                        for i, m in enumerate(minutes)])
    got = {r.transaction_id: (r.hours_between, r.futur_purchase) for r in customers.with_next_purchase(df).collect()}
    assert got == {"T0": (1.0, 1), "T1": (61 / 60, 0), "T2": (None, 0)}


def test_profile_with_a_cut_off(spark):
    base = dt.datetime(2024, 1, 1)
    hours = {1: [0, 10, 20, 20.5], 2: [0, 0.5, 30], 3: [25], 4: [1]}
    df = frame(spark, *[
        row(transaction_id=f"T{c}-{h}", customer_id=c, timestamp=base + dt.timedelta(hours=h))
        for c, times in hours.items() for h in times
    ])
    whole = {r.customer_id: (r.nb_transaction, r.futur_purchase) for r in customers.customer_profiles(df).collect()}
    assert whole == {1: (4, 1), 2: (3, 1), 3: (1, 0), 4: (1, 0)}
    cut = customers.customer_profiles(df, features_until=base + dt.timedelta(hours=15))
    got = {r.customer_id: (r.nb_transaction, r.total_quantity, r.futur_purchase) for r in cut.collect()}
    assert got == {1: (2, 6, 1), 2: (2, 6, 0), 4: (1, 3, 0)}
    assert {r.futur_purchase: r.n for r in customers.class_balance(cut).collect()} == {0: 2, 1: 1}


def test_customers_without_a_purchase_do_not_lower_the_mean(spark):
    df = frame(
        spark,
        row(transaction_id="1", quantity=1), row(transaction_id="2", quantity=4),
        row(transaction_id="3", customer_id=2, quantity=7), row(transaction_id="4", customer_id=3, category="Books > X"),
    )
    means = spending.mean_customer_quantity(cleaning.enrich(df), "main_category").collect()
    assert {r.main_category: r.mean_quantity for r in means} == {"Home": 6.0, "Books": 3.0}


def test_one_scan_gives_all_quantity_reports(spark, sf):
    df = cleaning.enrich(tx(spark, sf))
    # Null groups must not be taken for columns left out of a report.
    df = df.withColumn("sub_category", F.when(F.col("sub_category") != "Brand#3", F.col("sub_category"))).persist()
    every = spending.quantity_reports(df).persist()
    for name, groups in spending.QUANTITY_REPORTS.items():
        single = spending.mean_customer_quantity(df, *groups)
        part = every.where(F.col("report") == name).select(*groups, "mean_quantity")
        assert single.count() == part.count() and single.exceptAll(part).count() == 0
    every.unpersist()
    df.unpersist()


def test_exploration_leaves_null_keys_out(spark):
    df = frame(spark, row(), row(transaction_id="T2", product_name=None), row(transaction_id="T3", customer_type=None))
    assert [r.n for r in exploration.top_products_by_count(df).collect()] == [1]
    assert [r.quantity for r in exploration.top_products_by_quantity(df).collect()] == [3]
    assert {r.customer_type: r.total_sales for r in exploration.sales_by(df, "customer_type").collect()} == {"B2B": 12.0}
    ratio = exploration.segment_ratio(df).head()
    assert (ratio.quantity_ratio, ratio.amount_ratio) == (None, None)
    assert exploration.segment(df, "B2B").count() == 2


def test_month_tables(spark):
    df = frame(
        spark, row(), row(transaction_id="T2", product_name="Bulb Product_1"),
        row(transaction_id="T3", timestamp=dt.datetime(2023, 12, 1)), row(transaction_id="T4", category="Books"),
    )
    wide = {r.clean_category: r for r in exploration.category_month_counts(df).collect()}
    assert (wide["Home"]["2"], wide["Home"]["12"], wide["Home"]["1"], wide["Books"]["2"]) == (2, 1, 0, 1)
    table = exploration.month_product_table(df, "Home", ["Lamp", "Bulb"]).orderBy("month").collect()
    assert [tuple(r) for r in table] == [(2, 1, 1), (12, 1, 0)]


@pytest.mark.parametrize("make", [
    lambda r, n: [r.gauss(0, 1) for _ in range(n)],
    lambda r, n: [float(r.randrange(3)) for _ in range(n)],
    lambda r, n: [1e12 if r.random() < 0.01 else r.random() for _ in range(n)],
    lambda r, n: [5.0] * n,
    lambda r, n: [1.0] * (n // 2) + [2.0] * (n - n // 2),
    lambda r, n: [2.0 ** r.randrange(-500, 500) for _ in range(n)],
])
def test_exact_median_by_narrowing(spark, make):
    for size in (1, 2, 9, 2000, 2001):
        values = make(random.Random(size), size)
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
        for at_most in (5, 10**6):
            assert exploration.median(df, "x", "m", at_most=at_most).head().m == statistics.median(values)


def test_median_of_nothing_and_by_sketch(spark, sf):
    assert exploration.median(spark.createDataFrame([], "x double"), "x", "m").head().m is None
    exact, sketch = (exploration.median(tx(spark, sf), "total_amount", "m", exact=e).head().m for e in (True, False))
    assert abs(exact - sketch) < 0.01 * exact


def test_baskets_are_sets(spark):
    df = frame(spark, row(), row(transaction_id="T2"), row(transaction_id="T3", product_name=None))
    got = sorted(tuple(r) for r in customers.basket_terms(df).collect())
    assert got == [(1, "Category", "Home > Light"), (1, "Product", "Lamp Product_12")]


def test_quantity_reports_with_unknown_quantities_and_customers(spark, sf):
    """Customers whose quantities are all null in a group do not count there; the group stays. No customer is one customer."""
    df = cleaning.enrich(tx(spark, sf))
    known = (F.pmod("customer_id", F.lit(3)) > 0) & (F.col("main_category") != "PROMO")
    df = df.withColumns({"quantity": F.when(known, F.col("quantity")), "weekday": F.when(F.col("weekday") != 3, F.col("weekday"))})
    df = df.withColumn("customer_id", F.when(F.pmod("customer_id", F.lit(5)) > 0, F.col("customer_id"))).persist()
    every = spending.quantity_reports(df).persist()
    for name, groups in spending.QUANTITY_REPORTS.items():
        single = spending.mean_customer_quantity(df, *groups)
        part = every.where(F.col("report") == name).select(*groups, "mean_quantity")
        assert single.count() == part.count() and single.exceptAll(part).count() == 0
    every.unpersist()
    df.unpersist()

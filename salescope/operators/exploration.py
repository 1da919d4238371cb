"""Exploratory aggregates. Rows whose group key is null are left out, as in a data-frame notebook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions import clean_category, clean_product, day_name
from salescope.schema import PURCHASE_ORDER


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"clean_product": clean_product("product_name"), "clean_category": clean_category("category")}
    )


def with_month_and_day_name(df: DataFrame) -> DataFrame:
    return df.withColumns({"month": F.month("timestamp"), "weekday": day_name("timestamp")})


def segment(df: DataFrame, customer_type: str) -> DataFrame:
    return df.where(F.col("customer_type") == customer_type)


def in_category(df: DataFrame, category: str, column: str = "clean_category") -> DataFrame:
    return df.where(F.col(column) == category)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def segment_means(df: DataFrame) -> DataFrame:
    """Mean quantity and amount of a transaction, by customer type."""
    return _known(df, "customer_type").groupBy("customer_type").agg(
        F.avg("quantity").alias("mean_quantity"), F.avg("total_amount").alias("mean_amount")
    )


def segment_ratio(df: DataFrame) -> DataFrame:
    """How many times larger a B2B transaction is than a B2C one: one pass, one row."""

    def ratio(value: str) -> Column:
        b2b, b2c = (F.avg(F.when(F.col("customer_type") == t, F.col(value))) for t in ("B2B", "B2C"))
        return F.try_divide(b2b, b2c)

    return df.agg(ratio("quantity").alias("quantity_ratio"), ratio("total_amount").alias("amount_ratio"))


def _known(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def histogram(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (or combination of values)."""
    return _known(df, *columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _top_per_segment(df: DataFrame, measure: str, rows: int) -> DataFrame:
    # Tasks drop all but their own top rows of each segment before the shuffle (window group limit).
    order = Window.partitionBy("customer_type").orderBy(F.desc(measure), "clean_product")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows)


def top_products_by_count(df: DataFrame, rows: int = 10) -> DataFrame:
    """The products (suffix removed) with the most transactions, per customer type."""
    counts = histogram(with_clean_names(df), "customer_type", "clean_product")
    return _top_per_segment(counts, "n", rows)


def top_products_by_quantity(df: DataFrame, rows: int = 10) -> DataFrame:
    """The products (suffix removed) with the largest quantity, per customer type."""
    known = _known(with_clean_names(df), "customer_type", "clean_product")
    sums = known.groupBy("customer_type", "clean_product").agg(F.sum("quantity").alias("quantity"))
    return _top_per_segment(sums, "quantity", rows)


def sales_by(df: DataFrame, column: str) -> DataFrame:
    return _known(df, column).groupBy(column).agg(F.sum("total_amount").alias("total_sales"))


def category_month_counts(df: DataFrame) -> DataFrame:
    """Transactions per main category (rows) and month (columns ``1`` to ``12``), 0 where there are none."""
    known = _known(with_month_and_day_name(with_clean_names(df)), "clean_category", "month")
    return known.groupBy("clean_category").pivot("month", list(range(1, 13))).count().na.fill(0)


def month_product_counts(df: DataFrame, category: str) -> DataFrame:
    """Transactions per month and product within one main category, in long form."""
    named = with_month_and_day_name(in_category(with_clean_names(df), category))
    return histogram(named, "month", "clean_product")


def month_product_table(df: DataFrame, category: str, products: list[str]) -> DataFrame:
    """``month_product_counts`` with one column per product, 0 where there are none."""
    long = month_product_counts(df, category)
    return long.groupBy("month").pivot("clean_product", products).agg(F.sum("n")).na.fill(0)


def earliest_rows(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.orderBy(*PURCHASE_ORDER).limit(rows)


def median(df: DataFrame, column: str, name: str, exact: bool = True, at_most: int = 200_000) -> DataFrame:
    """The median of a numeric column as a one-row frame.

    The approximate median is one pass with a sketch. The exact one narrows an open interval around the middle rank:
    each round takes two approximate percentiles just beside the middle, counts exactly what lies below, on and between
    them, and goes on with the part that holds the rank. Each round shrinks the part about two-thousandfold, and only when
    it has at most ``at_most`` rows are its values listed and sorted, so no task ever holds more than that.
    """
    known = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if not exact:
        return known.agg(F.percentile_approx("v", 0.5, 10_000).alias(name))
    total = known.count()
    if total == 0:
        return known.agg(F.max("v").alias(name))
    rank = (total - 1) // 2
    part, value = _narrow(known, rank, total, at_most)
    if value is None:
        part, rank = part
        value = part.agg(F.sort_array(F.collect_list("v"))[rank]).head()[0]
    if total % 2:
        return known.agg(F.lit(value).alias(name))
    # The upper of the two middle values is the same one if it repeats past the middle, else the next larger one.
    upto = F.count(F.when(F.col("v") <= value, 1))
    larger = F.min(F.when(F.col("v") > value, F.col("v")))
    upper = F.when(upto > total // 2, F.lit(value)).otherwise(larger)
    return known.agg(((F.lit(value) + upper) / 2).alias(name))


def _narrow(part: DataFrame, rank: int, rows: int, at_most: int):
    """Either ``(None, value)`` with the value at ``rank`` or ``((part, rank), None)`` with at most ``at_most`` rows."""
    while rows > at_most:
        middle = (rank + 0.5) / rows
        sides = [max(middle - 2e-4, 0.0), min(middle + 2e-4, 1.0)]
        low, high = part.agg(F.percentile_approx("v", sides, 10_000)).head()[0]
        v = F.col("v")
        counts = [v < low, v == low, (v > low) & (v < high), v == high]
        below, at_low, inside, at_high = part.agg(*[F.count(F.when(c, 1)) for c in counts]).head()
        if low == high:
            at_high = 0
        if rank < below:
            part, rows = part.where(v < low), below
        elif rank < below + at_low:
            return None, low
        elif rank < below + at_low + inside:
            part, rank, rows = part.where((v > low) & (v < high)), rank - below - at_low, inside
        elif rank < below + at_low + inside + at_high:
            return None, high
        else:
            used = below + at_low + inside + at_high
            part, rank, rows = part.where(v > high), rank - used, rows - used
    return (part, rank), None

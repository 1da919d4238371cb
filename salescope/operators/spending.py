"""Spending and quantity aggregates over enriched transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tasks that sort the customers' sums. So many, as Spark would put together partitions by their compressed size.
CUSTOMER_PARTITIONS = 128

# The groups over which mean customer quantities are reported.
QUANTITY_REPORTS = {
    "mean_qty_type_main": ("customer_type", "main_category"),
    "mean_qty_type_sub": ("customer_type", "main_category", "sub_category"),
    "mean_qty_main_month": ("main_category", "month"),
    "mean_qty_sub_month": ("main_category", "sub_category", "month"),
    "mean_qty_main_weekday": ("main_category", "weekday"),
    "mean_qty_sub_weekday": ("main_category", "sub_category", "weekday"),
}


def top_spenders(df: DataFrame, rows: int = 20) -> DataFrame:
    """The customers with the largest total amount. Each task keeps its own top rows, so nothing is sorted globally."""
    return (
        df.groupBy("customer_id", "customer_name", "customer_type")
        .agg(F.sum("total_amount").alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_id", "customer_name", "customer_type")
        .limit(rows)
    )


def mean_customer_quantity(df: DataFrame, *groups: str, quantity: str = "quantity") -> DataFrame:
    """Mean over customers of each customer's summed quantity per group.

    A customer without a purchase in a group does not count there. Both levels combine within tasks before they
    shuffle, so a customer or group with very many rows costs no more than any other.
    """
    per_customer = df.groupBy("customer_id", *groups).agg(F.sum(quantity).alias("quantity_sum"))
    return per_customer.groupBy(*groups).agg(F.avg("quantity_sum").alias("mean_quantity"))


def quantity_reports(df: DataFrame) -> DataFrame:
    """All quantity reports at once, one row per report and group; columns that are no part of a report are null.

    A group's mean is its quantity divided by its number of customers. Purchases are summed once by customer and all
    columns. These sums meet by customer, once, and one row of each customer and group of each report counts for it; so
    what the six reports multiply is combined within its task, and no report shuffles customers of its own. A customer
    with very many purchases has one row there for each combination of the columns at most.
    """
    columns = list(dict.fromkeys(c for groups in QUANTITY_REPORTS.values() for c in groups))
    finest = df.groupBy("customer_id", *columns).agg(F.sum("quantity").alias("quantity_sum"))
    # A customer whose quantities are all null in a group does not count there.
    counted = finest.repartition(CUSTOMER_PARTITIONS, "customer_id").withColumn("_known", F.col("quantity_sum").isNotNull())
    # A report with the sub-category and the one without it are sorted alike, so that they share a sort.
    for name, groups in sorted(QUANTITY_REPORTS.items(), key=lambda r: _by_main(r[1])):
        order = _by_main(groups)
        rest = [c for c in columns if c not in ("sub_category", *order)]
        own = Window.partitionBy("customer_id", "_known", *order).orderBy(
            *[c for c in ("sub_category",) if c not in order], rest[0]
        )
        first = F.col("_known") & (F.row_number().over(own) == 1)
        counted = counted.withColumn(f"_{name}", first.cast("int"))
    left_out = F.concat(*[F.grouping(c).cast("string") for c in columns])
    summed = counted.groupingSets([list(groups) for groups in QUANTITY_REPORTS.values()], *columns).agg(
        F.sum("quantity_sum").alias("_quantity"), left_out.alias("_left_out"),
        *[F.sum(f"_{name}").alias(f"_{name}") for name in QUANTITY_REPORTS],
    )
    report, customers = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for name, groups in QUANTITY_REPORTS.items():
        chosen = F.col("_left_out") == "".join("0" if c in groups else "1" for c in columns)
        report, customers = F.when(chosen, name).otherwise(report), F.when(chosen, F.col(f"_{name}")).otherwise(customers)
    mean = F.col("_quantity") / F.nullif(customers, F.lit(0))
    return summed.select(report.alias("report"), *columns, mean.cast("double").alias("mean_quantity"))


def _by_main(groups: tuple[str, ...]) -> tuple[str, ...]:
    """The columns of a report with the sub-category last."""
    return tuple(sorted(groups, key="sub_category".__eq__))

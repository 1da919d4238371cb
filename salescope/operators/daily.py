"""Reports kept up to date: partial results per day in a written state, to which loads of new days are merged.

The state has one row per day, customer and category with its sums, in one folder per month. A load brings whole days. Days
that the state has already are replaced by those of the load, so that a load that is run again counts once; other days of
the months it touches are kept, and folders of other months are not read. The load and the days kept are written to the
shared folder first and take their place by dynamic partition overwrite: a run that is lost half-way is run again.

Sums of sums are sums, so that the spending reports read the state as they read purchases. Medians need more: the state of
``load_sketches`` has a quantile sketch per day and customer type, which merge for any range of days.

Contract: purchases without a time are kept as one day of their own; an empty load changes nothing; nulls in the grouping
columns are groups; days without purchases in a load are left as they were.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.sources.scratch import discard, materialise, path_exists

# What the sums are kept by, besides the day.
STATE_GROUPS = ("customer_id", "customer_name", "customer_type", "main_category", "sub_category", "month", "weekday")
UNDATED = "undated"

# The columns of purchases that the two states are made from.
SUM_COLUMNS = ("timestamp", *STATE_GROUPS, "quantity", "total_amount")
SKETCH_COLUMNS = ("timestamp", "customer_type", "total_amount")

#: The size of a quantile sketch, and the share of ranks that its quantiles are off by with it (99 % sure).
SKETCH_SIZE = 400
RANK_ERROR = 2.296 / SKETCH_SIZE**0.9723


def _dated(df: DataFrame) -> DataFrame:
    day = F.to_date("timestamp")
    return df.withColumns({"day": day, "period": F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))})


def daily_sums(df: DataFrame) -> DataFrame:
    """Enriched purchases summed by day, customer and category: quantity, total_amount and their number."""
    return _dated(df).groupBy("period", "day", *STATE_GROUPS).agg(
        F.sum("quantity").alias("quantity"), F.sum("total_amount").alias("total_amount"),
        F.count(F.lit(1)).alias("purchases"),
    )


def daily_sketches(df: DataFrame) -> DataFrame:
    """Purchases by day and customer type: their number and a quantile sketch of their amounts."""
    known = F.col("total_amount").isNotNull() & ~F.isnan("total_amount")
    return _dated(df).where(known).groupBy("period", "day", "customer_type").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.kll_sketch_agg_double(F.col("total_amount").cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def _merge(new: DataFrame, path: str) -> None:
    """Put the days of ``new`` in place of those of the state."""
    spark = new.sparkSession
    new = materialise(new, "days")
    periods = [r[0] for r in new.select("period").distinct().collect()]
    if not periods:
        return
    merged, kept = new, None
    if path_exists(spark, path):
        # The periods are partitions: only theirs are read. One row a day is broadcast.
        old = read_state(spark, path, new).where(F.col("period").isin(periods))
        days = F.broadcast(new.select(F.col("day").alias("_day")).distinct())
        kept = materialise(old.join(days, F.col("day").eqNullSafe(F.col("_day")), "left_anti"), "kept-days")
        merged = new.unionByName(kept)
    # Small months end up in one file, large ones in several.
    laid = merged.hint("rebalance", "period")
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    discard(new)
    if kept is not None:
        discard(kept)


def read_state(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """The state; ``like`` gives its columns, where a reader must not infer the period's type from folder names."""
    if like is not None:
        return spark.read.schema(like.schema).parquet(path).select(*like.columns)
    table = spark.read.parquet(path)
    return table.withColumn("period", F.col("period").cast("string"))


def load_sums(df: DataFrame, path: str) -> None:
    """Merge the days of enriched purchases into the state of sums."""
    _merge(daily_sums(df), path)


def load_sketches(df: DataFrame, path: str) -> None:
    """Merge the days of purchases into the state of sketches."""
    _merge(daily_sketches(df), path)


def between(state: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The days from ``first`` to ``last``; folders of other months are not read."""
    months = F.col("period").between(first.strftime("%Y-%m"), last.strftime("%Y-%m"))
    return state.where(months & F.col("day").between(F.lit(first), F.lit(last)))


def sketched_quantile(state: DataFrame, share: float, name: str, *groups: str) -> DataFrame:
    """The quantile of each group from its merged sketches, of at most ``RANK_ERROR`` from its rank, and the purchases."""
    merged = state.groupBy(*groups).agg(
        F.sum("purchases").alias("purchases"), F.kll_merge_agg_double(F.col("sketch"), F.lit(SKETCH_SIZE)).alias("_sketch")
    )
    return merged.select(*groups, "purchases", F.kll_sketch_get_quantile_double("_sketch", F.lit(share)).alias(name))


def rank_is_within(value: Column, amount: Column, share: float, error: float) -> Column:
    """An aggregate: whether a value's rank among the amounts is within ``error`` of ``share``, ties counting for it."""
    n = F.count(amount)
    return (F.count(F.when(amount < value, 1)) <= (share + error) * n) & (F.count(F.when(amount <= value, 1)) >= (share - error) * n)

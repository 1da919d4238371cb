"""Per-customer features: next purchase, profile, trailing amounts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions import SEQUENCE_LENGTH, class_weight, hours_between, repurchase_flag, wall_clock
from salescope.operators.ordering import with_neighbours
from salescope.sources.scratch import materialise, small_tasks

#: Tasks that take the terms out of the purchases.
TERM_PARTITIONS = 128


def with_next_purchase(df: DataFrame, horizon_hours: float = 1.0) -> DataFrame:
    """Add the time of the customer's next purchase, the hours until then, and whether it is within the horizon."""
    following = with_neighbours(df, following={"date_next_purchase": "timestamp"})
    return following.withColumn("hours_between", hours_between("timestamp", "date_next_purchase")).withColumn(
        "futur_purchase", repurchase_flag("hours_between", horizon_hours)
    )


def customer_profiles(df: DataFrame, horizon_hours: float = 1.0, features_until=None) -> DataFrame:
    """One row per customer: spend, quantity, purchases, label, type and class weight.

    The label says whether the customer ever bought again within the horizon. By default it describes the same
    purchases as the features do. With a cut-off time ``features_until`` the features come from the purchases before it
    and the label from those at or after it (0 for a customer without any), so that it is a forecast.

    Only the columns used travel to the per-customer windows.
    """
    used = ["customer_id", "customer_type", "timestamp", "transaction_id", "quantity", "total_amount"]
    flagged = with_next_purchase(df.select(*used), horizon_hours)
    before = F.lit(True) if features_until is None else F.col("timestamp") < F.lit(features_until)
    after = F.lit(True) if features_until is None else F.col("timestamp") >= F.lit(features_until)
    profiles = flagged.groupBy("customer_id").agg(
        F.sum(F.when(before, F.col("total_amount"))).alias("total_spend"),
        F.sum(F.when(before, F.col("quantity"))).alias("total_quantity"),
        F.count(F.when(before, 1)).alias("nb_transaction"),
        F.coalesce(F.max(F.when(after, F.col("futur_purchase"))), F.lit(0)).alias("futur_purchase"),
        F.min(F.when(before, F.col("customer_type"))).alias("customer_type"),
    )
    if features_until is not None:
        profiles = profiles.where(F.col("nb_transaction") > 0)
    return profiles.withColumn("class_weight", class_weight("futur_purchase"))


def rolling_cuts(df: DataFrame, folds: int, horizon_hours: float) -> list[dt.datetime]:
    """Up to ``folds`` midnights, evenly many days apart, the last one a horizon before the last purchase at least.

    The first lies a step after the first purchase's day. Fewer, or none, if the purchases span too few days.
    """
    first, last = df.agg(F.min("timestamp"), F.max("timestamp")).first()
    if first is None:
        return []
    start = first.replace(hour=0, minute=0, second=0, microsecond=0)
    days = (last - dt.timedelta(hours=horizon_hours) - start).days
    step = max(days // folds, 1)
    return [start + dt.timedelta(days=step * i) for i in range(1, folds + 1) if step * i <= days]


def rolling_profiles(df: DataFrame, cuts: list[dt.datetime], horizon_hours: float) -> DataFrame:
    """One row per cut and customer that bought before it: the profile of the purchases before the cut, and as the label
    whether the customer buys again at the cut or within the horizon after it.

    One scan and one aggregate for all cuts: partial sums per customer hold a few numbers per cut, whatever its purchases.
    """
    if not cuts:
        return customer_profiles(df.limit(0)).select(F.lit(None).cast("timestamp_ntz").alias("cut"), "*")
    after = dt.timedelta(hours=horizon_hours)
    aggregates = []
    for cut in cuts:
        before = F.col("timestamp") < wall_clock(cut)
        soon = F.col("timestamp").between(wall_clock(cut), wall_clock(cut + after))
        aggregates.append(F.struct(
            wall_clock(cut).alias("cut"),
            F.sum(F.when(before, F.col("total_amount"))).alias("total_spend"),
            F.sum(F.when(before, F.col("quantity"))).alias("total_quantity"),
            F.count(F.when(before, 1)).alias("nb_transaction"),
            F.max(F.when(soon, 1).otherwise(0)).alias("futur_purchase"),
            F.min(F.when(before, F.col("customer_type"))).alias("customer_type"),
        ))
    grouped = df.groupBy("customer_id").agg(F.array(*aggregates).alias("_cuts"))
    rows = grouped.select("customer_id", F.inline("_cuts")).where(F.col("nb_transaction") > 0)
    names = ["cut", "customer_id", *[c for c in rows.columns if c not in ("cut", "customer_id")]]
    return rows.select(*names, class_weight("futur_purchase").alias("class_weight"))


def class_balance(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("futur_purchase").agg(F.count(F.lit(1)).alias("n"))


def amount_sequences(df: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Each purchase that ends a run of ``length`` amounts of its customer, with that run and the next amount.

    ``next_amount`` is null for a customer's last purchase: that is the amount to forecast.
    """
    used = ["customer_id", "timestamp", "transaction_id", "total_amount"]
    rows = with_neighbours(
        df.select(*used),
        following={"next_amount": "total_amount"},
        trailing={"sequence": "total_amount"},
        length=length,
    )
    return rows.where(F.col("sequence").isNotNull() & (F.size("sequence") == length))


def sequence_columns(length: int = SEQUENCE_LENGTH) -> dict:
    """The run of amounts as one column per position, oldest first."""
    return {f"amount_{i + 1}": F.col("sequence")[i] for i in range(length)}


def basket_terms(df: DataFrame) -> DataFrame:
    """What each customer ever bought, one row per customer and category or product.

    Copies are merged within tasks before the shuffle, and a customer's basket stays spread over many rows. The purchases
    are dealt out first, as what a task merges is much larger than what it reads: Spark would put together partitions of
    keys only, by their compressed size. Their time is dealt by, too, so that one customer's many purchases of a product
    are not one task's.
    """
    terms = F.explode(
        F.array(
            F.struct(F.lit("Category").alias("kind"), F.col("category").alias("term")),
            F.struct(F.lit("Product").alias("kind"), F.col("product_name").alias("term")),
        )
    )
    spread = df.select("customer_id", "category", "product_name", "timestamp").repartition(
        TERM_PARTITIONS, "customer_id", "category", "product_name", "timestamp"
    )
    long = spread.select("customer_id", terms.alias("t")).select("customer_id", "t.kind", "t.term")
    return long.where(F.col("term").isNotNull()).distinct()


def written_basket_terms(df: DataFrame) -> DataFrame:
    """``basket_terms`` as a written table, joined and merged by tasks that stay small as the purchases grow."""
    with small_tasks(df.sparkSession):
        return materialise(basket_terms(df), "terms")

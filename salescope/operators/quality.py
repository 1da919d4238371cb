"""How well scores tell two classes apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.sources.scratch import materialise


def area_under_roc(scored: DataFrame, score: str | Column, label: str | Column) -> float | None:
    """The exact area: the share of pairs of a 1 and a 0 of which the 1 has the higher score, ties counting half.

    Rows are counted by score and class first. The distinct scores are range-split; each task adds up the zeros below a score
    within its range, and the zeros of all lower ranges, one number each, are added. No scores are binned, no pairs are
    formed, and no task sees more than its range. Null if a class has no rows; null scores or labels count as no rows.
    """
    scored = scored.select(
        score.alias("_score") if isinstance(score, Column) else F.col(score).alias("_score"),
        (label if isinstance(label, Column) else F.col(label)).alias("_label"),
    ).where("_score is not null and _label is not null")
    counts = scored.groupBy("_score").agg(
        F.count(F.when(F.col("_label") == 1, 1)).alias("_ones"), F.count(F.when(F.col("_label") != 1, 1)).alias("_zeros")
    )
    laid = counts.repartitionByRange("_score").withColumn("_range", F.spark_partition_id())
    laid = materialise(laid, "scores")
    ranges = laid.groupBy("_range").agg(F.sum("_zeros").alias("_zeros"))
    # One row per range.
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    below = ranges.select("_range", F.coalesce(F.sum("_zeros").over(lower), F.lit(0)).alias("_below"))
    within = Window.partitionBy("_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    placed = laid.withColumn("_before", F.coalesce(F.sum("_zeros").over(within), F.lit(0))).join(F.broadcast(below), "_range")
    won = F.col("_ones") * (F.col("_below") + F.col("_before") + F.col("_zeros") / 2)
    row = placed.agg(F.sum(won).alias("won"), F.sum("_ones").alias("ones"), F.sum("_zeros").alias("zeros")).first()
    return row["won"] / (row["ones"] * row["zeros"]) if row["ones"] and row["zeros"] else None

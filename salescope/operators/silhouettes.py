"""Silhouettes for many numbers of clusters at once.

The squared-Euclidean silhouette needs no pairs: the mean squared distance of a point to all points of a cluster follows from
the cluster's weight, vector sum and sum of squared norms. So one scan over the points adds these up for the clusterings of
all numbers at once, and a second one turns them into the mean silhouette of each. Both are sums of fixed size.

The clusterings themselves are fitted on a lightweight coreset (Bachem, Lucic and Krause, 2018) where the points are many:
each point is drawn with the probability q = 1/2 share of weight + 1/2 share of squared distance to the mean, as often as
``CORESET`` draws give, with the weight w / (draws q). For m draws the cost of any k centres is off by at most
eps / 2 (cost + cost of the mean), with eps falling as sqrt(d k log k / m). Only fits use the coreset; every figure that
is reported is summed over all points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.shipping import ship

ship(__name__)

#: Expected draws of a coreset; as many points or fewer are used as they are.
CORESET = 20_000


def coreset(points: DataFrame, columns: tuple[str, ...], draws: int = CORESET) -> DataFrame:
    """(columns, weight): a coreset of weighted ``points``, or the points themselves if they are no more than ``draws``.

    A point's number of draws is Poisson, by a hash of its values and its ``_key``, if it has one: the same points give the
    same coreset, in any layout.
    """
    weighted = [F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns]
    sums = points.agg(F.count(F.lit(1)).alias("_n"), F.sum("weight").alias("_weight"), *weighted).first()
    if sums["_n"] <= draws:
        return points.select(*columns, "weight")
    # Tasks add up in any order, which moves the last digits; without them, the same points are drawn with the same weights.
    total = _settled(sums["_weight"])
    distance = _distance({c: _settled(sums[c] / total) for c in columns})
    spread = _settled(points.agg(F.sum(F.col("weight") * distance)).first()[0])
    q = F.col("weight") / (2 * total)
    q = q + (F.col("weight") * distance / (2 * spread) if spread else q)
    key = [F.col("_key")] if "_key" in points.columns else []
    uniform = (F.pmod(F.xxhash64(*columns, *key, F.lit(29)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    # An expected number below 1 is met by chance; what it has above comes for certain, as whole draws.
    expected = q * draws
    taken = F.floor(expected) + (uniform < expected - F.floor(expected)).cast("int")
    drawn = points.withColumns({"_q": expected, "_taken": taken}).where("_taken > 0")
    return drawn.select(*columns, (F.col("weight") * F.col("_taken") / F.col("_q")).alias("weight"))


def _settled(value: float) -> float:
    return float(f"{value:.12g}")


def _distance(centre: dict[str, float]) -> Column:
    parts = [(F.col(c) - F.lit(float(x))) ** 2 for c, x in centre.items()]
    return sum(parts[1:], parts[0])


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, of equally near ones the first."""
    return ((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)).argmin(axis=1)


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    *columns, weight = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns)
    return np.column_stack(columns), weight


def cluster_sums(points: DataFrame, columns: tuple[str, ...], centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each number of clusters an array with a row per cluster: weight, points, vector sum, sum of squared norms."""
    places = {k: at for at, k in enumerate(centres)}
    width = len(columns) + 3

    def add_up(batches):
        total = {k: np.zeros((len(c), width)) for k, c in centres.items()}
        for batch in batches:
            x, weight = _vectors(batch)
            parts = np.column_stack([weight, np.ones(len(x)), x * weight[:, None], (x * x).sum(axis=1) * weight])
            for k, c in centres.items():
                own = nearest(x, c)
                for j in range(width):
                    total[k][:, j] += np.bincount(own, parts[:, j], minlength=len(c))
        rows = [(places[k], at, v) for k, t in total.items() for at, v in enumerate(t.ravel())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64()))],
            names=["k", "place", "value"],
        )

    parts = points.select(*columns, "weight").mapInArrow(add_up, "k int, place int, value double")
    summed = {k: np.zeros((len(c), width)) for k, c in centres.items()}
    order = list(centres)
    for row in parts.groupBy("k", "place").agg(F.sum("value").alias("value")).collect():
        summed[order[row["k"]]].ravel()[row["place"]] = row["value"]
    return summed


def point_silhouettes(x: np.ndarray, weight: np.ndarray, own: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The silhouette of each point, given the sums of its clustering. A point alone in its cluster has 0."""
    size, used = sums[:, 0], sums[:, 0] > 0
    mean = np.full((len(x), len(sums)), np.inf)
    shift, square = sums[used, 2:-1] / size[used, None], sums[used, -1] / size[used]
    mean[:, used] = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ shift.T + square, 0.0)
    rows = np.arange(len(x))
    rest = size[own] - weight
    alone = (rest <= 1e-12 * size[own]) | (used.sum() < 2)
    inside = mean[rows, own] * size[own] / np.where(alone, 1.0, rest)
    mean[rows, own] = np.inf
    outside = mean.min(axis=1)
    larger = np.maximum(inside, outside)
    score = np.where(larger > 0, (outside - inside) / np.where((larger > 0) & np.isfinite(larger), larger, 1.0), 0.0)
    return np.where(alone, 0.0, score)


def mean_silhouettes(points: DataFrame, columns: tuple[str, ...], centres: dict[int, np.ndarray]) -> dict[int, float | None]:
    """The weighted mean silhouette of each clustering, exact over all points, in two scans whatever their number. Null
    without points."""
    sums = cluster_sums(points, columns, centres)
    order = list(centres)

    def score(batches):
        total, weights = dict.fromkeys(order, 0.0), 0.0
        for batch in batches:
            x, weight = _vectors(batch)
            weights += weight.sum()
            for k in order:
                total[k] += float((weight * point_silhouettes(x, weight, nearest(x, centres[k]), sums[k])).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(order)), pa.int32()), pa.array([total[k] for k in order], pa.float64()),
             pa.array([weights] * len(order), pa.float64())], names=["k", "total", "weight"],
        )

    parts = points.select(*columns, "weight").mapInArrow(score, "k int, total double, weight double")
    rows = parts.groupBy("k").agg((F.sum("total") / F.nullif(F.sum("weight"), F.lit(0.0))).alias("mean")).collect()
    means = {r["k"]: r["mean"] for r in rows}
    return {k: means.get(at) for at, k in enumerate(order)}


def silhouettes_by_definition(points: DataFrame, columns: tuple[str, ...], centres: np.ndarray) -> DataFrame:
    """(silhouette): the same figure for one clustering, by built-in functions from cluster means and variances."""
    distances = F.array(*[_distance(dict(zip(columns, c))) for c in centres])
    placed = points.withColumn("_own", F.array_position(distances, F.array_min(distances)).cast("int"))
    weight = F.sum("weight").alias("_size")
    sums = [(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c) for c in columns]
    squares = sum([F.sum(F.col(c) ** 2 * F.col("weight")) / F.sum("weight") for c in columns[1:]],
                  F.sum(F.col(columns[0]) ** 2 * F.col("weight")) / F.sum("weight")).alias("_square")
    clusters = {r["_own"]: r for r in placed.groupBy("_own").agg(weight, *sums, squares).collect()}
    if len(clusters) < 2:
        return points.agg(F.lit(0.0).alias("silhouette"))

    def mean_distance(r) -> Column:
        # The variance within the cluster plus the squared distance to its mean.
        within = r["_square"] - sum(r[c] ** 2 for c in columns)
        return _distance({c: r[c] for c in columns}) + within

    # Null for a cluster without points; the own cluster is left out of the others by its place.
    nothing = F.lit(None).cast("double")
    places = range(1, len(centres) + 1)
    means = F.array(*[mean_distance(clusters[at]) if at in clusters else nothing for at in places])
    sizes = F.array(*[F.lit(clusters[at]["_size"]) if at in clusters else nothing for at in places])
    scored = placed.withColumns({"_means": means, "_rest": F.element_at(sizes, F.col("_own")) - F.col("weight")})
    inside = F.element_at("_means", F.col("_own")) * (F.col("_rest") + F.col("weight")) / F.nullif(F.col("_rest"), F.lit(0.0))
    outside = F.array_min(F.transform("_means", lambda mean, at: F.when(at + 1 != F.col("_own"), mean)))
    scored = scored.withColumns({"_inside": inside, "_outside": outside})
    larger = F.nullif(F.greatest("_inside", "_outside"), F.lit(0.0))
    score = F.when(F.col("_inside").isNull(), 0.0).otherwise(F.coalesce((F.col("_outside") - F.col("_inside")) / larger, F.lit(0.0)))
    return scored.agg((F.sum(score * F.col("weight")) / F.sum("weight")).alias("silhouette"))

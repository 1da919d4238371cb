"""K-means over purchases, customers and purchase times, and the principal components of customer baskets."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.functions import clock_parts
from salescope.operators.components import principal_components, project
from salescope.operators.customers import written_basket_terms
from salescope.operators.encoding import (
    basket_entries,
    basket_vocabulary,
    deviations_of,
    scaled_columns,
    with_indexes,
)
from salescope.operators.silhouettes import coreset, mean_silhouettes, silhouettes_by_definition
from salescope.sources.scratch import materialise, small_tasks

#: Rows per partition of an iterative fit: of a small table, and of what lies beyond ``SMALL_PARTITIONS`` of those. The
#: partitions follow from these and from the number of rows alone. Each pass of a fit sends one result per partition to the
#: driver, twice, so that a large table has to have larger ones.
ROWS_PER_PARTITION, SMALL_PARTITIONS, MORE_ROWS_PER_PARTITION = 10_000, 400, 200_000

#: Numbers of clusters tried at the same time.
AT_ONCE = 4

# Cluster counts, the seed, and the feature columns of each clustering.
SEED = 42
ROW_COLUMNS = ("city_index", "customer_type_index", "quantity", "total_amount")
ROW_CLUSTERS = 5
CUSTOMER_CLUSTERS = 4
TIME_COLUMNS = ("hour", "day_of_week", "month")
TIME_CLUSTERS = 8
COMPONENTS = ("PC1", "PC2", "PC3")
TRIED_CLUSTERS = range(3, 20)


def canonical_layout(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """The same rows in the same partitions and order, whatever the layout of the input and the settings of the session.

    ``key`` must be unique, so that the partitions are even; ``rows`` is the number of rows, which alone decides the number
    of partitions. Seeded algorithms draw by partition, so they repeat only on such a layout.
    """
    return df.repartition(partitions_for(rows), *key).sortWithinPartitions(*key)


def partitions_for(rows: int) -> int:
    """The partitions of a fit over ``rows`` rows."""
    return min(rows // ROWS_PER_PARTITION, SMALL_PARTITIONS + rows // MORE_ROWS_PER_PARTITION) + 1


@dataclass(frozen=True)
class ScaledClusters:
    """A fitted clustering of rows by columns divided by their deviations. Applying it is one map over the rows."""

    deviations: dict[str, float]
    model: KMeansModel

    def assign(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df.withColumn("scaled", scaled_vector(self.deviations))).drop("scaled")


def scaled_vector(deviations: dict[str, float]) -> Column:
    """The scaled columns as one vector."""
    return array_to_vector(F.array(*scaled_columns(deviations).values()))


@dataclass(frozen=True)
class _Points:
    """What k-means is fitted on: points in a fixed layout, their weights, and the deviation of each column."""

    layout: DataFrame
    deviations: dict[str, float]

    @classmethod
    def of_rows(cls, df: DataFrame, columns: tuple[str, ...], key: str) -> _Points:
        """Every row, identified by ``key``, is a point. The key's hash spreads and orders the points; rows that agree in
        it and in all columns are interchangeable."""
        deviations, rows = deviations_of(df, *columns)
        points = df.select(F.xxhash64(key).alias("_key"), *columns, F.lit(1.0).alias("weight"))
        return cls(canonical_layout(points, rows, "_key", *columns), deviations)

    @classmethod
    def merged(cls, df: DataFrame, columns: tuple[str, ...]) -> _Points:
        """Equal rows are one point, with their number as its weight. The cost k-means minimises is the same, and after
        this one scan nothing but the points is read."""
        points = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
        points = materialise(points, "points")
        rows = F.sum("weight")
        means = points.agg(
            *[(F.sum(F.col(c) * F.col("weight")) / rows).alias(c) for c in columns], F.count(F.lit(1)).alias("_points")
        ).head()
        spread = {c: F.sum(F.col("weight") * (F.col(c) - F.lit(means[c])) ** 2) for c in columns}
        divisor = F.nullif(rows - 1, F.lit(0.0))
        deviations = points.agg(*[F.sqrt(s / divisor).alias(c) for c, s in spread.items()]).head()
        settled = {c: float(f"{d or 0.0:.12g}") for c, d in deviations.asDict().items()}
        return cls(canonical_layout(points, means["_points"], *columns), settled)

    @classmethod
    def of(cls, df: DataFrame, columns: tuple[str, ...], key: str | None) -> _Points:
        return cls.of_rows(df, columns, key) if key else cls.merged(df, columns)

    def scaled(self) -> DataFrame:
        return self.layout.select(scaled_vector(self.deviations).alias("scaled"), "weight")


def _kmeans(k: int, features: str) -> KMeans:
    return KMeans(featuresCol=features, k=k, seed=SEED).setWeightCol("weight")


def fit_clusters(df: DataFrame, columns: tuple[str, ...], k: int, key: str | None = None) -> ScaledClusters:
    """Fit k-means on scaled columns: over the rows, each identified by ``key``, or over merged points without one."""
    points = _Points.of(df, columns, key)
    return ScaledClusters(points.deviations, _kmeans(k, "scaled").fit(points.scaled()))


def placement(rows: DataFrame, columns: dict[str, Column], model: KMeansModel) -> DataFrame:
    """(rows, misplaced, clusters): rows that are not with their nearest centre, which a right assignment has none of."""

    def distance(centre) -> Column:
        parts = [(value - F.lit(float(x))) ** 2 for value, x in zip(columns.values(), centre)]
        return sum(parts[1:], parts[0])

    distances = F.array(*[distance(c) for c in model.clusterCenters()])
    own = F.element_at(distances, F.col("prediction") + 1)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((own > F.array_min(distances) + 1e-9).cast("bigint")).alias("misplaced"),
        F.lit(len(model.clusterCenters())).alias("clusters"),
    )


def row_placement(df: DataFrame) -> DataFrame:
    """``placement`` of the purchases in their clusters."""
    features = materialise(with_row_features(df).select("transaction_id", *ROW_COLUMNS), "row-features")
    fitted = fit_clusters(features, ROW_COLUMNS, ROW_CLUSTERS, key="transaction_id")
    return placement(fitted.assign(features), scaled_columns(fitted.deviations), fitted.model)


def time_placement(df: DataFrame) -> DataFrame:
    """``placement`` of the purchase times in their clusters."""
    timed = _with_clock(df)
    fitted = fit_clusters(timed, TIME_COLUMNS, TIME_CLUSTERS)
    return placement(fitted.assign(timed), scaled_columns(fitted.deviations), fitted.model)


def customer_placement(space: BasketSpace) -> DataFrame:
    """``placement`` of the customers in their clusters."""
    points = _customer_points(space)
    model = _kmeans(CUSTOMER_CLUSTERS, "point").fit(points)
    return placement(model.transform(points), {c: F.col(c) for c in COMPONENTS}, model)


def component_checks(space: BasketSpace) -> DataFrame:
    """Per component: features, its length, its overlap with the others, and the share of its image that is not along it.

    The image is worked out from the baskets, customer by customer, with the means taken off.
    """
    names = space.loadings.columns[1:]
    customers = space.scores.count()
    means = space.scores.agg(*[F.avg(c).alias(c) for c in names]).first()
    centred = space.scores.select("customer_id", *[(F.col(c) - means[c]).alias(c) for c in names])
    sums = space.entries.join(centred, "customer_id").groupBy("feature_id").agg(*[F.sum(c).alias(f"image_{c}") for c in names])
    with small_tasks(space.entries.sparkSession):
        both = materialise(space.loadings.join(sums, "feature_id"), "images")
    rows = []
    for c in names:
        image = F.col(f"image_{c}") / (customers - 1)
        along = both.agg(F.sum(F.col(c) * image)).first()[0]
        others = [F.abs(F.sum(F.col(c) * F.col(o))) for o in names if o != c]
        rows.append(both.agg(
            F.lit(c).alias("pc"), F.count(F.lit(1)).alias("features"), F.round(F.sqrt(F.sum(F.col(c) ** 2)), 6).alias("length"),
            F.round(F.greatest(*others), 6).alias("overlap"),
            F.round(F.sqrt(F.sum((image - F.lit(along) * F.col(c)) ** 2)) / along, 4).alias("residual"),
        ))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def silhouettes(df: DataFrame, columns: tuple[str, ...], ks=TRIED_CLUSTERS, key: str | None = None) -> DataFrame:
    """(k, silhouette): the squared-Euclidean silhouette for each number of clusters, over rows or merged points."""
    return _as_rows(df.sparkSession, fitted_silhouettes(scaled_points(df, columns, key), columns, ks)[1])


def scaled_points(df: DataFrame, columns: tuple[str, ...], key: str | None = None) -> DataFrame:
    """The scaled columns, with a weight, of every row or of the merged points; rows carry a hash of their key."""
    if key is None:
        points = _Points.merged(df, columns)
        return points.layout.select(*[v.alias(c) for c, v in scaled_columns(points.deviations).items()], "weight")
    deviations, _ = deviations_of(df, *columns)
    scaled = [v.cast("double").alias(c) for c, v in scaled_columns(deviations).items()]
    return df.select(F.xxhash64(key).alias("_key"), *scaled, F.lit(1.0).alias("weight"))


def fitted_silhouettes(points: DataFrame, columns: tuple[str, ...], ks) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """The centres for each number of clusters, and the silhouette of all points with them.

    The fits run on a coreset, which is small; they are independent, so a few run at a time. All points are scanned twice,
    however many numbers are tried.
    """
    small = materialise(coreset(points, columns), "coreset")
    vector = array_to_vector(F.array(*columns)).alias("point")
    small = canonical_layout(small, small.count(), *columns).select(vector, "weight").persist()

    def centres_of(k: int) -> np.ndarray:
        return np.array(_kmeans(k, "point").fit(small).clusterCenters())

    try:
        with ThreadPool(AT_ONCE) as pool:
            centres = dict(zip(ks, pool.map(inheritable_thread_target(points.sparkSession)(centres_of), ks)))
    finally:
        small.unpersist()
    return centres, mean_silhouettes(points, columns, centres)


def _as_rows(spark: SparkSession, scores: dict[int, float]) -> DataFrame:
    return spark.createDataFrame(sorted(scores.items()), "k int, silhouette double")


def silhouette_agreement(points: DataFrame, columns: tuple[str, ...], ks) -> DataFrame:
    """(k, agrees): whether the silhouette from sums is that worked out for its centres by built-in functions."""
    points = materialise(points, "silhouette-points")
    centres, scores = fitted_silhouettes(points, columns, ks)
    rows = []
    for k, c in centres.items():
        other = silhouettes_by_definition(points, columns, c).first()[0]
        rows.append((k, other is not None and abs(other - scores[k]) < 1e-6 and -1 <= scores[k] <= 1))
    return points.sparkSession.createDataFrame(rows, "k int, agrees boolean")


def with_row_features(df: DataFrame) -> DataFrame:
    """Purchases with city and customer type as numbers."""
    df = df.select("transaction_id", "city", "customer_type", "quantity", "total_amount")
    return with_indexes(df, {"customer_type": "customer_type_index", "city": "city_index"})


def row_clusters(df: DataFrame, k: int = ROW_CLUSTERS) -> DataFrame:
    """Every purchase with its cluster by city, customer type, quantity and amount."""
    features = materialise(with_row_features(df).select("transaction_id", *ROW_COLUMNS), "row-features")
    return fit_clusters(features, ROW_COLUMNS, k, key="transaction_id").assign(features)


def row_points(df: DataFrame) -> DataFrame:
    """Every purchase as a weighted point of scaled columns."""
    features = materialise(with_row_features(df).select("transaction_id", *ROW_COLUMNS), "row-features")
    return scaled_points(features, ROW_COLUMNS, "transaction_id")


def row_silhouettes(df: DataFrame, ks=TRIED_CLUSTERS) -> DataFrame:
    return _as_rows(df.sparkSession, fitted_silhouettes(row_points(df), ROW_COLUMNS, ks)[1])


def time_points(df: DataFrame) -> DataFrame:
    """The distinct purchase times as weighted points of scaled columns."""
    return scaled_points(_with_clock(df), TIME_COLUMNS)


def _with_clock(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", *[c.alias(n) for n, c in clock_parts("timestamp").items()])


def time_clusters(df: DataFrame, k: int = TIME_CLUSTERS) -> DataFrame:
    """Every purchase with its cluster by hour, weekday and month.

    There are at most 24 * 7 * 12 different points, so the fit runs on those with their counts as weights, and only the
    counting and the assignment pass over the purchases.
    """
    timed = _with_clock(df)
    return fit_clusters(timed, TIME_COLUMNS, k).assign(timed)


def time_silhouettes(df: DataFrame, ks=TRIED_CLUSTERS) -> DataFrame:
    return silhouettes(_with_clock(df), TIME_COLUMNS, ks)


@dataclass(frozen=True)
class BasketSpace:
    """Customer baskets as entries, their vocabulary, and the loadings of each term on each principal component."""

    entries: DataFrame
    vocabulary: DataFrame
    loadings: DataFrame
    explained_variance: list[float | None]
    scores: DataFrame


def basket_space(df: DataFrame, k: int = len(COMPONENTS)) -> BasketSpace:
    """Baskets of categories and products, reduced to their first ``k`` principal components: one fit for all uses."""
    terms = written_basket_terms(df)
    vocabulary = materialise(basket_vocabulary(terms), "vocabulary")
    with small_tasks(df.sparkSession):
        # Packing and scores deal these files out by customer, so that they have to be small as well.
        entries = materialise(basket_entries(terms, vocabulary), "baskets")
    loadings, variance = principal_components(entries, vocabulary, k)
    with small_tasks(df.sparkSession):
        scores = materialise(project(entries, loadings), "scores")
    return BasketSpace(entries, vocabulary, loadings, variance, scores)


def explained_variance(space: BasketSpace) -> DataFrame:
    """The share of the baskets' variance that each component explains."""
    rows = [(f"PC{i + 1}", share) for i, share in enumerate(space.explained_variance)]
    return space.entries.sparkSession.createDataFrame(rows, "pc string, explained_variance double")


def _customer_points(space: BasketSpace) -> DataFrame:
    vector = array_to_vector(F.array(*space.scores.columns[1:]))
    points = space.scores.withColumns({"point": vector, "weight": F.lit(1.0)})
    return canonical_layout(points, space.scores.count(), "customer_id")


def customer_clusters(space: BasketSpace, k: int = CUSTOMER_CLUSTERS) -> DataFrame:
    """Every customer with its components and its cluster by what it buys."""
    points = _customer_points(space)
    return _kmeans(k, "point").fit(points).transform(points).drop("point", "weight")


def customer_silhouettes(space: BasketSpace, ks=TRIED_CLUSTERS) -> DataFrame:
    points = space.scores.select(F.xxhash64("customer_id").alias("_key"), *COMPONENTS, F.lit(1.0).alias("weight"))
    return _as_rows(points.sparkSession, fitted_silhouettes(points, COMPONENTS, ks)[1])


def named_loadings(space: BasketSpace) -> DataFrame:
    """Each term, named ``Category: x`` or ``Product: y``, with its loading on every component."""
    name = F.concat(F.col("kind"), F.lit(": "), F.col("term")).alias("feature")
    return space.vocabulary.join(space.loadings, "feature_id").select(
        "feature_id", name, *space.loadings.columns[1:]
    )


def extremes_beyond(space: BasketSpace, rows: int = 10) -> DataFrame:
    """``extreme_features`` with ``beyond``: how many terms of all come before each, counted for every one of them anew.

    Right extremes have one less than their rank. The extremes are at most ``2 * rows`` per component, and go to the tasks.
    """
    ends = materialise(extreme_features(space, rows), "extremes")
    wide = named_loadings(space)
    counted = []
    for r in ends.collect():
        own = F.struct(F.lit(r["loading"]).alias("loading"), F.lit(r["feature"]).alias("feature"))
        ahead = F.col(r["pc"]) > own["loading"] if r["side"] == "best" else F.col(r["pc"]) < own["loading"]
        counted.append(F.struct(
            F.lit(r["pc"]).alias("pc"), F.lit(r["side"]).alias("side"), F.lit(r["rank"]).alias("rank"),
            F.count(F.when(ahead, 1)).alias("ahead"),
            F.count(F.when(ahead | (F.col(r["pc"]) == own["loading"]), 1)).alias("level"),
            F.max(F.when(F.col("feature") == own["feature"], F.col(r["pc"]))).alias("loading"), own["loading"].alias("listed"),
        ))
    found = wide.agg(F.array(*counted).alias("_found")).select(F.inline("_found"))
    right = F.col("ahead").between(0, F.col("rank") - 1) & (F.col("level") >= F.col("rank")) & (F.col("loading") == F.col("listed"))
    return found.select("pc", "side", "rank", right.alias("right"))


def extreme_features(space: BasketSpace, rows: int = 10) -> DataFrame:
    """The ``rows`` best and the ``rows`` worst terms of each component."""
    wide = named_loadings(space)
    long = wide.unpivot(["feature_id", "feature"], wide.columns[2:], "pc", "loading")

    def ends(side: str, order) -> DataFrame:
        ranked = Window.partitionBy("pc").orderBy(order, "feature_id")
        top = long.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= rows)
        return top.select("pc", F.lit(side).alias("side"), "rank", "feature", "loading")

    return ends("best", F.desc("loading")).unionByName(ends("worst", F.asc("loading")))

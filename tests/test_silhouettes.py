"""Silhouettes from sums against Spark's evaluator, the definition, and fits on a coreset."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from salescope.operators import clustering, silhouettes
from salescope.plans.registry import ev

COLUMNS = ("a", "b")


def _points(spark, rows):
    return spark.createDataFrame([(float(a), float(b), float(w)) for a, b, w in rows], "a double, b double, weight double")


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.normal(c, 1), rng.normal(-c, 2), 1 + rng.integers(0, 3)) for c in (0, 6, 13, 20) for _ in range(150)]
    return _points(spark, rows).repartition(4).persist()


@pytest.mark.parametrize("k", [2, 3, 7, 19])
def test_as_the_evaluator(points, k):
    vectors = points.select(array_to_vector(F.array(*COLUMNS)).alias("point"), "weight", *COLUMNS)
    model = KMeans(featuresCol="point", k=k, seed=1).setWeightCol("weight").fit(vectors)
    centres = np.array(model.clusterCenters())
    evaluator = ClusteringEvaluator(featuresCol="point", metricName="silhouette", weightCol="weight")
    want = evaluator.evaluate(model.transform(vectors))
    got = silhouettes.mean_silhouettes(points, COLUMNS, {k: centres})[k]
    assert got == pytest.approx(want, abs=1e-6)
    assert silhouettes.silhouettes_by_definition(points, COLUMNS, centres).first()[0] == pytest.approx(want, abs=1e-6)


def test_by_pairs_of_points(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 2)) * 5
    centres = x[:5]
    own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    pairs = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(60):
        mine = (own == own[i]) & (np.arange(60) != i)
        if not mine.any():
            scores.append(0.0)
            continue
        inside, outside = pairs[i][mine].mean(), min(pairs[i][own == c].mean() for c in set(own) - {own[i]})
        scores.append((outside - inside) / max(inside, outside))
    got = silhouettes.mean_silhouettes(_points(spark, [(*p, 1) for p in x]), COLUMNS, {5: centres})[5]
    assert got == pytest.approx(np.mean(scores), abs=1e-9)


def test_lone_points_one_cluster_and_no_points(spark):
    lone = _points(spark, [(0, 0, 1), (9, 9, 1), (10, 9, 1)])
    got = silhouettes.mean_silhouettes(lone, COLUMNS, {2: np.array([[0.0, 0], [9.5, 9]]), 1: np.zeros((1, 2))})
    assert got[1] == 0 and got[2] == pytest.approx(np.mean([0, 1 - 1 / 162, 1 - 1 / 181]))
    empty = silhouettes.mean_silhouettes(lone.limit(0), COLUMNS, {2: np.eye(2)})
    assert empty[2] is None


def test_coreset_keeps_weight_and_cost(spark):
    rows = spark.range(60_000).select(
        F.xxhash64("id").alias("_key"), (F.pmod(F.hash("id"), F.lit(7)) * 10 + F.rand(3)).alias("a"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(5)) * 9 + F.rand(4)).alias("b"), F.lit(1.0).alias("weight"))
    rows = rows.persist()
    small = silhouettes.coreset(rows, COLUMNS, 4000)
    again = silhouettes.coreset(rows.repartition(7), COLUMNS, 4000)
    n, weight = small.agg(F.count("*"), F.sum("weight")).first()
    assert 3400 < n < 4600 and weight == pytest.approx(60_000, rel=0.06)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, again.collect()))
    for centres in ([[0, 0]], [[30, 18], [0, 0], [60, 30]]):
        cost = F.array_min(F.array(*[silhouettes._distance(dict(zip(COLUMNS, c))) for c in centres])) * F.col("weight")
        assert small.agg(F.sum(cost)).first()[0] == pytest.approx(rows.agg(F.sum(cost)).first()[0], rel=0.06)
    assert silhouettes.coreset(rows.limit(10), COLUMNS, 10).count() == 10


def test_numbers_of_scans_do_not_follow_the_numbers_tried(spark, sf, monkeypatch):
    seen, original = [], silhouettes.cluster_sums
    monkeypatch.setattr(silhouettes, "cluster_sums", lambda *a: seen.append(1) or original(*a))
    got = clustering.time_silhouettes(ev(spark, sf), range(2, 9)).collect()
    assert len(seen) == 1 and [r.k for r in got] == list(range(2, 9)) and all(-1 <= r.silhouette <= 1 for r in got)

"""Properties of encodings, principal components and clusterings."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import PCA, CountVectorizer, CountVectorizerModel, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from salescope.operators import clustering, components, customers, encoding
from salescope.plans.registry import ev, tx
from salescope.sources import materialise


@pytest.fixture(scope="module")
def purchases(spark, sf):
    return materialise(tx(spark, sf), "test-tx")


@pytest.fixture(scope="module")
def space(purchases):
    return clustering.basket_space(purchases)


def test_label_index_equals_string_indexer(purchases):
    columns = ("customer_type", "city", "category", "product_name")
    ours = encoding.label_indexes(purchases, *columns).collect()
    for column in columns:
        labels = StringIndexer(inputCol=column, outputCol="i").fit(purchases).labels
        assert [r.label for r in sorted(ours, key=lambda r: r["index"]) if r["column"] == column] == labels


@pytest.mark.parametrize("bound", [0, 10**9])
def test_index_joined_either_way(purchases, monkeypatch, bound):
    monkeypatch.setattr(encoding, "BROADCAST_BYTES", bound)
    indexed = encoding.with_indexes(purchases, {"city": "city_index"})
    assert indexed.count() == purchases.count()
    pairs = {(r.label, r["index"]) for r in encoding.label_indexes(purchases, "city").collect()}
    assert {tuple(r) for r in indexed.select("city", "city_index").distinct().collect()} == pairs


def test_unseen_label_is_an_error_and_null_stays_null(spark, purchases):
    labels = encoding.label_indexes(purchases, "customer_type")
    known = spark.createDataFrame([("B2B",), (None,)], "customer_type string")
    got = encoding.with_indexes(known, {"customer_type": "i"}, labels).collect()
    assert {r.customer_type: r.i is None for r in got} == {"B2B": False, None: True}
    with pytest.raises(Exception, match="unseen label in customer_type: B2D"):
        unseen = spark.createDataFrame([("B2D",)], "customer_type string")
        encoding.with_indexes(unseen, {"customer_type": "i"}, labels).collect()


def test_scaling_divides_by_the_sample_deviation(spark):
    df = spark.createDataFrame([(float(i * i), 7.0) for i in range(9)], "a double, b double")
    deviations, rows = encoding.deviations_of(df, "a", "b")
    deviation = df.agg(F.stddev_samp("a")).head()[0]
    assert rows == 9
    for r in df.select("a", *[v.alias(f"s_{c}") for c, v in encoding.scaled_columns(deviations).items()]).collect():
        assert (r.s_a, r.s_b) == (pytest.approx(r.a / deviation), 0.0)


def test_vocabulary_counts_as_count_vectorizer(purchases):
    terms = customers.basket_terms(purchases)
    ours = encoding.basket_vocabulary(terms).orderBy("feature_id").collect()
    assert [r.feature_id for r in ours] == list(range(len(ours)))
    for kind in ("Category", "Product"):
        baskets = terms.where(F.col("kind") == kind).groupBy("customer_id").agg(F.collect_set("term").alias("t"))
        model = CountVectorizer(inputCol="t", outputCol="v").fit(baskets)
        counts = {r.term: r.customers for r in ours if r.kind == kind}
        assert sorted(model.vocabulary) == sorted(counts)
        assert [counts[t] for t in model.vocabulary] == [r.customers for r in ours if r.kind == kind]


def test_small_vocabulary_keeps_the_commonest_terms_and_all_customers(purchases):
    terms = customers.basket_terms(purchases)
    small, whole = encoding.basket_vocabulary(terms, size=3).collect(), encoding.basket_vocabulary(terms).collect()
    for kind in ("Category", "Product"):
        of_kind = sorted((r.feature_id, r.term) for r in whole if r.kind == kind)
        assert [t for _, t in of_kind[:3]] == [r.term for r in sorted(small) if r.kind == kind]
    assert sorted(r.feature_id for r in small) == list(range(6))
    baskets = encoding.basket_features(terms, encoding.basket_vocabulary(terms, size=3))
    assert baskets.count() == purchases.select("customer_id").distinct().count()


def test_lists_keep_all_customers_and_terms(purchases):
    terms = customers.basket_terms(purchases)
    lists = encoding.basket_lists(terms).collect()
    assert len(lists) == purchases.select("customer_id").distinct().count()
    assert sum(len(r.categories) + len(r.products) for r in lists) == terms.count()


def test_components_agree_with_numpy_and_spark(space):
    k = 3
    ids = {r.customer_id: i for i, r in enumerate(space.scores.orderBy("customer_id").collect())}
    matrix = np.zeros((len(ids), space.vocabulary.count()))
    for r in space.entries.collect():
        matrix[ids[r.customer_id], r.feature_id] = 1
    values, vectors = np.linalg.eigh(np.cov(matrix.T))
    loadings = np.array([tuple(r)[1:] for r in space.loadings.orderBy("feature_id").collect()])
    assert np.abs(loadings.T @ loadings - np.eye(k)).max() < 1e-9
    assert np.abs(np.sum(loadings * vectors[:, ::-1][:, :k], axis=0)) == pytest.approx(np.ones(k), abs=1e-6)
    assert space.explained_variance == pytest.approx(values[::-1][:k] / values.sum(), abs=1e-8)
    assert (loadings[np.abs(loadings).argmax(axis=0), range(k)] > 0).all()
    scores = np.array([tuple(r)[1:] for r in space.scores.orderBy("customer_id").collect()])
    assert np.abs(scores - matrix @ loadings).max() < 1e-9
    names = [str(i) for i in range(matrix.shape[1])]
    words = space.entries.groupBy("customer_id").agg(F.collect_list(F.col("feature_id").cast("string")).alias("w"))
    counted = CountVectorizerModel.from_vocabulary(names, "w", "v").transform(words)
    of_spark = PCA(k=k, inputCol="v", outputCol="c").fit(counted).pc.toArray()
    assert np.abs(np.abs(of_spark) - np.abs(loadings)).max() < 1e-5


def _entries(spark, baskets):
    rows = [(c, f) for c, basket in enumerate(baskets) for f in basket]
    entries = spark.createDataFrame(rows, "customer_id long, feature_id int")
    return entries, entries.groupBy("feature_id").agg(F.count("*").alias("customers"))


@pytest.mark.parametrize("baskets", [[range(5)], [range(601)] * 20])
def test_no_variance_has_no_components(spark, baskets):
    """One customer, or equal baskets: zero loadings, null shares, and an end."""
    loadings, share = components.principal_components(*_entries(spark, baskets), 3)
    assert share == [None] * 3 and loadings.count() == len(baskets[0])
    assert all(tuple(r)[1:] == (0.0, 0.0, 0.0) for r in loadings.collect())


def test_more_components_than_rank(spark):
    """Two customers span one direction; the other components are zero."""
    loadings, share = components.principal_components(*_entries(spark, [[0, 1, 2], [2, 3]]), 3)
    assert share == pytest.approx([1.0, 0.0, 0.0])
    got = np.array([tuple(r)[1:] for r in loadings.orderBy("feature_id").collect()])
    assert np.abs(got[:, 0]) == pytest.approx([3**-0.5, 3**-0.5, 0, 3**-0.5], abs=1e-6) and (got[:, 1:] == 0).all()


def test_wide_vocabulary_without_broadcast(spark, monkeypatch):
    """More than 512 terms, with one term in every basket, joined by shuffle."""
    rng = np.random.default_rng(3)
    strong = [set(range(600, 640)) if i % 3 == 0 else set(range(640, 660)) if i % 3 == 1 else set() for i in range(60)]
    baskets = [sorted({0, *s, *rng.integers(1, 600, 12).tolist()}) for s in strong]
    matrix = np.zeros((60, 660))
    for i, basket in enumerate(baskets):
        matrix[i, basket] = 1
    entries, vocabulary = _entries(spark, baskets)
    monkeypatch.setattr(components, "BROADCAST_BYTES", 0)
    loadings, share = components.principal_components(entries, vocabulary, 2)
    values = np.linalg.eigvalsh(np.cov(matrix.T))[::-1]
    assert share == pytest.approx(values[:2] / values.sum(), abs=1e-6)
    assert loadings.count() == vocabulary.count()


def test_products_shuffle_blocks_and_never_entries(space):
    """Entries are read where they lie: the only exchange is of partial blocks, above the multiplication."""
    ids = np.array(sorted(r.feature_id for r in space.vocabulary.collect()))
    baskets = components.PackedBaskets.of(space.entries, ids)
    assert baskets.customers == space.scores.count()
    block = np.random.default_rng(1).normal(size=(len(ids), 5))
    partial = baskets.partial_products(block, np.zeros(len(ids)))
    text = partial.repartition(2, "chunk")._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.index("MapInArrow") < text.index("Scan parquet") and text.count("Exchange") == 1
    assert partial.count() <= 2 * baskets.parts * (len(ids) // components.CHUNK_FEATURES + 1)


def test_packed_product_equals_numpy_for_any_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    matrix = (rng.random((90, 40)) < 0.2).astype(float)
    matrix[:, 0] = 1
    entries, _ = _entries(spark, [np.flatnonzero(r).tolist() for r in matrix])
    block, means = rng.normal(size=(40, 3)), matrix.mean(axis=0)
    want = np.cov(matrix.T) @ block
    for part, packed, chunk, at_once in ((10**6, 10**6, 4096, 64), (7, 5, 16, 2), (60, 30, 40, 3)):
        for name, value in (("PART_ENTRIES", part), ("PART_SHARE", 0), ("PACKED_ENTRIES", packed),
                            ("CHUNK_FEATURES", chunk), ("PARTS_AT_ONCE", at_once)):
            monkeypatch.setattr(components, name, value)
        got = components.PackedBaskets.of(entries, np.arange(40)).times(block, means)
        assert np.abs(got - want).max() < 1e-9


def test_restarts_of_the_krylov_space(space, monkeypatch):
    """A bound of four blocks: the space is rebuilt from its best vectors again and again, to the same end."""
    monkeypatch.setattr(components, "EXTRA", 3)
    monkeypatch.setattr(components, "DRIVER_BYTES", 8 * 6 * 8 * space.vocabulary.count())
    again, share = components.principal_components(space.entries, space.vocabulary, 3)
    assert share == pytest.approx(space.explained_variance, abs=1e-9)
    a, b = ({r.feature_id: tuple(r)[1:] for r in frame.collect()} for frame in (again, space.loadings))
    assert all(np.abs(np.subtract(a[f], b[f])).max() < 1e-4 for f in b)


def test_large_vocabularies_stay_in_tables(space, monkeypatch):
    monkeypatch.setattr(components, "DRIVER_BYTES", 0)
    seen, original = [], components._of_tables
    monkeypatch.setattr(components, "_of_tables", lambda *a: seen.append(1) or original(*a))
    small = space.vocabulary.where("feature_id < 60")
    entries = space.entries.where("feature_id < 60")
    loadings, share = components.principal_components(entries, small, 2)
    assert seen and loadings.count() == small.count() and share[0] > share[1] > 0


def test_extreme_features(space):
    wide = clustering.named_loadings(space).collect()
    got = clustering.extreme_features(space).collect()
    assert len(got) == 60
    for pc in clustering.COMPONENTS:
        ordered = sorted(r[pc] for r in wide)
        best = [r.loading for r in sorted(got, key=lambda r: r["rank"]) if (r.pc, r.side) == (pc, "best")]
        worst = [r.loading for r in sorted(got, key=lambda r: r["rank"]) if (r.pc, r.side) == (pc, "worst")]
        assert best == ordered[::-1][:10] and worst == ordered[:10]
    assert all(r.feature.startswith(("Category: ", "Product: ")) for r in wide)


def test_rows_go_to_the_nearest_centre(purchases):
    features = materialise(
        clustering.with_row_features(purchases).select("transaction_id", *clustering.ROW_COLUMNS), "test-rows"
    )
    fitted = clustering.fit_clusters(features, clustering.ROW_COLUMNS, 5, key="transaction_id")
    rows = fitted.assign(features)
    assert rows.count() == purchases.count()
    points = np.array([[float(r[c]) for c in clustering.ROW_COLUMNS] for r in rows.collect()])
    scaled = points / points.std(axis=0, ddof=1)
    centres = np.array(fitted.model.clusterCenters())
    nearest = ((scaled[:, None] - centres[None]) ** 2).sum(axis=2)
    chosen = np.array([r.prediction for r in rows.collect()])
    assert nearest[np.arange(len(chosen)), chosen] == pytest.approx(nearest.min(axis=1))


@pytest.mark.parametrize("cluster", [
    lambda df, space: clustering.row_clusters(df),
    lambda df, space: clustering.time_clusters(df),
])
def test_the_same_clusters_for_any_layout(purchases, cluster):
    results = [
        sorted((r.transaction_id, r.prediction) for r in cluster(purchases.repartition(n), None).collect())
        for n in (1, 4, 8)
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == purchases.count()


def test_the_same_clusters_for_any_session_settings(spark):
    """More than 100,000 rows, so that the fit has several partitions, under other numbers of shuffle partitions."""
    rows = spark.range(120_000).selectExpr(
        "concat('T', id) as transaction_id", "cast(pmod(hash(id), 1000) as double) as a",
        "cast(pmod(xxhash64(id), 77) as double) as b",
    )
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("2", "4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            fitted = clustering.fit_clusters(rows, ("a", "b"), 4, key="transaction_id")
            results.append(np.array(fitted.model.clusterCenters()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in results[1:]:
        assert np.abs(other - results[0]).max() < 1e-9


def test_merged_points_have_the_cost_of_all_rows(spark, sf):
    """The weighted fit on distinct times reaches a cost no worse than a fit on all rows by more than a little."""
    timed = ev(spark, sf).select("transaction_id", *[c.alias(n) for n, c in clustering.clock_parts("timestamp").items()])
    costs = []
    for key in (None, "transaction_id"):
        fitted = clustering.fit_clusters(timed, clustering.TIME_COLUMNS, 8, key=key)
        scaled = timed.select(vector_to_array(clustering.scaled_vector(fitted.deviations)))
        points = np.array([r[0] for r in scaled.collect()])
        centres = np.array(fitted.model.clusterCenters())
        costs.append(((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum())
        deviations = timed.agg(*[F.stddev_samp(c).alias(c) for c in clustering.TIME_COLUMNS]).head().asDict()
        assert fitted.deviations == pytest.approx(deviations)
        if key is None:
            assert fitted.model.summary.trainingCost == pytest.approx(costs[0])
    assert costs[0] < 1.25 * costs[1]


def test_customer_clusters_and_silhouettes(space, spark, sf):
    clusters = clustering.customer_clusters(space)
    assert clusters.columns == ["customer_id", *clustering.COMPONENTS, "prediction"]
    assert clusters.count() == space.scores.count()
    scores = clustering.customer_silhouettes(space, ks=(2, 3)).collect()
    assert [r.k for r in scores] == [2, 3] and all(-1 <= r.silhouette <= 1 for r in scores)


def test_tasks_do_not_import_the_package(tmp_path, sf):
    """Run where Python workers cannot find the package: another working folder, and a path set in the driver only."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parents[1])!r})
from pyspark.sql import SparkSession
from salescope.operators import clustering, components
from salescope.plans.registry import tx
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
space = clustering.basket_space(tx(spark, {sf!r}))
print("customers", space.scores.count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "customers 150" in done.stdout, done.stderr[-2000:]


def test_a_large_fit_has_few_results_for_the_driver():
    """As many partitions as ever for a small table; for a large one each holds twenty times the rows."""
    assert [clustering.partitions_for(n) for n in (0, 9_999, 10_000, 600_000, 4_000_000)] == [1, 1, 2, 61, 401]
    assert clustering.partitions_for(36_000_000) < 600 and clustering.partitions_for(216_000_000) < 1500

"""Properties of the repurchase classifier, the amount forecast, and the split."""

import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from salescope.operators import customers, prediction, quality, sampling
from salescope.operators.encoding import MinMax
from salescope.plans.registry import ev


@pytest.fixture(scope="module")
def profiles(spark):
    """Customers whose label follows their spend."""
    rng = random.Random(3)
    rows = []
    for c in range(400):
        spend = rng.uniform(0, 100)
        label = int(spend + rng.gauss(0, 10) > 40)
        rows.append((c, spend, rng.randrange(50), rng.randrange(1, 9), label, rng.choice(["B2B", "B2C"]), 2.0 - label))
    return spark.createDataFrame(
        rows,
        "customer_id long, total_spend double, total_quantity long, nb_transaction long, futur_purchase int, "
        "customer_type string, class_weight double",
    )


def test_split_by_key_alone(profiles):
    train, test = sampling.hash_split(profiles)
    again, _ = sampling.hash_split(profiles.repartition(5))
    ids = lambda df: {r.customer_id for r in df.collect()}
    assert ids(train) | ids(test) == set(range(400)) and not ids(train) & ids(test)
    assert ids(train) == ids(again) and 280 < len(ids(train)) < 360


def test_forest_learns_and_scores_test_customers_only(profiles):
    forest = prediction.fit_repurchase_forest(profiles)
    scores = forest.scores().collect()
    assert {r.customer_id for r in scores} == {r.customer_id for r in sampling.hash_split(profiles)[1].collect()}
    for r in scores:
        assert 0 <= r.predicted_probability <= 1
        assert r.predicted_label == float(r.predicted_probability > 0.5)
        assert r.difference == abs(r.predicted_label - r.futur_purchase)
    quality = forest.quality().head()
    assert quality.customers == len(scores)
    assert quality.accuracy == pytest.approx(1 - sum(r.difference for r in scores) / len(scores))
    assert 0.85 < quality.area_under_roc <= 1
    first = forest.first_scores(7).collect()
    assert [r.customer_id for r in first] == sorted(r.customer_id for r in scores)[:7]


def test_the_same_forest_for_any_layout(profiles):
    one, other = (
        prediction.fit_repurchase_forest(profiles.repartition(n)).scores().orderBy("customer_id").collect()
        for n in (1, 6)
    )
    assert one == other


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(profiles, label):
    one = profiles.withColumn("futur_purchase", F.lit(label))
    quality = prediction.fit_repurchase_forest(one).quality().head()
    assert quality.accuracy == 1.0


def test_min_max(spark):
    df = spark.createDataFrame([(2.0, 5.0), (4.0, 5.0), (10.0, 5.0)], "a double, b double")
    ranges = MinMax.fit(df, {"a": F.col("a"), "b": F.col("b")})
    scaled = df.select("a", *[ranges.scale(n, F.col(n)).alias(f"s{n}") for n in "ab"])
    assert [(r.sa, r.sb) for r in scaled.collect()] == [(0.0, 0.0), (0.25, 0.0), (1.0, 0.0)]
    back = scaled.select(ranges.unscale("a", F.col("sa"))).collect()
    assert [r[0] for r in back] == [2.0, 4.0, 10.0]
    empty = MinMax.fit(df.limit(0), {"a": F.col("a")})
    assert df.select(empty.scale("a", F.col("a"))).head()[0] is None


def test_forecast_follows_a_simple_rule(spark):
    """Each amount is the mean of the two before it, plus a little: a linear rule the forecast must find."""
    rng = random.Random(1)
    rows = []
    for c in range(40):
        a, b = rng.uniform(0, 100), rng.uniform(0, 100)
        for i in range(12):
            rows.append((c, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), f"T{c}-{i:02d}", a))
            a, b = b, (a + b) / 2 + 1
    df = spark.createDataFrame(
        rows, "customer_id long, timestamp timestamp_ntz, transaction_id string, total_amount double"
    )
    sequences = customers.amount_sequences(df)
    assert sequences.count() == 40 * 8
    forecast = prediction.fit_amount_forecast(sequences)
    quality = {r.split: r for r in forecast.quality().collect()}
    assert sum(r.sequences for r in quality.values()) == 40 * 7 and set(quality) == {"train", "test"}
    assert all(r.forecast_error < 0.5 < r.run_mean_error for r in quality.values())
    for r in forecast.next_amounts().collect():
        assert r.predicted_amount == pytest.approx((r.sequence[3] + r.sequence[4]) / 2 + 1, abs=2)
    assert forecast.next_amounts().count() == 40
    checks = forecast.latest_checks(10).collect()
    assert len(checks) == 10 and all(r.actual_amount is not None for r in checks)


def test_no_model_beats_a_constant_on_independent_amounts(spark, sf):
    forecast = prediction.fit_amount_forecast(customers.amount_sequences(ev(spark, sf)))
    assert max(abs(c) for c in forecast.model.coefficients) < 0.2


@pytest.mark.parametrize("parts", [1, 5])
def test_area_equals_the_share_of_pairs(spark, parts):
    rng = random.Random(9)
    rows = [(round(rng.gauss(label, 1), 1), label) for label in [0] * 130 + [1] * 70] + [(None, 1), (0.5, None)]
    frame = spark.createDataFrame(rows, "score double, label int").repartition(parts)
    ones, zeros = ([s for s, l in rows if l == label and s is not None] for label in (1, 0))
    want = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert quality.area_under_roc(frame, "score", "label") == pytest.approx(want, abs=1e-12)
    binned = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(frame.where("label is not null and score is not null"))
    assert want == pytest.approx(binned, abs=1e-3)
    assert quality.area_under_roc(frame.where("label = 1"), "score", "label") is None
    assert quality.area_under_roc(frame.limit(0), "score", "label") is None


def _purchases(spark, rows):
    schema = "customer_id long, timestamp timestamp_ntz, transaction_id string, quantity int, total_amount double, customer_type string"
    return spark.createDataFrame([(c, t, f"T{i}", 1, 10.0, "B2B") for i, (c, t) in enumerate(rows)], schema)


def test_cuts_are_midnights_with_a_horizon_ahead(spark):
    start = dt.datetime(2024, 3, 1, 15, 30)
    rows = _purchases(spark, [(1, start + dt.timedelta(hours=7 * i)) for i in range(60)])
    cuts = customers.rolling_cuts(rows, 3, 24)
    assert cuts == [dt.datetime(2024, 3, 1) + dt.timedelta(days=5 * i) for i in (1, 2, 3)]
    last = start + dt.timedelta(hours=7 * 59)
    assert all(c + dt.timedelta(hours=24) <= last for c in cuts)
    assert customers.rolling_cuts(rows.limit(1), 3, 24) == customers.rolling_cuts(rows.limit(0), 3, 24) == []
    assert customers.rolling_profiles(rows, [], 24).count() == 0


def test_no_feature_sees_its_labels_time_and_no_label_the_features(spark):
    rng = random.Random(2)
    start, cut = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 8)
    rows = [(c, start + dt.timedelta(minutes=rng.randrange(20_000))) for c in range(30) for _ in range(9)]
    rows += [(1, cut), (2, cut + dt.timedelta(hours=24)), (3, cut + dt.timedelta(hours=24, seconds=1))]
    features = ["customer_id", "total_spend", "total_quantity", "nb_transaction", "customer_type"]

    def profiles(kept):
        return {r.customer_id: r for r in customers.rolling_profiles(_purchases(spark, kept), [cut], 24).collect()}

    whole, earlier = profiles(rows), profiles([r for r in rows if r[1] < cut])
    assert [[whole[c][f] for f in features] for c in sorted(whole)] == [[earlier[c][f] for f in features] for c in sorted(earlier)]
    assert {r.futur_purchase for r in earlier.values()} == {0}
    for c, r in whole.items():
        times = [t for i, t in rows if i == c]
        assert r.nb_transaction == sum(t < cut for t in times)
        assert r.futur_purchase == int(any(cut <= t <= cut + dt.timedelta(hours=24) for t in times))


def test_backtest_folds(spark):
    """Customers who bought much buy again: later folds must tell them apart."""
    rng = random.Random(4)
    start, rows = dt.datetime(2024, 3, 1), []
    for c in range(200):
        busy = c % 2
        rows += [(c, start + dt.timedelta(days=rng.uniform(0, 20))) for _ in range(60 if busy else 3)]
    df = _purchases(spark, rows)
    cuts = customers.rolling_cuts(df, 3, 24)
    folds = prediction.backtest(customers.rolling_profiles(df, cuts, 24)).collect()
    assert [r.cut for r in folds] == cuts[1:]
    assert all(r.area_under_roc > 0.9 and r.customers >= 150 and 0 < r.positives < r.customers for r in folds)
    assert prediction.backtest(customers.rolling_profiles(df, cuts[:1], 24)).count() == 0


def test_slopes_of_the_fitted_loss_are_flat_and_others_are_not(spark, sf):
    forecast = prediction.fit_amount_forecast(customers.amount_sequences(ev(spark, sf)))
    assert prediction.huber_slopes(forecast).first().slope < 1e-3

    class Other:
        coefficients, intercept, scale, getEpsilon = [0.1] * 5, 0.3, 0.2, forecast.model.getEpsilon

    other = prediction.AmountForecast(forecast.ranges, Other, forecast.sequences)
    assert prediction.huber_slopes(other).first().slope > 0.05


def test_scaling_back_of_nothing(spark):
    empty = MinMax({"a": (None, None)})
    assert spark.range(1).select(empty.unscale("a", F.lit(1.0))).first()[0] is None

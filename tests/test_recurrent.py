"""The recurrent forecast: its gradient, what it learns, and what reaches the driver."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import customers, prediction, recurrent
from salescope.operators.recurrent import Network
from salescope.plans.registry import ev


@pytest.mark.parametrize("layers", [1, 2, 3])
def test_gradient_against_finite_differences(layers):
    rng = np.random.default_rng(1)
    network = Network(hidden=4, layers=layers)
    weights = network.start() + rng.normal(0, 0.3, len(network.start()))
    # Errors on both sides of the bend of the loss.
    x, y = rng.uniform(-1, 1, (13, 5)), rng.normal(0, 2, 13)
    gradient = network.loss_and_gradient(weights, x, y)[1]
    for i in range(len(weights)):
        step = np.zeros(len(weights))
        step[i] = 1e-5
        ahead, behind = (network.loss_and_gradient(weights + s, x, y)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((ahead - behind) / 2e-5, abs=1e-6, rel=1e-5)


def _purchases(spark, amount, n=120, length=14):
    rng, rows = np.random.default_rng(6), []
    for c in range(n):
        amounts = list(rng.uniform(0, 100, 5))
        while len(amounts) < length:
            amounts.append(amount(amounts, rng))
        rows += [(c, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), f"T{c}-{i:02d}", float(a)) for i, a in enumerate(amounts)]
    return spark.createDataFrame(
        rows, "customer_id long, timestamp timestamp_ntz, transaction_id string, total_amount double"
    )


def test_learns_a_rule_that_no_linear_fit_can(spark):
    """Small and large amounts are followed by small ones, middling ones by large ones: no correlation, and no noise to speak of."""
    def follows(a, rng):
        return a[-1] * (100 - a[-1]) * 0.038 + rng.uniform(0, 4)

    sequences = customers.amount_sequences(_purchases(spark, follows))
    linear = {r.split: r for r in prediction.fit_amount_forecast(sequences).quality().collect()}
    network = {r.split: r for r in prediction.fit_recurrent_forecast(sequences).quality().collect()}
    assert set(network) == {"train", "test"}
    for split in network:
        assert network[split].sequences == linear[split].sequences
        assert network[split].forecast_error < 0.4 * min(linear[split].forecast_error, linear[split].run_mean_error)


def test_sums_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(3)
    rows = [(*map(float, rng.random(6)), bool(rng.random() < 0.2)) for _ in range(300)]
    names = [*prediction.SCALED_RUN, "scaled_next_amount", "aside"]
    frame = spark.createDataFrame(rows, names)
    network = Network(5, 2)
    weights = network.start()
    one, many = (recurrent.evaluate(frame.repartition(n), network, weights, n) for n in (1, 70))
    assert one.loss == pytest.approx(many.loss) and one.aside == pytest.approx(many.aside)
    assert one.gradient == pytest.approx(many.gradient)
    data = np.array([r[:6] for r in rows if not r[6]])
    loss, gradient = network.loss_and_gradient(weights, 2 * data[:, :5] - 1, data[:, 5])
    assert one.loss == pytest.approx(loss / len(data)) and one.gradient == pytest.approx(gradient / len(data))


def test_the_fit_ends_at_a_low_gradient_and_never_worse_than_it_started(spark):
    frame = spark.createDataFrame(
        [(*[(i * k % 17) / 17 for k in range(1, 6)], (i % 17) / 17, i % 9 == 0) for i in range(400)],
        [*prediction.SCALED_RUN, "scaled_next_amount", "aside"]).repartition(2).persist()
    network = Network(4, 1)
    start, end = (recurrent.evaluate(frame, network, w, 2) for w in (network.start(), recurrent.fit(frame, network, 2)))
    assert end.aside < 0.2 * start.aside and end.loss < 0.2 * start.loss


def test_forecast_of_nothing_and_of_nulls(spark, sf):
    sequences = customers.amount_sequences(ev(spark, sf))
    empty = prediction.fit_recurrent_forecast(sequences.limit(0))
    assert empty.next_amounts().count() == 0 and empty.quality().count() == 0
    frame = spark.createDataFrame([(0.1, 0.2), (None, 0.3)], "a double, b double")
    network = Network(3, 1)
    rows = recurrent.with_prediction(frame, ["a", "b"], network, network.start()).collect()
    assert rows[0].prediction is not None and rows[1].prediction is None


def test_rows_are_taken_some_at_a_time(monkeypatch):
    rng, network = np.random.default_rng(2), Network()
    weights, x, y = network.start(), rng.uniform(-1, 1, (23, 5)), rng.normal(0, 2, 23)
    loss, gradient = network.loss_and_gradient(weights, x, y)
    monkeypatch.setattr(recurrent, "ROWS_AT_ONCE", 4)
    parts, original = [], Network.forward
    monkeypatch.setattr(Network, "forward", lambda self, w, x: parts.append(len(x)) or original(self, w, x))
    again = network.loss_and_gradient(weights, x, y)
    assert parts == [4, 4, 4, 4, 4, 3] and again[0] == pytest.approx(loss) and np.allclose(again[1], gradient)


def test_states_stay_numbers_at_any_weight():
    """The exponential of a large number is infinite; the gates and the cells are not."""
    network = Network()
    found = network.forward(1e4 * network.start(), np.full((3, 5), -1.0))[0]
    assert np.isfinite(found).all()


def test_both_forecasts_share_one_layout(spark, sf, monkeypatch):
    from salescope.operators import ordering
    from salescope.plans.registry import QUERIES

    names, original = [], ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df, name: names.append(name) or original(df, name))
    monkeypatch.setattr(recurrent, "MOST_PASSES", 2)
    reads = []
    written = prediction._written
    monkeypatch.setattr(prediction, "_written", lambda df: reads.append(df) or written(df))
    models = {r.model for r in QUERIES["forecast_quality"](spark, sf).collect()}
    assert models == {"linear", "recurrent"}
    assert names == ["chunks"] and reads[0].scratch_path == reads[1].scratch_path

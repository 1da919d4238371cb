"""Who buys again soon, and how much the next purchase comes to."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions import SEQUENCE_LENGTH, hash_bucket, prediction_error, probability_of_one, wall_clock
from salescope.operators.clustering import SEED, canonical_layout
from salescope.operators.customers import sequence_columns
from salescope.operators.encoding import MinMax, with_indexes
from salescope.operators.quality import area_under_roc
from salescope.operators.recurrent import Network, fit, with_prediction
from salescope.operators.sampling import TRAIN_TENTHS, hash_split, last_rows
from salescope.sources.scratch import materialise

#: The scaled amounts of a run, oldest first.
SCALED_RUN = [f"scaled_amount_{i + 1}" for i in range(SEQUENCE_LENGTH)]

#: Runs in a partition of the recurrent fit.
RUNS_PER_PARTITION = 10_000

# The profile columns the classifier learns from.
PROFILE_FEATURES = ("total_spend", "total_quantity", "nb_transaction", "index_customer_type")


@dataclass(frozen=True)
class RepurchaseForest:
    """A fitted repurchase classifier with its scored test customers."""

    model: RandomForestClassificationModel
    scored: DataFrame

    def scores(self) -> DataFrame:
        """Test customers: true label, probability and label predicted, and whether they differ."""
        return self.scored.select(
            "customer_id",
            "futur_purchase",
            probability_of_one("probability").alias("predicted_probability"),
            F.col("prediction").alias("predicted_label"),
            prediction_error("prediction", "futur_purchase").alias("difference"),
        )

    def first_scores(self, rows: int = 100) -> DataFrame:
        return self.scores().orderBy("customer_id").limit(rows)

    def quality(self) -> DataFrame:
        """Exact area under the ROC curve (null if either class is missing) and accuracy on the test customers."""
        area = area_under_roc(self.scores(), "predicted_probability", "futur_purchase") if self.model.numClasses > 1 else None
        right = F.avg((F.col("prediction") == F.col("futur_purchase")).cast("double"))
        return self.scored.agg(
            F.count(F.lit(1)).alias("customers"),
            F.lit(area).cast("double").alias("area_under_roc"),
            right.alias("accuracy"),
        )


def fit_repurchase_forest(profiles: DataFrame) -> RepurchaseForest:
    """Train a random forest on the profiles in the train split and score those in the test split."""
    features = with_indexes(materialise(profiles, "profiles"), {"customer_type": "index_customer_type"})
    vectors = VectorAssembler(inputCols=list(PROFILE_FEATURES), outputCol="features").transform(features)
    train, test = hash_split(vectors)
    model = _forest().fit(canonical_layout(train, train.count(), "customer_id"))
    return RepurchaseForest(model, model.transform(test))


def backtest(profiles: DataFrame) -> DataFrame:
    """A forest per cut of ``rolling_profiles``, fitted on that cut and judged on the next one.

    By the next cut all labels of the one before are known, so that a fold uses nothing from after the time it forecasts
    from. One row per fold: cut, customers and positives at that cut, exact area under the ROC curve, accuracy. Without
    profiles at a cut, or at the one before, there is no fold.
    """
    profiles = materialise(profiles, "rolling-profiles")
    indexed = materialise(with_indexes(profiles, {"customer_type": "index_customer_type"}), "rolling-profiles")
    vectors = VectorAssembler(inputCols=list(PROFILE_FEATURES), outputCol="features").transform(indexed)
    cuts = [r[0] for r in vectors.select("cut").distinct().orderBy("cut").collect()]
    rows = []
    for before, cut in zip(cuts, cuts[1:]):
        known, now = (vectors.where(F.col("cut") == wall_clock(c)) for c in (before, cut))
        model = _forest().fit(canonical_layout(known, known.count(), "customer_id"))
        scored = RepurchaseForest(model, model.transform(now))
        quality = scored.quality().first()
        positives = now.where("futur_purchase = 1").count()
        rows.append((cut, quality["customers"], positives, quality["area_under_roc"], quality["accuracy"]))
    schema = "cut timestamp_ntz, customers bigint, positives bigint, area_under_roc double, accuracy double"
    return profiles.sparkSession.createDataFrame(rows, schema)


def _forest() -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol="futur_purchase", weightCol="class_weight", seed=SEED
    )


def scaled_sequences(sequences: DataFrame, ranges: MinMax) -> DataFrame:
    """Each amount of the run, and the next amount, scaled to [0, 1] by position."""
    scaled = {f"scaled_{n}": ranges.scale(n, c) for n, c in sequence_columns().items()}
    scaled["scaled_next_amount"] = ranges.scale("next_amount", F.col("next_amount"))
    return sequences.withColumns(scaled)


def sequence_ranges(sequences: DataFrame) -> MinMax:
    """The ranges of the runs that have a next amount: those the forecast learns from."""
    known = sequences.where(F.col("next_amount").isNotNull())
    return MinMax.fit(known, {**sequence_columns(), "next_amount": F.col("next_amount")})


@dataclass(frozen=True)
class AmountForecast:
    """A fitted forecast of the next amount from the last five."""

    ranges: MinMax
    model: LinearRegressionModel
    sequences: DataFrame

    def _with_prediction(self, scaled: DataFrame) -> DataFrame:
        return self.model.transform(VectorAssembler(inputCols=SCALED_RUN, outputCol="features").transform(scaled))

    def _predicted(self, rows: DataFrame) -> DataFrame:
        return self._with_prediction(scaled_sequences(rows, self.ranges)).select(
            "customer_id",
            "timestamp",
            "transaction_id",
            "sequence",
            F.col("next_amount").alias("actual_amount"),
            self.ranges.unscale("next_amount", F.col("prediction")).alias("predicted_amount"),
        )

    def next_amounts(self) -> DataFrame:
        """The forecast for every customer with enough purchases."""
        return self._predicted(self.sequences.where(F.col("next_amount").isNull())).drop("actual_amount")

    def known(self) -> DataFrame:
        """Forecast and actual amount of all runs whose next amount is known."""
        return self._predicted(_known(self.sequences))

    def latest_checks(self, rows: int = 10) -> DataFrame:
        """Forecast and actual amount of the latest runs of test customers whose next amount is known."""
        return self._predicted(last_rows(_known(hash_split(self.sequences)[1]), rows))

    def quality(self) -> DataFrame:
        """Mean absolute error of the forecast, and of the mean of the run in its place, over the known next amounts: of
        the customers that the fit never saw, and of those it was fitted on."""
        run = sum(sequence_columns().values()) / SEQUENCE_LENGTH
        parts = zip(("train", "test"), hash_split(self.sequences))
        scored = [self._predicted(_known(rows)).withColumn("split", F.lit(name)) for name, rows in parts]
        return scored[0].unionByName(scored[1]).groupBy("split").agg(
            F.count(F.lit(1)).alias("sequences"),
            F.avg(F.abs(F.col("predicted_amount") - F.col("actual_amount"))).alias("forecast_error"),
            F.avg(F.abs(run - F.col("actual_amount"))).alias("run_mean_error"),
        )


def huber_slopes(forecast: AmountForecast) -> DataFrame:
    """(rows, slope): the greatest slope of the regression's loss, by any coefficient, the intercept or the scale, at those
    that were fitted; a right fit has none. The loss is the mean of s + s H((y - prediction) / s) with the fitted scale s."""
    model = forecast.model
    train = scaled_sequences(_known(hash_split(forecast.sequences)[0]), forecast.ranges)
    error = (F.col("scaled_next_amount") - sum(
        (F.col(c) * float(w) for c, w in zip(SCALED_RUN, model.coefficients)), F.lit(float(model.intercept))
    )) / F.lit(float(model.scale))
    bound = F.lit(float(model.getEpsilon()))
    bent = F.greatest(F.least(error, bound), -bound)
    # The slope by the scale: 1 plus the mean of H(z) - z H'(z), which is -z^2 within the bound and -bound^2 beyond it.
    slopes = [F.abs(F.avg(2 * bent * F.col(c))) for c in SCALED_RUN]
    slopes += [F.abs(F.avg(2 * bent)), F.abs(1 - F.avg(bent * bent))]
    return train.agg(F.count(F.lit(1)).alias("rows"), F.greatest(*slopes).alias("slope"))


@dataclass(frozen=True)
class RecurrentForecast(AmountForecast):
    """The forecast by a recurrent network; ``model`` is its shape and its weights."""

    model: tuple[Network, np.ndarray]

    def _with_prediction(self, scaled: DataFrame) -> DataFrame:
        return with_prediction(scaled, SCALED_RUN, *self.model)


def _known(sequences: DataFrame) -> DataFrame:
    return sequences.where(F.col("next_amount").isNotNull())


def _written(sequences: DataFrame) -> DataFrame:
    """A table of ``materialise`` as it is, anything else written."""
    return sequences if hasattr(sequences, "scratch_path") else materialise(sequences, "sequences")


def fit_amount_forecast(sequences: DataFrame) -> AmountForecast:
    """Fit a linear regression with the Huber loss on the train customers' runs whose next amount is known."""
    sequences = _written(sequences)
    train = hash_split(sequences)[0]
    ranges = sequence_ranges(train)
    known = scaled_sequences(_known(train), ranges)
    vectors = VectorAssembler(inputCols=SCALED_RUN, outputCol="features").transform(known)
    regression = LinearRegression(featuresCol="features", labelCol="scaled_next_amount", loss="huber")
    return AmountForecast(ranges, regression.fit(vectors.select("features", "scaled_next_amount")), sequences)


def fit_recurrent_forecast(sequences: DataFrame, network: Network = Network()) -> RecurrentForecast:
    """Fit a recurrent network with the Huber loss on the train customers' runs whose next amount is known.

    A tenth of the customers, of the train ones, is left aside to tell when to stop. The runs are laid out and written
    once; each pass of the fit reads them.
    """
    sequences = _written(sequences)
    train = hash_split(sequences)[0]
    ranges = sequence_ranges(train)
    aside = (hash_bucket("customer_id") == TRAIN_TENTHS - 1).alias("aside")
    known = scaled_sequences(_known(train), ranges).select(*SCALED_RUN, "scaled_next_amount", aside)
    parts = known.count() // RUNS_PER_PARTITION + 1
    laid = materialise(known.repartition(parts), "runs")
    return RecurrentForecast(ranges, (network, fit(laid, network, parts)), sequences)

"""The named queries: each takes (spark, folder of the given tables) and returns a frame.

``tx`` queries see order lines as transactions, ``ev`` queries see events as transactions. The given tables have neither
nulls nor copies (a test checks it), so these queries start from the adapters; ``clean_enriched`` shows the cleaning on
a table that has both.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import clock_parts, date_parts, file_label, parse_timestamp, strings_of, wall_clock
from salescope.operators import (
    cleaning,
    clustering,
    customers,
    daily,
    encoding,
    exploration,
    prediction,
    quality,
    sampling,
    spending,
)
from salescope.sources import (
    events_as_transactions,
    lineitems_as_transactions,
    lookup_profiles,
    materialise,
    preview,
    read_by_month,
    read_transactions,
    save_indexed_profiles,
    save_profiles,
    schema_of,
    scratch_path,
    top_saved_profiles,
    write_by_month,
    write_csv,
    write_ranked_csv,
)

#: Hours within which a purchase counts as a quick repurchase. With 1 hour every customer of the events is one.
HORIZON = 0.1

#: Folds of the backtest, and hours after a cut within which a purchase counts.
FOLDS, FOLD_HOURS = 4, 12

#: The main category of the month-by-product report.
REPORT_CATEGORY = "ECONOMY"


def tx(spark: SparkSession, folder: str) -> DataFrame:
    return lineitems_as_transactions(spark, folder)


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_transactions(spark, folder)


def _enriched(spark, folder):
    return cleaning.enrich(tx(spark, folder))


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, d) for name, d in digits.items()})


def _quantity_report(*groups: str):
    def report(spark, folder):
        return _rounded(spending.mean_customer_quantity(_enriched(spark, folder), *groups), mean_quantity=6)

    return report


def quantity_reports(spark, folder):
    return _rounded(spending.quantity_reports(_enriched(spark, folder)), mean_quantity=6)


def top_spenders(spark, folder):
    return _rounded(spending.top_spenders(_enriched(spark, folder)), total_spent=2)


def clean_enriched(spark, folder):
    rows = tx(spark, folder).withColumn("quantity", F.nullif("quantity", F.lit(13)))
    return cleaning.enrich(cleaning.clean_in_parts(rows.unionByName(rows), by=("transaction_id",)))


def date_parts_of_events(spark, folder):
    parts = ev(spark, folder).select("transaction_id", *[c.alias(n) for n, c in date_parts("timestamp").items()])
    # As text, which both engines hand over alike.
    return parts.withColumn("date", F.col("date").cast("string"))


def clock_parts_of_events(spark, folder):
    rows = exploration.with_month_and_day_name(ev(spark, folder))
    parts = {n: c for n, c in clock_parts("timestamp").items() if n != "month"}
    return rows.select("transaction_id", "month", "weekday", *[c.alias(n) for n, c in parts.items()])


def clean_names(spark, folder):
    return exploration.with_clean_names(tx(spark, folder)).select("transaction_id", "clean_product", "clean_category")


def b2b_purchases(spark, folder):
    return exploration.segment(tx(spark, folder), "B2B")


def segment_means(spark, folder):
    return _rounded(exploration.segment_means(tx(spark, folder)), mean_quantity=6, mean_amount=6)


def segment_ratio(spark, folder):
    return _rounded(exploration.segment_ratio(tx(spark, folder)), quantity_ratio=6, amount_ratio=6)


def median_amount(spark, folder):
    # The rounds of the median read one written column in place of the joins.
    amounts = materialise(tx(spark, folder).select("total_amount"), "amounts")
    return exploration.median(amounts, "total_amount", "median_amount")


def top_products_by_count(spark, folder):
    return exploration.top_products_by_count(tx(spark, folder))


def top_products_by_quantity(spark, folder):
    return exploration.top_products_by_quantity(tx(spark, folder))


def sales_by_month(spark, folder):
    return _rounded(exploration.sales_by(exploration.with_month_and_day_name(tx(spark, folder)), "month"), total_sales=2)


def sales_by_weekday(spark, folder):
    rows = exploration.with_month_and_day_name(tx(spark, folder))
    return _rounded(exploration.sales_by(rows, "weekday"), total_sales=2)


def sales_by_type(spark, folder):
    return _rounded(exploration.sales_by(tx(spark, folder), "customer_type"), total_sales=2)


def category_month_pivot(spark, folder):
    return exploration.category_month_counts(tx(spark, folder))


def product_month_in_category(spark, folder):
    return exploration.month_product_counts(tx(spark, folder), REPORT_CATEGORY)


def category_histogram(spark, folder):
    return exploration.histogram(exploration.with_clean_names(tx(spark, folder)), "clean_category")


def product_histogram(spark, folder):
    rows = exploration.with_clean_names(tx(spark, folder))
    return exploration.histogram(rows, "customer_type", "clean_product")


def distinct_categories(spark, folder):
    return exploration.distinct_values(_enriched(spark, folder), "main_category")


def distinct_products(spark, folder):
    return exploration.distinct_values(exploration.with_clean_names(tx(spark, folder)), "clean_product")


def earliest_rows(spark, folder):
    return exploration.with_clean_names(exploration.with_month_and_day_name(exploration.earliest_rows(ev(spark, folder))))


def next_purchase(spark, folder):
    rows = customers.with_next_purchase(ev(spark, folder), HORIZON)
    columns = ("customer_id", "transaction_id", "timestamp", "date_next_purchase", "hours_between", "futur_purchase")
    return _rounded(rows.select(*columns), hours_between=6)


def _profiles(spark, folder):
    return customers.customer_profiles(ev(spark, folder), HORIZON)


def customer_profile(spark, folder):
    return _rounded(_profiles(spark, folder), total_spend=2)


def class_balance(spark, folder):
    return customers.class_balance(_profiles(spark, folder))


def top_saved(spark, folder):
    path = scratch_path(spark, "profiles")
    save_profiles(_profiles(spark, folder), path)
    return _rounded(top_saved_profiles(spark, path), total_spend=2)


def _sequences(spark, folder):
    return customers.amount_sequences(ev(spark, folder))


def _with_amounts(rows: DataFrame, *more: str | Column) -> DataFrame:
    amounts = [c.alias(n) for n, c in customers.sequence_columns().items()]
    return rows.select("customer_id", "timestamp", "transaction_id", *amounts, *more)


def amount_sequences(spark, folder):
    return _with_amounts(_sequences(spark, folder), "total_amount", "next_amount")


def latest_sequences(spark, folder):
    return _with_amounts(sampling.last_rows(_sequences(spark, folder), 10), "total_amount")


def systematic_sample(spark, folder):
    return sampling.every_nth(ev(spark, folder), 40)


def hash_split(spark, folder):
    train, test = sampling.hash_split(ev(spark, folder).select("customer_id").distinct())
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def string_index(spark, folder):
    return encoding.label_indexes(tx(spark, folder), "customer_type", "city", "category", "product_name")


def standard_scaled(spark, folder):
    rows = materialise(clustering.with_row_features(tx(spark, folder)), "row-features")
    deviations, _ = encoding.deviations_of(rows, *clustering.ROW_COLUMNS)
    scaled = encoding.scaled_columns(deviations)
    return rows.select("transaction_id", *[F.round(v, 6).alias(f"scaled_{c}") for c, v in scaled.items()])


def min_max_scaled(spark, folder):
    rows = _sequences(spark, folder)
    scaled = prediction.scaled_sequences(rows, prediction.sequence_ranges(rows))
    names = [c for c in scaled.columns if c.startswith("scaled_")]
    return _rounded(scaled.select("transaction_id", *names), **dict.fromkeys(names, 6))


def basket_terms(spark, folder):
    return customers.written_basket_terms(tx(spark, folder))


def basket_vocabulary(spark, folder):
    return encoding.basket_vocabulary(customers.basket_terms(tx(spark, folder)))


def customer_baskets(spark, folder):
    terms = customers.written_basket_terms(tx(spark, folder))
    baskets = encoding.basket_features(terms, encoding.basket_vocabulary(terms))
    return baskets.select("customer_id", F.array_join("features", " ").alias("features"))


def basket_lists(spark, folder):
    lists = encoding.basket_lists(customers.written_basket_terms(tx(spark, folder)))
    joined = {c: F.array_join(c, "|").alias(c) for c in ("categories", "products")}
    return lists.select("customer_id", *joined.values())


def row_clusters(spark, folder):
    return clustering.row_clusters(tx(spark, folder))


def row_cluster_sample(spark, folder):
    return sampling.every_nth(clustering.row_clusters(tx(spark, folder)), 40, "transaction_id")


def silhouette_by_k(spark, folder):
    return clustering.row_silhouettes(tx(spark, folder))


def time_silhouette_by_k(spark, folder):
    return clustering.time_silhouettes(ev(spark, folder))


def customer_silhouette_by_k(spark, folder):
    return clustering.customer_silhouettes(clustering.basket_space(tx(spark, folder)))


def pca_explained_variance(spark, folder):
    return clustering.explained_variance(clustering.basket_space(tx(spark, folder)))


def time_clusters(spark, folder):
    return clustering.time_clusters(ev(spark, folder))


def customer_clusters(spark, folder):
    return clustering.customer_clusters(clustering.basket_space(tx(spark, folder)))


def pca_loadings(spark, folder):
    return clustering.named_loadings(clustering.basket_space(tx(spark, folder)))


def pca_extreme_features(spark, folder):
    return clustering.extreme_features(clustering.basket_space(tx(spark, folder)))


def repurchase_test_customers(spark, folder):
    return sampling.hash_split(_profiles(spark, folder))[1].select("customer_id", "futur_purchase", "class_weight")


def repurchase_scores(spark, folder):
    return prediction.fit_repurchase_forest(_profiles(spark, folder)).scores()


def first_repurchase_scores(spark, folder):
    return prediction.fit_repurchase_forest(_profiles(spark, folder)).first_scores()


def repurchase_quality(spark, folder):
    return prediction.fit_repurchase_forest(_profiles(spark, folder)).quality()


def forecast_inputs(spark, folder):
    return _with_amounts(_sequences(spark, folder).where(F.col("next_amount").isNull()))


def next_amount_forecast(spark, folder):
    forecast = prediction.fit_amount_forecast(_sequences(spark, folder))
    return _with_amounts(forecast.next_amounts(), "predicted_amount")


def latest_forecasts(spark, folder):
    forecast = prediction.fit_amount_forecast(_sequences(spark, folder))
    return _with_amounts(forecast.latest_checks(), "actual_amount", "predicted_amount")


def forecast_quality(spark, folder):
    sequences = materialise(_sequences(spark, folder), "sequences")
    linear = prediction.fit_amount_forecast(sequences).quality().withColumn("model", F.lit("linear"))
    recurrent = prediction.fit_recurrent_forecast(sequences).quality().withColumn("model", F.lit("recurrent"))
    return linear.unionByName(recurrent)


def recurrent_forecast(spark, folder):
    forecast = prediction.fit_recurrent_forecast(_sequences(spark, folder))
    return _with_amounts(forecast.next_amounts(), "predicted_amount")


def _rolling(spark, folder):
    rows = ev(spark, folder)
    return customers.rolling_profiles(rows, customers.rolling_cuts(rows, FOLDS, FOLD_HOURS), FOLD_HOURS)


def backtest_inputs(spark, folder):
    return _rounded(_rolling(spark, folder), total_spend=2)


def backtest(spark, folder):
    return prediction.backtest(_rolling(spark, folder))


def backtest_checks(spark, folder):
    folds = backtest(spark, folder)
    known = F.col("accuracy").between(0, 1) & (F.col("area_under_roc").isNull() | F.col("area_under_roc").between(0, 1))
    return folds.select("cut", "customers", "positives", known.alias("known"))


def month_product_wide(spark, folder):
    """Months by the three most frequent products of the report's category."""
    rows = tx(spark, folder)
    counts = exploration.month_product_counts(rows, REPORT_CATEGORY).groupBy("clean_product").agg(F.sum("n").alias("n"))
    chosen = [r["clean_product"] for r in counts.orderBy(F.desc("n"), "clean_product").limit(3).collect()]
    table = exploration.month_product_table(rows, REPORT_CATEGORY, chosen)
    return table.withColumnsRenamed(dict(zip(chosen, ("first", "second", "third"))))


def schema_listing(spark, folder):
    """The columns of the transactions with their types, in order."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(schema_of(tx(spark, folder)))]
    return spark.createDataFrame(rows, "position int, name string, type string")


def preview_checks(spark, folder):
    """How many rows a preview has, and how many of them the table has."""
    rows = preview(ev(spark, folder), 5)
    every = ev(spark, folder).select("transaction_id", F.lit(True).alias("known"))
    return rows.join(every, "transaction_id", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count("known").alias("known")
    )


def text_arrays(spark, folder):
    """Customer and quantity as an array, its elements cast to text."""
    elements = strings_of(F.array("customer_id", F.col("quantity").cast("bigint")))
    return ev(spark, folder).select("transaction_id", F.array_join(elements, "|").alias("elements"))


def _loaded(spark, folder, load, columns=daily.SUM_COLUMNS) -> str:
    """A state that three loads filled: the second repeats months of the first, the third brings the second's last year again."""
    rows = materialise(_enriched(spark, folder).select(*columns), "enriched")
    path = scratch_path(spark, "state")
    for first, before in ((None, 1998), (1997, 2000), (1999, None)):
        part = rows
        if first:
            part = part.where(F.col("timestamp") >= wall_clock(dt.datetime(first, 1, 1)))
        if before:
            part = part.where(F.col("timestamp") < wall_clock(dt.datetime(before, 1, 1)))
        load(part, path)
    return path


def incremental_spenders(spark, folder):
    state = daily.read_state(spark, _loaded(spark, folder, daily.load_sums))
    return _rounded(spending.top_spenders(state), total_spent=2)


def incremental_quantities(spark, folder):
    state = daily.read_state(spark, _loaded(spark, folder, daily.load_sums))
    return _rounded(spending.quantity_reports(state), mean_quantity=6)


#: The days of the reports over a range.
RANGE = (dt.date(1996, 3, 5), dt.date(1998, 7, 20))


def spenders_in_range(spark, folder):
    state = daily.read_state(spark, _loaded(spark, folder, daily.load_sums))
    return _rounded(spending.top_spenders(daily.between(state, *RANGE)), total_spent=2)


def _sketched(spark, folder):
    state = daily.read_state(spark, _loaded(spark, folder, daily.load_sketches, daily.SKETCH_COLUMNS))
    return daily.sketched_quantile(daily.between(state, *RANGE), 0.5, "median_amount", "customer_type")


def sketched_medians(spark, folder):
    return _sketched(spark, folder)


def sketched_median_checks(spark, folder):
    """Per customer type the purchases of the range, and whether the sketched median's exact rank is within twice its bound."""
    medians = materialise(_sketched(spark, folder), "medians")
    rows = tx(spark, folder).where(F.to_date("timestamp").between(*[F.lit(d) for d in RANGE]))
    within = daily.rank_is_within(F.col("median_amount"), F.col("total_amount"), 0.5, 2 * daily.RANK_ERROR)
    joined = rows.join(F.broadcast(medians), "customer_type").groupBy("customer_type", "purchases")
    return joined.agg(F.count(F.lit(1)).alias("rows"), within.alias("within")).select(
        "customer_type", "purchases", "rows", "within"
    )


def clean_in_range(spark, folder):
    path = scratch_path(spark, "by-month")
    write_by_month(_enriched(spark, folder), path)
    return read_by_month(spark, path, dt.datetime(1996, 3, 5), dt.datetime(1996, 7, 1))


def profile_lookup(spark, folder):
    path = scratch_path(spark, "profiles")
    save_indexed_profiles(_profiles(spark, folder), path)
    return _rounded(lookup_profiles(spark, path, [3, 14, 15, 92, 141, 10**12]), total_spend=2)


def csv_round_trip(spark, folder):
    path = scratch_path(spark, "csv")
    write_csv(tx(spark, folder), path)
    return read_transactions(spark, path)


def ranked_spenders(spark, folder):
    path = scratch_path(spark, "ranked")
    order = [F.desc("total_spent"), F.col("customer_id")]
    write_ranked_csv(_rounded(spending.top_spenders(_enriched(spark, folder)), total_spent=2), path, order, 20)
    schema = "rank int, customer_id bigint, customer_name string, customer_type string, total_spent double"
    return spark.read.option("header", True).schema(schema).csv(path)


def parsed_timestamps(spark, folder):
    # Every time as text; where the quantity is a multiple of seven, text that is no time.
    text = F.when(F.col("quantity") % 7 != 0, F.col("timestamp").cast("string")).otherwise("none")
    return ev(spark, folder).select("transaction_id", parse_timestamp(text).alias("parsed"))


def file_labels(spark, folder):
    return tx(spark, folder).select("category").distinct().select("category", file_label("category").alias("label"))


def thinned_time_clusters(spark, folder):
    return sampling.every_nth(clustering.time_clusters(ev(spark, folder)), 40, "transaction_id")


def row_cluster_checks(spark, folder):
    return clustering.row_placement(tx(spark, folder))


def time_cluster_checks(spark, folder):
    return clustering.time_placement(ev(spark, folder))


def customer_cluster_checks(spark, folder):
    return clustering.customer_placement(clustering.basket_space(tx(spark, folder)))


def pca_checks(spark, folder):
    return clustering.component_checks(clustering.basket_space(tx(spark, folder)))


def time_silhouette_checks(spark, folder):
    return time_silhouette_by_k(spark, folder).select("k", F.col("silhouette").between(-1, 1).alias("in_range"))


def silhouette_checks(spark, folder):
    rows = clustering.silhouette_agreement(clustering.row_points(tx(spark, folder)), clustering.ROW_COLUMNS, (3, 5, 12))
    times = clustering.silhouette_agreement(clustering.time_points(ev(spark, folder)), clustering.TIME_COLUMNS, (2, 8, 19))
    return rows.withColumn("form", F.lit("row")).unionByName(times.withColumn("form", F.lit("time")))


def repurchase_checks(spark, folder):
    predicted = (F.col("predicted_probability") > 0.5).cast("double")
    consistent = (
        F.col("predicted_probability").between(0, 1)
        & ((F.col("predicted_label") == predicted) | (F.col("predicted_probability") == 0.5))
        & (F.col("difference") == F.abs(F.col("predicted_label") - F.col("futur_purchase")))
    )
    return repurchase_scores(spark, folder).select("customer_id", "futur_purchase", consistent.alias("consistent"))


def _finite(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.isnan(column) & (F.abs(F.col(column)) < float("inf"))


def forecast_checks(spark, folder):
    # The linear one alone, of which the slopes of the loss are checked as well.
    forecast = prediction.fit_amount_forecast(_sequences(spark, folder))
    quality = forecast.quality().withColumn("finite", _finite("forecast_error"))
    return _rounded(quality.drop("forecast_error"), run_mean_error=6)


def forecast_fit_checks(spark, folder):
    slopes = prediction.huber_slopes(prediction.fit_amount_forecast(_sequences(spark, folder)))
    return slopes.select("rows", (F.col("slope") < 1e-3).alias("flat"))


def next_amount_checks(spark, folder):
    rows = next_amount_forecast(spark, folder)
    return rows.select("customer_id", "transaction_id", _finite("predicted_amount").alias("finite"))


def recurrent_checks(spark, folder):
    """Of the runs whose next amount is known: how many there are, and that the network is no worse than a constant."""
    forecast = prediction.fit_recurrent_forecast(_sequences(spark, folder))
    error = F.abs(F.col("predicted_amount") - F.col("actual_amount"))
    train = sampling.hash_split(forecast.known())[0]
    middle = train.agg(F.avg("actual_amount")).first()[0]
    constant = F.avg(F.abs(F.lit(middle) - F.col("actual_amount")))
    return train.agg(F.count(F.lit(1)).alias("rows"), (F.avg(error) < 1.02 * constant).alias("as_good_as_a_constant"))


def unscaled_amounts(spark, folder):
    """Next amounts scaled and scaled back."""
    rows = _sequences(spark, folder).where(F.col("next_amount").isNotNull())
    ranges = prediction.sequence_ranges(rows)
    scaled = prediction.scaled_sequences(rows, ranges)
    back = ranges.unscale("next_amount", F.col("scaled_next_amount")).alias("next_amount")
    return _rounded(scaled.select("transaction_id", back), next_amount=6)


def loading_checks(spark, folder):
    """Each term by its name, and whether its loadings are numbers within [-1, 1]."""
    rows = clustering.named_loadings(clustering.basket_space(tx(spark, folder)))
    within = [F.coalesce(F.col(c).between(-1, 1), F.lit(False)) for c in clustering.COMPONENTS]
    return rows.select("feature_id", "feature", (within[0] & within[1] & within[2]).alias("within"))


def extreme_checks(spark, folder):
    return clustering.extremes_beyond(clustering.basket_space(tx(spark, folder)))


def first_score_checks(spark, folder):
    return first_repurchase_scores(spark, folder).select("customer_id", "futur_purchase")


def area_checks(spark, folder):
    """The area under the ROC curve of a score that SQL knows: the spend of the test customers."""
    test = sampling.hash_split(_profiles(spark, folder))[1]
    rows = materialise(test.select(F.round("total_spend", 0).alias("score"), "futur_purchase"), "scores")
    area = quality.area_under_roc(rows, "score", "futur_purchase")
    return rows.agg(F.count(F.lit(1)).alias("customers"), F.round(F.lit(area).cast("double"), 9).alias("area"))


QUERIES = {
    "top_spenders": top_spenders,
    **{name: _quantity_report(*groups) for name, groups in spending.QUANTITY_REPORTS.items()},
    "quantity_reports": quantity_reports,
    "clean_enriched": clean_enriched,
    "date_parts": date_parts_of_events,
    "clock_parts": clock_parts_of_events,
    "clean_names": clean_names,
    "b2b_purchases": b2b_purchases,
    "segment_means": segment_means,
    "segment_ratio": segment_ratio,
    "median_amount": median_amount,
    "top_products_by_count": top_products_by_count,
    "top_products_by_quantity": top_products_by_quantity,
    "sales_by_month": sales_by_month,
    "sales_by_weekday": sales_by_weekday,
    "sales_by_type": sales_by_type,
    "category_month_pivot": category_month_pivot,
    "product_month_in_category": product_month_in_category,
    "category_histogram": category_histogram,
    "product_histogram": product_histogram,
    "distinct_categories": distinct_categories,
    "distinct_products": distinct_products,
    "earliest_rows": earliest_rows,
    "next_purchase": next_purchase,
    "customer_profile": customer_profile,
    "class_balance": class_balance,
    "top_saved_profiles": top_saved,
    "amount_sequences": amount_sequences,
    "latest_sequences": latest_sequences,
    "systematic_sample": systematic_sample,
    "hash_split": hash_split,
    "string_index": string_index,
    "standard_scaled": standard_scaled,
    "min_max_scaled": min_max_scaled,
    "basket_terms": basket_terms,
    "basket_vocabulary": basket_vocabulary,
    "customer_baskets": customer_baskets,
    "basket_lists": basket_lists,
    "row_clusters": row_clusters,
    "row_cluster_sample": row_cluster_sample,
    "silhouette_by_k": silhouette_by_k,
    "time_silhouette_by_k": time_silhouette_by_k,
    "customer_silhouette_by_k": customer_silhouette_by_k,
    "time_clusters": time_clusters,
    "customer_clusters": customer_clusters,
    "pca_loadings": pca_loadings,
    "pca_explained_variance": pca_explained_variance,
    "pca_extreme_features": pca_extreme_features,
    "repurchase_test_customers": repurchase_test_customers,
    "repurchase_scores": repurchase_scores,
    "first_repurchase_scores": first_repurchase_scores,
    "repurchase_quality": repurchase_quality,
    "forecast_inputs": forecast_inputs,
    "next_amount_forecast": next_amount_forecast,
    "latest_forecasts": latest_forecasts,
    "forecast_quality": forecast_quality,
    "recurrent_forecast": recurrent_forecast,
    "backtest_inputs": backtest_inputs,
    "backtest": backtest,
    "unscaled_amounts": unscaled_amounts,
    "month_product_wide": month_product_wide,
    "schema_listing": schema_listing,
    "preview_checks": preview_checks,
    "text_arrays": text_arrays,
    "incremental_spenders": incremental_spenders,
    "incremental_quantities": incremental_quantities,
    "spenders_in_range": spenders_in_range,
    "sketched_medians": sketched_medians,
    "sketched_median_checks": sketched_median_checks,
    "clean_in_range": clean_in_range,
    "profile_lookup": profile_lookup,
    "csv_round_trip": csv_round_trip,
    "ranked_spenders": ranked_spenders,
    "parsed_timestamps": parsed_timestamps,
    "file_labels": file_labels,
    "thinned_time_clusters": thinned_time_clusters,
    "row_cluster_checks": row_cluster_checks,
    "time_cluster_checks": time_cluster_checks,
    "customer_cluster_checks": customer_cluster_checks,
    "pca_checks": pca_checks,
    "time_silhouette_checks": time_silhouette_checks,
    "silhouette_checks": silhouette_checks,
    "repurchase_checks": repurchase_checks,
    "forecast_checks": forecast_checks,
    "next_amount_checks": next_amount_checks,
    "forecast_fit_checks": forecast_fit_checks,
    "recurrent_checks": recurrent_checks,
    "backtest_checks": backtest_checks,
    "loading_checks": loading_checks,
    "extreme_checks": extreme_checks,
    "first_score_checks": first_score_checks,
    "area_checks": area_checks,
}

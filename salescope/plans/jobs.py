"""Whole runs over a transaction CSV: prepare the table once, then write every report below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.operators import cleaning, clustering, customers, exploration, prediction, sampling, spending
from salescope.schema import CORRUPT_COLUMN
from salescope.sources import (
    read_by_month,
    read_parquet,
    read_transactions,
    rejected_rows,
    save_indexed_profiles,
    top_saved_profiles,
    write_by_category,
    write_by_month,
    write_csv,
    write_parquet,
    write_ranked_csv,
)


#: Folds of the repurchase backtest.
FOLDS = 4

# The main category of the month-by-product report, if none is given.
REPORT_CATEGORY = "Books"


def prepare(spark: SparkSession, source: str, output: str) -> DataFrame:
    """Copy the raw rows, set rejected rows aside, and write the clean, enriched table that all reports read.

    Removing copies compares all columns. As a written Parquet table, with a folder per year and month, the result is
    computed once, and each report scans only the columns it uses, and of a range of time only its months.
    """
    rows = read_transactions(spark, source, keep_rejected=True)
    write_csv(rejected_rows(rows), f"{output}/rejected")
    rows = rows.drop(CORRUPT_COLUMN)
    write_csv(rows, f"{output}/raw")
    write_by_month(cleaning.enrich(cleaning.clean(rows)), f"{output}/transactions")
    return read_by_month(spark, f"{output}/transactions")


def spending_reports(df: DataFrame, output: str) -> None:
    top = spending.top_spenders(df)
    order = [F.desc("total_spent"), F.asc("customer_id"), F.asc("customer_name"), F.asc("customer_type")]
    write_ranked_csv(top, f"{output}/top_spenders", order, rows=20)
    # One scan for the six reports; then each is a filter on the small result.
    path = f"{output}/mean_quantities"
    write_parquet(spending.quantity_reports(df), path, partition_by=("report",))
    reports = read_parquet(df.sparkSession, path)
    for name, groups in spending.QUANTITY_REPORTS.items():
        report = reports.where(F.col("report") == name).select(*groups, "mean_quantity")
        if "sub_category" in groups:
            write_by_category(report, f"{output}/{name}")
        else:
            write_csv(report, f"{output}/{name}")


def exploration_reports(df: DataFrame, output: str, category: str = REPORT_CATEGORY) -> None:
    df = exploration.with_month_and_day_name(df)
    reports = {
        "median_amount": exploration.median(df, "total_amount", "median_amount"),
        "segment_means": exploration.segment_means(df),
        "segment_ratio": exploration.segment_ratio(df),
        "top_products_by_count": exploration.top_products_by_count(df),
        "top_products_by_quantity": exploration.top_products_by_quantity(df),
        "sales_by_month": exploration.sales_by(df, "month"),
        "sales_by_weekday": exploration.sales_by(df, "weekday"),
        "sales_by_type": exploration.sales_by(df, "customer_type"),
        "earliest_rows": exploration.with_clean_names(exploration.earliest_rows(df)),
        "category_month_counts": exploration.category_month_counts(df),
        "month_product_counts": exploration.month_product_counts(df, category),
        "category_histogram": exploration.histogram(exploration.with_clean_names(df), "clean_category"),
        "product_histogram": exploration.histogram(
            exploration.with_clean_names(df), "customer_type", "clean_product"
        ),
    }
    for name, report in reports.items():
        write_csv(report, f"{output}/{name}")


def clustering_reports(df: DataFrame, output: str) -> None:
    write_parquet(clustering.row_clusters(df), f"{output}/row_clusters")
    rows = read_parquet(df.sparkSession, f"{output}/row_clusters")
    write_parquet(sampling.every_nth(rows, 40, "transaction_id"), f"{output}/row_cluster_sample")
    write_parquet(clustering.time_clusters(df), f"{output}/time_clusters")
    times = read_parquet(df.sparkSession, f"{output}/time_clusters")
    write_parquet(sampling.every_nth(times, 40, "transaction_id"), f"{output}/time_cluster_sample")
    space = clustering.basket_space(df)
    write_parquet(clustering.customer_clusters(space), f"{output}/customer_clusters")
    write_parquet(clustering.named_loadings(space), f"{output}/loadings")
    write_csv(clustering.extreme_features(space), f"{output}/extreme_features")
    write_csv(clustering.explained_variance(space), f"{output}/explained_variance")
    write_csv(clustering.row_silhouettes(df), f"{output}/row_silhouettes")
    write_csv(clustering.time_silhouettes(df), f"{output}/time_silhouettes")
    write_csv(clustering.customer_silhouettes(space), f"{output}/customer_silhouettes")


def prediction_reports(df: DataFrame, output: str, horizon_hours: float = 1.0) -> None:
    spark = df.sparkSession
    save_indexed_profiles(customers.customer_profiles(df, horizon_hours), f"{output}/profiles")
    profiles = read_parquet(spark, f"{output}/profiles")
    write_csv(top_saved_profiles(spark, f"{output}/profiles"), f"{output}/top_profiles")
    write_csv(customers.class_balance(profiles), f"{output}/class_balance")
    forest = prediction.fit_repurchase_forest(profiles)
    write_parquet(forest.scores(), f"{output}/repurchase_scores")
    write_csv(forest.first_scores(), f"{output}/repurchase_first_scores")
    write_csv(forest.quality(), f"{output}/repurchase_quality")
    forecast = prediction.fit_amount_forecast(customers.amount_sequences(df))
    write_parquet(forecast.next_amounts(), f"{output}/next_amounts")
    write_parquet(forecast.latest_checks(), f"{output}/latest_forecasts")
    write_csv(forecast.quality(), f"{output}/forecast_quality")
    recurrent = prediction.fit_recurrent_forecast(customers.amount_sequences(df))
    write_parquet(recurrent.next_amounts(), f"{output}/recurrent_next_amounts")
    write_csv(recurrent.quality(), f"{output}/recurrent_forecast_quality")
    cuts = customers.rolling_cuts(df, FOLDS, horizon_hours)
    write_csv(prediction.backtest(customers.rolling_profiles(df, cuts, horizon_hours)), f"{output}/repurchase_backtest")


def run(spark: SparkSession, source: str, output: str, horizon_hours: float = 1.0, category: str = REPORT_CATEGORY) -> None:
    """Prepare the table and write all reports."""
    df = prepare(spark, source, f"{output}/prepared")
    spending_reports(df, f"{output}/spending")
    exploration_reports(df, f"{output}/exploration", category)
    clustering_reports(df, f"{output}/clustering")
    prediction_reports(df, f"{output}/prediction", horizon_hours)

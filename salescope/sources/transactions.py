"""Reading transactions and writing results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salescope.functions import file_label, wall_clock
from salescope.schema import CORRUPT_COLUMN, TRANSACTION_SCHEMA
from salescope.sources.scratch import materialise

# How CSV results are written.
CSV_OPTIONS = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


def read_transactions(spark: SparkSession, path: str, keep_rejected: bool = False) -> DataFrame:
    """Scan a transaction CSV with a header under the fixed schema: one pass, no inference.

    With ``keep_rejected`` the text of every row that does not fit the schema is kept in ``_corrupt_record``, for
    ``rejected_rows``. Without it such rows have nulls in the cells that do not parse, and ``clean`` drops them.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if not keep_rejected:
        return reader.schema(TRANSACTION_SCHEMA).csv(path)
    with_text = StructType([*TRANSACTION_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType())])
    return reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(with_text).csv(path)


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows of ``read_transactions(..., keep_rejected=True)`` that did not fit the schema.

    Keep all columns when writing them: the reader checks a row only in the columns a query asks for.
    """
    return df.where(F.col(CORRUPT_COLUMN).isNotNull())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` by a folder of CSV part files, each with a header. Times keep their microseconds."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_by_month(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Replace ``path`` by a table with a folder per year and month of ``time``; an own ``month`` column is that of ``time``.

    Rows of a month are brought together first, large months in several files of a bounded size: the number of files
    follows from months and bytes, not from months times tasks.
    """
    dated = df.withColumns({"year": F.year(time), "month": F.month(time)})
    laid = dated.hint("rebalance", "year", "month")
    laid.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_by_month(
    spark: SparkSession, path: str, first: dt.datetime | None = None, before: dt.datetime | None = None, time: str = "timestamp"
) -> DataFrame:
    """The table of ``write_by_month``, from ``first`` until before ``before``; folders of other months are not read."""
    table = spark.read.parquet(path)
    at = F.col("year") * 12 + F.col("month")
    if first is not None:
        table = table.where((at >= first.year * 12 + first.month) & (F.col(time) >= wall_clock(first)))
    if before is not None:
        table = table.where((at <= before.year * 12 + before.month) & (F.col(time) < wall_clock(before)))
    return table.drop("year")


def write_ranked_csv(df: DataFrame, path: str, order: list[Column], rows: int) -> None:
    """Write a top-``rows`` report with its rank from 0 in the first column.

    Only the ``rows`` kept rows reach the ranking window, so it is small by construction.
    """
    top = df.orderBy(*order).limit(rows)
    rank = F.row_number().over(Window.orderBy(*order)) - 1
    write_csv(top.select(rank.alias("rank"), *df.columns).orderBy("rank").coalesce(1), path)


def write_by_category(df: DataFrame, path: str, category: str = "main_category") -> None:
    """Write one folder per category, named after it with ``_`` for spaces."""
    labelled = df.withColumn("category_label", file_label(category))
    labelled.write.mode("overwrite").partitionBy("category_label").options(**CSV_OPTIONS).csv(path)


def save_profiles(profiles: DataFrame, path: str) -> None:
    write_parquet(profiles, path)


def save_indexed_profiles(profiles: DataFrame, path: str, group_bytes: int | None = None) -> None:
    """Profiles for lookups by customer: files split and sorted by customer, with a Bloom filter in each row group.

    A lookup then reads the row groups whose range and filter have the customer: one of each file's at most, and nearly
    always one of all.
    """
    laid = materialise(profiles, "profiles").repartitionByRange("customer_id").sortWithinPartitions("customer_id")
    writer = laid.write.mode("overwrite").option("parquet.bloom.filter.enabled#customer_id", "true")
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)


def lookup_profiles(spark: SparkSession, path: str, customer_ids: list[int]) -> DataFrame:
    """The saved profiles of a few customers."""
    wanted = [F.col("customer_id") == int(i) for i in dict.fromkeys(customer_ids)]
    if not wanted:
        return read_parquet(spark, path).limit(0)
    condition = wanted[0]
    for other in wanted[1:]:
        condition = condition | other
    return read_parquet(spark, path).where(condition)


def top_saved_profiles(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """The saved customer profiles with the largest spend."""
    return read_parquet(spark, path).orderBy(F.desc("total_spend"), "customer_id").limit(rows)

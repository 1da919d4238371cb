"""Cleaning and the derived columns every aggregate uses."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from salescope.functions import category_part
from salescope.sources.scratch import file_bytes, materialise

#: Bytes of input files for which ``clean_in_parts`` takes one more part, and its most parts, as each reads the input anew.
PART_BYTES, MOST_PARTS = 64 << 20, 8


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null (or NaN). The same rows as ``na.drop``, but in a form that scans can use to skip data."""
    complete = [F.col(f.name).isNotNull() for f in df.schema]
    complete += [~F.isnan(f.name) for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))]
    return df.where(reduce(and_, complete))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row per set of exact copies. Copies are merged within each task before the shuffle, so a group of copies
    that holds much of the table does not land on one task."""
    return df.distinct()


def clean(df: DataFrame) -> DataFrame:
    """Complete rows, each once. The null check comes first, so it reaches the scan."""
    return drop_duplicates(drop_incomplete(df))


def clean_in_parts(df: DataFrame, by: tuple[str, ...] = (), parts: int | None = None) -> DataFrame:
    """The rows of ``clean``; of a large input they are worked out and written for one part at a time.

    Copies are found by a shuffle of whole rows, which takes many times the disk that the input does. Rows are dealt by a hash
    of the columns ``by`` (all of them, unless given), so that copies share a part, and what was shuffled for a part is
    deleted before the next one. With columns that lie in one input table the choice of a part reaches the scan, so that
    joins below shuffle that part only. The number of parts follows from the bytes of the files below ``df``.
    """
    if parts is None:
        parts = min(MOST_PARTS, 1 + file_bytes(df) // PART_BYTES)
    if parts == 1:
        return clean(df)
    part = F.pmod(F.xxhash64(*(by or df.columns)), F.lit(parts))
    return reduce(DataFrame.unionAll, [materialise(clean(df.where(part == i)), "clean") for i in range(parts)])


def split_category(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"main_category": category_part("category", 0), "sub_category": category_part("category", 1)}
    )


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"month": F.month("timestamp"), "weekday": F.dayofweek("timestamp")})


def enrich(df: DataFrame) -> DataFrame:
    """Transactions with main and sub category, month (1..12) and weekday (1 = Sunday)."""
    return add_calendar(split_category(df))

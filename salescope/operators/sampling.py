"""Sampling and splitting that give the same rows for any layout of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions import hash_bucket
from salescope.operators.ordering import with_position
from salescope.schema import PURCHASE_ORDER


#: Tenths of the hash buckets that train.
TRAIN_TENTHS = 8


def every_nth(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """Rows 0, n, 2n, ... of the order (by default, of the purchases in time)."""
    positioned = with_position(df, *(order or PURCHASE_ORDER), name="_position")
    return positioned.where(F.col("_position") % n == 0).drop("_position")


def last_rows(df: DataFrame, rows: int) -> DataFrame:
    """The latest rows in time."""
    return df.orderBy(*[F.desc(c) for c in PURCHASE_ORDER]).limit(rows)


def hash_split(df: DataFrame, key: str = "customer_id", train_tenths: int = TRAIN_TENTHS) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, decided by the hash of the key alone."""
    in_train = hash_bucket(key) < train_tenths
    return df.where(in_train), df.where(~in_train)

"""Column expressions. Everything here is built from JVM-side functions; there is no Python UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators, patterns and lengths of the transaction data.
CATEGORY_SEPARATOR = " > "
PRODUCT_SUFFIX = r" Product_\d+$"
CATEGORY_TAIL = r" > .*"
SEQUENCE_LENGTH = 5


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_part(category: str | Column, position: int) -> Column:
    """Part ``position`` of ``main > sub``; null where the category has no such part."""
    return F.get(F.split(_col(category), CATEGORY_SEPARATOR), F.lit(position))


def clean_product(product: str | Column) -> Column:
    return F.regexp_replace(_col(product), PRODUCT_SUFFIX, "")


def clean_category(category: str | Column) -> Column:
    return F.regexp_replace(_col(category), CATEGORY_TAIL, "")


def day_name(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "EEEE")


def parse_timestamp(text: str | Column) -> Column:
    """Text to a wall-clock timestamp; null where the text is none."""
    return _col(text).try_cast("timestamp_ntz")


def date_parts(ts: str | Column) -> dict[str, Column]:
    ts = _col(ts)
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_week": F.dayofweek(ts),
        "hour_of_day": F.hour(ts),
    }


def clock_parts(ts: str | Column) -> dict[str, Column]:
    ts = _col(ts)
    return {"hour": F.hour(ts), "day_of_week": F.dayofweek(ts), "month": F.month(ts)}


def seconds_of(ts: str | Column) -> Column:
    """Whole wall-clock seconds since 1970, whatever the session time zone."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def wall_clock(time: dt.datetime) -> Column:
    """A wall-clock time as a value, whatever the session's time zone."""
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def hours_between(earlier: str | Column, later: str | Column) -> Column:
    """Hours between two times, both cut to whole seconds first."""
    return (seconds_of(later) - seconds_of(earlier)) / 3600


def repurchase_flag(hours: str | Column, horizon: float = 1.0) -> Column:
    """1 where the next purchase follows within ``horizon`` hours, else 0; 0 also for a last purchase."""
    return F.when(_col(hours) <= horizon, 1).otherwise(0)


def class_weight(label: str | Column) -> Column:
    """The rarer class 0 weighs twice as much."""
    return F.when(_col(label) == 1, 1.0).otherwise(2.0)


def strings_of(array: str | Column) -> Column:
    return F.transform(_col(array), lambda x: x.cast("string"))


def vector_element(vector: str | Column, position: int) -> Column:
    """Element of a vector; null past its end."""
    return F.get(vector_to_array(_col(vector)), F.lit(position))


def probability_of_one(probability: str | Column) -> Column:
    """Probability of class 1; 0 from a model that has only seen class 0."""
    return F.coalesce(vector_element(probability, 1), F.lit(0.0))


def prediction_error(predicted: str | Column, true: str | Column) -> Column:
    return F.abs(_col(predicted) - _col(true))


def file_label(name: str | Column) -> Column:
    """A category name fit for a folder name."""
    return F.replace(_col(name), F.lit(" "), F.lit("_"))


def hash_bucket(key: str | Column, buckets: int = 10) -> Column:
    """Bucket of a key by its md5: the same for any layout, run or engine."""
    digest = F.md5(_col(key).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets

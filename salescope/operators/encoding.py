"""Turning labels into numbers, scaling, and basket vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.ordering import with_rank
from salescope.sources.scratch import materialise, small_tasks

#: A lookup table is broadcast up to this size; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def label_indexes(df: DataFrame, *columns: str) -> DataFrame:
    """A table (column, label, index): each column's labels by descending frequency, ties by the label, from 0.

    The same numbering as Spark's StringIndexer, but all columns share one scan and the labels stay a distributed table.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns])
    )
    labels = df.select(pairs.alias("p")).select("p.column", "p.label").where(F.col("label").isNotNull())
    counts = labels.groupBy("column", "label").count()
    numbered = with_rank(counts, "column", F.desc("count"), F.asc("label"), name="index")
    return numbered.select("column", "label", F.col("index").cast("double").alias("index"))


def with_indexes(df: DataFrame, columns: dict[str, str], labels: DataFrame | None = None) -> DataFrame:
    """Add an index column for each column of ``columns`` (column to new name).

    A label that ``labels`` does not have is an error. The size of a column's labels is checked before they are
    broadcast; past the bound Spark picks a shuffle join and splits hot labels.
    """
    labels = materialise(label_indexes(df, *columns), "labels") if labels is None else labels
    for column, output in columns.items():
        lookup = labels.where(F.col("column") == column).select(
            F.col("label").alias("_label"), F.col("index").alias("_index")
        )
        found = df.join(bounded(lookup), F.col(column).cast("string") == F.col("_label"), "left")
        unseen = F.raise_error(F.concat(F.lit(f"unseen label in {column}: "), F.col(column))).cast("double")
        missing = F.when(F.col(column).isNotNull() & F.col("_index").isNull(), unseen)
        df = found.withColumn(output, F.coalesce("_index", missing)).drop("_label", "_index")
    return df


def deviations_of(df: DataFrame, *columns: str) -> tuple[dict[str, float], int]:
    """The sample deviation of each column and the number of rows, in one aggregate.

    Tasks add up in any order, which moves the last digits; without them, a seeded fit always starts from the same values.
    """
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_rows")).head().asDict()
    rows = row.pop("_rows")
    return {c: float(f"{d or 0.0:.12g}") for c, d in row.items()}, rows


def scaled_columns(deviations: dict[str, float]) -> dict[str, Column]:
    """Each column divided by its deviation, without centring; a constant column becomes 0."""
    return {c: F.col(c) / d if d else F.lit(0.0) for c, d in deviations.items()}


@dataclass(frozen=True)
class MinMax:
    """Smallest and largest value per column: all that min-max scaling learns."""

    ranges: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: dict[str, Column]) -> MinMax:
        """One aggregate over the data; two numbers per column come back."""
        bounds = [f(c).alias(f"{p}{n}") for n, c in columns.items() for f, p in ((F.min, "lo_"), (F.max, "hi_"))]
        row = df.agg(*bounds).head()
        return cls({n: (row[f"lo_{n}"], row[f"hi_{n}"]) for n in columns})

    def scale(self, name: str, value: Column) -> Column:
        """To [0, 1]; a constant column becomes 0."""
        low, high = self.ranges[name]
        if low is None:
            return F.lit(None).cast("double")
        return (value - low) / ((high - low) or 1.0)

    def unscale(self, name: str, value: Column) -> Column:
        low, high = self.ranges[name]
        if low is None:
            return F.lit(None).cast("double")
        return value * ((high - low) or 1.0) + low


def basket_vocabulary(terms: DataFrame, size: int | None = None) -> DataFrame:
    """The vocabulary (feature_id, kind, term, customers) of ``basket_terms``.

    Categories come first, then products; each by descending number of customers, ties by the term. With ``size``, only
    so many of each are numbered; by default all are.
    """
    counts = terms.groupBy("kind", "term").agg(F.count(F.lit(1)).alias("customers"))
    # The terms may still have to be worked out.
    with small_tasks(terms.sparkSession):
        ranked = with_rank(counts, "kind", F.desc("customers"), F.asc("term"))
    if size is not None:
        ranked = ranked.where(F.col("rank") < size)
    categories = ranked.where(F.col("kind") == "Category").count()
    feature = F.col("rank") + F.when(F.col("kind") == "Category", 0).otherwise(categories)
    return ranked.select(feature.cast("int").alias("feature_id"), "kind", "term", "customers")


def bounded(lookup: DataFrame) -> DataFrame:
    """The lookup table, marked for broadcast if its contents, added up first, are within the bound."""
    cells = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in lookup.columns]
    size = lookup.agg(F.sum(sum(cells[1:], cells[0]))).head()[0] or 0
    return F.broadcast(lookup) if size <= BROADCAST_BYTES else lookup


def basket_entries(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(customer_id, feature_id): the terms by number, one row each; terms outside the vocabulary are left out."""
    lookup = bounded(vocabulary.select("kind", "term", "feature_id"))
    return terms.join(lookup, ["kind", "term"]).select("customer_id", "feature_id")


def basket_features(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row per customer: the sorted feature ids of what it bought. Terms outside the vocabulary are left out, and a
    customer with no other terms keeps an empty list."""
    lookup = bounded(vocabulary.select("kind", "term", "feature_id"))
    ids = terms.join(lookup, ["kind", "term"], "left").select("customer_id", "feature_id")
    return ids.groupBy("customer_id").agg(F.sort_array(F.collect_list("feature_id")).alias("features"))


def basket_lists(terms: DataFrame) -> DataFrame:
    """One row per customer: the sorted categories and products that it bought, all of them."""

    def of(kind: str) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("term"))))

    return terms.groupBy("customer_id").agg(of("Category").alias("categories"), of("Product").alias("products"))

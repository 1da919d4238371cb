"""Row order at scale: global positions, and neighbours within a customer.

Both use the range partitioner on a unique order, which splits any key evenly however many rows it has, and both write
the laid-out rows once (``materialise``) so that the layout is the same each time it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.schema import PURCHASE_ORDER
from salescope.sources.scratch import materialise

# monotonically_increasing_id puts the partition above the lower 33 bits and the row of the partition in them.
_ROW_BITS = 33


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the position (from 0) of each row in the total order ``order``, which should be unique.

    A range sort gives each task a run of the order; the runs' lengths, one row per partition, are summed up and
    broadcast. No task ever holds more than its run.
    """
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialise(laid.withColumn("_at", F.monotonically_increasing_id()), "position")
    run = F.shiftright("_at", _ROW_BITS)
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    lengths = laid.groupBy(run.alias("_run")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("_run", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        laid.withColumn("_run", run)
        .join(F.broadcast(starts), "_run")
        .withColumn(name, F.col("_start") + within)
        .drop("_at", "_run", "_start")
    )


def with_rank(df: DataFrame, group: str, *order: str | Column, name: str = "rank") -> DataFrame:
    """Add the position (from 0) of each row within its ``group``, of which there are few (one row each is broadcast).

    A group may hold any share of the rows: all are positioned together and the start of each group is taken off.
    """
    placed = with_position(df, group, *order, name="_position")
    starts = placed.groupBy(group).agg(F.min("_position").alias("_first"))
    ranked = placed.join(F.broadcast(starts), group)
    return ranked.withColumn(name, F.col("_position") - F.col("_first")).drop("_position", "_first")


def with_neighbours(
    df: DataFrame,
    key: str = "customer_id",
    order: tuple[str, ...] = PURCHASE_ORDER,
    following: dict[str, str] | None = None,
    trailing: dict[str, str] | None = None,
    length: int = 1,
) -> DataFrame:
    """Add values of neighbouring rows of the same ``key`` in the order ``order``.

    ``following`` maps a new column to the column whose value in the next row it takes (null in the last row).
    ``trailing`` maps a new column to the column whose last ``length`` values, the current one included and nulls left
    out, it lists.

    Rows are range-split on the key and the order, so that a key with very many rows, the null key included, lies in
    several chunks; each chunk is a window of its own. Only a key that crosses the border of two chunks has neighbours
    elsewhere: there is at most one per border, and the few rows at its chunk edges are broadcast to carry the values
    across. Building the frame writes the layout and runs nothing else.
    """
    following, trailing = following or {}, trailing or {}
    names = df.columns
    laid = materialise(df.repartitionByRange(key, *order).withColumn("_chunk", F.spark_partition_id()), "chunks")
    values = F.struct(*[F.col(c) for c in dict.fromkeys([*following.values(), *trailing.values()])])
    spread = laid.groupBy(F.col(key).alias("_key")).agg(F.min("_chunk").alias("_low"), F.max("_chunk").alias("_high"))
    spread = spread.where("_low < _high").select("_key")
    crossing = laid.join(F.broadcast(spread), laid[key].eqNullSafe(spread["_key"]), "left_semi")
    edges = _chunk_edges(crossing, key, order, values, length - 1).withColumnsRenamed(
        {key: "_edge_key", "_chunk": "_edge_chunk"}
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(*order)
    local = laid.withColumns({
        "_next": F.lead(values).over(in_chunk),
        "_seen": F.collect_list(values).over(in_chunk.rowsBetween(-(length - 1), 0)),
    })
    here = local[key].eqNullSafe(edges["_edge_key"]) & (local["_chunk"] == edges["_edge_chunk"])
    # At most two rows per chunk, whatever the number of rows.
    joined = local.join(F.broadcast(edges), here, "left")
    following_row = F.coalesce("_next", "_head_after")
    rows = F.concat(F.coalesce("_tail_before", F.array().cast(local.schema["_seen"].dataType)), "_seen")
    rows = F.slice(rows, F.greatest(F.size(rows) - (length - 1), F.lit(1)), length)
    columns = [following_row[source].alias(new) for new, source in following.items()]
    columns += [F.array_compact(rows.getField(source)).alias(new) for new, source in trailing.items()]
    return joined.select(*[local[n] for n in names], *columns)


def _chunk_edges(laid, key, order, values, before) -> DataFrame:
    """Per chunk of a key: the first row of its next chunk and the last ``before`` rows of its earlier chunks."""
    row = laid.select(key, "_chunk", *order, values.alias("_values"))
    up = Window.partitionBy(key, "_chunk").orderBy(*order)
    head = row.withColumn("_n", F.row_number().over(up)).where("_n = 1")
    edges = head.select(key, "_chunk", F.col("_values").alias("_head"))
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    if before < 1:
        empty = F.array().cast(f"array<{row.schema['_values'].dataType.simpleString()}>")
        return edges.select(
            key, "_chunk", F.lead("_head").over(by_chunk).alias("_head_after"), empty.alias("_tail_before")
        )
    down = Window.partitionBy(key, "_chunk").orderBy(*[F.desc(c) for c in order])
    tail = (
        row.withColumn("_n", F.row_number().over(down))
        .where(F.col("_n") <= before)
        .groupBy(key, "_chunk")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_n")).alias("_n"), "_values"))).alias("_tail"))
        .withColumn("_tail", F.col("_tail").getField("_values"))
    )
    # Every chunk has a row, so the last ``before`` rows lie within the last ``before`` chunks.
    earlier = F.flatten(F.collect_list("_tail").over(by_chunk.rowsBetween(-before, -1)))
    tail = tail.withColumnsRenamed({key: "_tail_key", "_chunk": "_tail_chunk"})
    both = edges[key].eqNullSafe(tail["_tail_key"]) & (edges["_chunk"] == tail["_tail_chunk"])
    return edges.join(tail, both).select(
        key,
        "_chunk",
        F.lead("_head").over(by_chunk).alias("_head_after"),
        F.slice(earlier, F.greatest(F.size(earlier) - (before - 1), F.lit(1)), before).alias("_tail_before"),
    )

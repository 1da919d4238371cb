"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Blocks of rows (the partitions of a written table) are the senders. How many rows each block sends to each shard is
drawn on the driver: the rows of a uniform shuffle spread like draws without replacement, so the counts of a block are
multivariate hypergeometric given the room left in the shards. Each block orders its rows by a random key and deals them
out by its counts; the exchange brings them to their shards, where a second random order gives the slots.

Contract: every row gets a shard and a slot, whatever its columns hold. Nulls and empty texts count as any row, repeated
rows are rows of their own, very long texts move once, an empty table gives an empty result. Extra columns stay, but for
names beginning with ``_shard``, which are used inside, and ``shard`` and ``slot``, which are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.llm.common import text_of
from salescope.sources.scratch import materialise

# The matrix has at most this many rows, however many partitions the table has.
BLOCKS = 4096
# Rows of a shard that one task orders.
CELL_ROWS = 200_000
# Fixed value: numpy draws hypergeometric numbers below this many rows only.
NUMPY_ROWS = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows taken without replacement are good, for any number of rows.

    Each row has a uniform key and the lowest ``drawn`` keys are taken. Too large a range of keys is halved: how many
    good and bad keys lie in the lower half is binomial, and only the half that the last taken key is in goes on.
    """
    taken = 0
    while good + bad >= NUMPY_ROWS:
        low_good, low_bad = int(rng.binomial(good, 0.5)), int(rng.binomial(bad, 0.5))
        if low_good + low_bad >= drawn:
            good, bad = low_good, low_bad
        else:
            taken, drawn = taken + low_good, drawn - low_good - low_bad
            good, bad = good - low_good, bad - low_bad
    return taken + (int(rng.hypergeometric(good, bad, drawn)) if drawn and good + bad else 0)


def communication_matrix(rows: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows per block and shard of a uniform shuffle; its margins are ``rows`` and ``sizes``."""
    rng = np.random.default_rng(seed)
    room, matrix = list(sizes), []
    for n in rows:
        counts, left, others = [], n, sum(room)
        for have in room:
            others -= have
            counts.append(hypergeometric(rng, have, others, left))
            left -= counts[-1]
        room = [a - b for a, b in zip(room, counts)]
        matrix.append(counts)
    return matrix


def shard(df: DataFrame, shards: int = 16, seed: int = 7, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``shard`` (from 0; sizes differ by one row at most) and ``slot`` (gapless from 0 in its shard).

    The given columns are written once, with their block; the counts per block (at most ``BLOCKS``) and per cell of a
    shard go to the driver or a broadcast, nothing else does.
    """
    spark = df.sparkSession
    base = materialise(
        df.drop("shard", "slot").withColumns({
            "_shard_block": F.pmod(F.spark_partition_id(), F.lit(BLOCKS)),
            "_shard_at": F.monotonically_increasing_id(),
        }),
        "shard-rows",
    )
    counted = sorted((r[0], r[1]) for r in base.groupBy("_shard_block").count().collect())
    total = sum(n for _, n in counted)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counted], sizes, seed)
    bounds = spark.createDataFrame(
        [(block, [int(x) for x in np.cumsum(row)]) for (block, _), row in zip(counted, matrix)],
        "_shard_block int, _shard_bounds array<bigint>",
    )
    first = F.xxhash64("_shard_at", F.lit(seed))
    in_block = Window.partitionBy("_shard_block").orderBy(first, "_shard_at")
    cells = max(1, -(-max(sizes) // cell_rows))
    ranked = base.select("_shard_block", "_shard_at", (F.row_number().over(in_block) - 1).alias("_shard_rank"))
    sent = ranked.join(F.broadcast(bounds), "_shard_block").select(
        "_shard_at",
        F.size(F.filter("_shard_bounds", lambda b: b <= F.col("_shard_rank"))).alias("shard"),
        F.xxhash64("_shard_at", F.lit(seed + 1)).alias("_shard_key"),
    )
    sent = materialise(sent.withColumn("_shard_cell", F.pmod("_shard_key", F.lit(cells))), "shard-sent")
    # shards x cells numbers, each cell standing for cell_rows rows: the sums over them are small.
    lengths = sent.groupBy("shard", "_shard_cell").agg(F.count(F.lit(1)).alias("_shard_n"))
    before = Window.partitionBy("shard").orderBy("_shard_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select(
        "shard", "_shard_cell", F.coalesce(F.sum("_shard_n").over(before), F.lit(0)).alias("_shard_start")
    )
    in_cell = Window.partitionBy("shard", "_shard_cell").orderBy("_shard_key", "_shard_at")
    slotted = sent.withColumn("_shard_rank", F.row_number().over(in_cell) - 1).join(
        starts, ["shard", "_shard_cell"]
    ).select("_shard_at", "shard", (F.col("_shard_start") + F.col("_shard_rank")).alias("slot"))
    return base.join(slotted, "_shard_at").drop("_shard_at", "_shard_block")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law ``rows``, with their sizes and checksums."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    thin = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("bigint").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
    )
    return shard(thin).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

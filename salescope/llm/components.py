"""Connected components of links, by union-find in the tasks and star operations between them.

Each task replaces its links by a forest of its own (union-find), which has fewer links and the same components. Then
rounds follow until all links are (least node of the component, node): a link whose upper node hangs on a lesser one moves
there, a node with several upper nodes joins them to the least, and the tasks make forests again. Links are dealt by their
lower end, of which a node has one per task at most, so that a node with any number of links is no burden to one task. The
upper nodes that hang on others are told to the links where they lie, if they are counted to be ``MOST_TOLD`` at most; more
meet them in a join, which Spark splits where one has very many links. Each round is written to the shared folder, and
only row counts and a checksum reach the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import ship
from salescope.sources.scratch import materialise

ship(__name__)

# Rounds after which something must be wrong: they grow with the logarithm of a component's size.
MOST_ROUNDS = 60
# Upper nodes on the move that are broadcast (two numbers each).
MOST_TOLD = 1_000_000


class Groups:
    """Union-find; the least member stands for its group."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for y in path:
            self.up[y] = x
        return x

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _forest(batches):
    """The links of a task as (node, least node)."""
    groups = Groups()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            groups.union(a, b)
    nodes = [n for n in groups.up if groups.find(n) != n]
    for start in range(0, len(nodes), 50_000):
        part = nodes[start:start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([groups.find(n) for n in part], pa.int64()), pa.array(part, pa.int64())], names=["a", "b"]
        )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its least node. A link may join a to a."""
    known = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    edges = materialise(known.mapInArrow(_forest, "a bigint, b bigint"), "forest")
    before = None
    for _ in range(MOST_ROUNDS):
        # Only the least of a node's upper nodes: one row for each link comes out, however many forests name the node.
        upper = edges.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("upper"))
        moving = materialise(upper.join(edges.select("a").distinct(), "a", "left_semi"), "moving")
        if moving.count() <= MOST_TOLD:
            moved = edges.join(F.broadcast(moving), "a", "left").select(F.coalesce("upper", "a").alias("a"), "b")
        else:
            moved = edges.join(moving, "a", "left").select(F.coalesce("upper", "a").alias("a"), "b")
        least = moved.withColumn("least", F.min("a").over(Window.partitionBy("b")))
        hung = F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least")))
        hung = least.select(hung.alias("x")).select(F.col("x.least").alias("a"), F.col("x.b").alias("b")).where("a <> b")
        edges = materialise(hung.mapInArrow(_forest, "a bigint, b bigint"), "components")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("a").alias("node")).distinct()
            # Every task may have told the same link.
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).distinct().union(
                roots.select("node", F.col("node").alias("component"))
            )
        before = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")

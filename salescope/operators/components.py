"""Principal components of customer baskets.

A basket is a row of 0/1 features, given as entries (customer_id, feature_id). The covariance matrix is never formed; all
that is needed are its products with a block of trial vectors.

With a vocabulary that fits the bounds below, the entries are laid out once: by customer, each part packed as the sparse rows
of its customers and, turned round, as the customers of its features. A product sends the block to the parts, which
multiply by both, and only partial blocks are shuffled, never entries. The vectors span a block Krylov space, which the
driver keeps orthonormal (``DRIVER_BYTES``).

A larger vocabulary stays in tables: the block has one row per feature, and a product is two joins with the entries, each
summed up by the other side's key. The driver then holds matrices of the block's few columns only, however many features
and customers there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.shipping import ship
from salescope.operators.encoding import BROADCAST_BYTES, bounded
from salescope.sources.scratch import discard, materialise, small_tasks

ship(__name__)

#: Trial vectors beyond the wanted ones; more of them settle in fewer rounds.
EXTRA = 9

#: Products with the covariance between two looks at the result, and the most rounds of them.
DEGREE, MOST_ROUNDS = 6, 25

#: The norm of what is left of an eigenvector's equation, relative to the largest eigenvalue.
TOLERANCE = 1e-6

#: Krylov space and images on the driver, in bytes; the most products of one fit.
DRIVER_BYTES, MOST_PRODUCTS = 256 << 20, 200

#: Entries of a part at least, and entries for each feature: partial blocks then stay in proportion to the entries.
PART_ENTRIES, PART_SHARE = 200_000, 20

#: Entries of a packed row at most (more only if one customer has them), and features of a partial block.
PACKED_ENTRIES, CHUNK_FEATURES = 250_000, 4096

#: What a task reads of tables beyond those bounds: it sorts its entries, and holds a row of sums for each customer or
#: feature that it meets. With smaller tasks more such rows are shuffled.
TABLE_TASK_BYTES = "32m"

#: Partial blocks that one task adds up.
PARTS_AT_ONCE = 64


def principal_components(entries: DataFrame, vocabulary: DataFrame, k: int) -> tuple[DataFrame, list[float | None]]:
    """Loadings (feature_id, PC1 .. PCk) and the share of variance that each component explains.

    An error says so if the vectors have not settled after ``MOST_PRODUCTS`` products, or ``MOST_ROUNDS`` rounds of a large
    vocabulary. The sign of a component is free; it is set so that the loading largest in size is positive, of equal ones that
    of the first feature.

    With one customer, or equal baskets, there is no variance: all loadings are 0 and the shares null. Components beyond
    the rank of the baskets have loadings 0 and share 0.
    """
    features = vocabulary.count()
    width = min(k + EXTRA, features)
    # The block as sent to tasks, and four blocks with their images on the driver.
    if features * width * 8 <= BROADCAST_BYTES and 8 * width * features * 8 <= DRIVER_BYTES:
        return _of_packed(entries, vocabulary, k)
    with small_tasks(entries.sparkSession, TABLE_TASK_BYTES):
        # Products add up by customer first, which combines well in tasks that have all of a customer's entries.
        laid = materialise(entries.select("customer_id", "feature_id").repartition("customer_id"), "customer-entries")
        return _of_tables(laid, vocabulary, k)


def _of_tables(entries: DataFrame, vocabulary: DataFrame, k: int) -> tuple[DataFrame, list[float | None]]:
    """``principal_components`` with everything that grows in tables.

    Chebyshev-filtered subspace iteration: each round multiplies the block by a polynomial of the covariance that grows
    fast above the least value found so far, makes its columns orthonormal, and finds the best vectors within them.
    """
    rows = entries.select("customer_id").distinct().count()
    names = [f"PC{i + 1}" for i in range(k)]
    of_feature = F.col("customers") / F.lit(rows)
    total, features = vocabulary.agg(F.sum(of_feature * (1 - of_feature)), F.count(F.lit(1))).first()
    total = (total or 0.0) * rows / max(rows - 1, 1)
    if rows < 2 or total < 1e-12:
        zero = [F.lit(0.0).alias(n) for n in names]
        return vocabulary.select("feature_id", *zero), [None] * k
    width = min(k + EXTRA, features)
    block = [f"z{j}" for j in range(width)]
    image = [f"w{j}" for j in range(width)]
    # The block is broadcast if its size, known beforehand, is within the bound; else Spark shuffles it and splits hot terms.
    sent = F.broadcast if features * (width + 1) * 8 <= BROADCAST_BYTES else (lambda df: df)

    def with_image(table: DataFrame) -> DataFrame:
        """Add the product of the covariance with the block."""
        means = table.agg(*[F.sum(F.col("customers") * F.col(z)).alias(z) for z in block]).first()
        by_customer = entries.join(sent(table.select("feature_id", *block)), "feature_id").groupBy("customer_id")
        # Written first: the tasks of the join would else be as many as the partial sums need, and leave more to add up.
        sums = materialise(by_customer.agg(*[F.sum(z).alias(z) for z in block]), "customer-sums")
        by_feature = entries.join(sums, "customer_id").groupBy("feature_id")
        products = by_feature.agg(*[F.sum(z).alias(w) for z, w in zip(block, image)])
        centred = [
            ((F.coalesce(F.col(w), F.lit(0.0)) - F.col("customers") * F.lit(means[z] / rows)) / (rows - 1)).alias(w)
            for z, w in zip(block, image)
        ]
        kept = [c for c in table.columns if c not in image]
        multiplied = materialise(table.join(products, "feature_id", "left").select(*kept, *centred), "block")
        discard(sums)
        return multiplied

    def times(columns: list[str], matrix: np.ndarray, to: list[str]):
        return [
            sum((F.col(c) * float(x) for c, x in zip(columns, matrix[:, j])), F.lit(0.0)).alias(name)
            for j, name in enumerate(to)
        ]

    start = [(F.xxhash64("feature_id", F.lit(j)) / float(1 << 63)).alias(z) for j, z in enumerate(block)]
    table = materialise(vocabulary.select("feature_id", "customers", *start), "block")
    for _ in range(MOST_ROUNDS):
        for _ in range(2):
            # Twice, as once leaves rounding errors where columns were nearly dependent.
            gram = _inner_products(table, block)
            table = table.select("feature_id", "customers", *times(block, _orthonormal(gram), block))
        table = with_image(table)
        inner = _inner_products(table, block + image)
        small = (inner[:width, width:] + inner[width:, :width]) / 2
        values, vectors = np.linalg.eigh(small)
        values, vectors = values[::-1], vectors[:, ::-1]
        # |W v - value Z v|^2, from the inner products of Z and of its image W alone.
        left = np.einsum("ij,ij->j", vectors, inner[width:, width:] @ vectors) - values**2
        found = np.sqrt(np.maximum(left[:k], 0)) <= max(TOLERANCE * values[0], 3e-8 * values[0])
        if found.all() or width == features:
            loadings = table.select("feature_id", *times(block, vectors[:, :k], names[:width]))
            kept = [max(float(v), 0.0) if v > 1e-9 * values[0] else 0.0 for v in values[:k]]
            return _signed(loadings, names, kept), [v / total for v in [*kept, *[0.0] * (k - len(kept))]]
        # Below the least value of the block the polynomial stays within [-1, 1].
        bound = max(float(values[-1]), 1e-6 * float(values[0]))
        before = [f"b{j}" for j in range(width)]
        table = table.select("feature_id", "customers", *[F.col(z).alias(b) for z, b in zip(block, before)],
                             *[(F.col(w) * (2 / bound) - F.col(z)).alias(z) for z, w in zip(block, image)])
        for _ in range(DEGREE - 1):
            table = with_image(table)
            further = [(2 * (F.col(w) * (2 / bound) - F.col(z)) - F.col(b)).alias(z)
                       for z, w, b in zip(block, image, before)]
            table = table.select("feature_id", "customers", *[F.col(z).alias(b) for z, b in zip(block, before)], *further)
        table = materialise(table.select("feature_id", "customers", *block), "block")
    raise RuntimeError(f"principal components did not settle in {MOST_ROUNDS} rounds")


@dataclass(frozen=True)
class PackedBaskets:
    """Baskets laid out for products: a written table of sparse blocks of rows, by customer."""

    table: DataFrame
    customers: int
    parts: int

    @classmethod
    def of(cls, entries: DataFrame, ids: np.ndarray) -> PackedBaskets:
        """The entries, shuffled by customer once. ``ids`` are the feature ids in order; a feature's place counts from then on."""
        count = entries.count()
        parts = count // max(PART_ENTRIES, PART_SHARE * len(ids)) + 1
        laid = entries.select("customer_id", "feature_id").repartition(parts, "customer_id")
        laid = laid.sortWithinPartitions("customer_id", "feature_id")
        sent = entries.sparkSession.sparkContext.broadcast(ids)
        bound = PACKED_ENTRIES

        def pack(batches):
            places, owners = [], []
            for batch in batches:
                places.append(np.searchsorted(sent.value, batch.column(1).to_numpy(zero_copy_only=False)).astype(np.int32))
                # A null customer is a customer of its own; it sorts first.
                known = [batch.column(0).is_valid(), batch.column(0).fill_null(0)]
                owners.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in known], axis=1))
                if sum(map(len, places)) >= bound:
                    place, owner = np.concatenate(places), np.concatenate(owners)
                    cut = _last_start(owner)
                    if cut:
                        yield _packed(place[:cut], owner[:cut])
                    places, owners = [place[cut:]], [owner[cut:]]
            if places and len(place := np.concatenate(places)):
                yield _packed(place, np.concatenate(owners))

        schema = "customers bigint, starts binary, features binary, members binary, present binary, member_starts binary"
        # The tasks that deal the entries out hold all they read.
        with small_tasks(entries.sparkSession):
            table = materialise(laid.mapInArrow(pack, schema), "packed-baskets")
        return cls(table, table.agg(F.sum("customers")).first()[0] or 0, parts)

    def partial_products(self, block: np.ndarray, means: np.ndarray) -> DataFrame:
        """(chunk, part, sums): what each part of the table adds to X'(X - 1 means')block, by chunk of features."""
        context = self.table.sparkSession.sparkContext
        sent, shift = context.broadcast(block), means @ block
        features, width = block.shape

        def multiply(batches):
            total = np.zeros((features, width))
            for batch in batches:
                for row in batch.to_pylist():
                    starts, places, members, present, member_starts = (
                        np.frombuffer(row[name], "<i4")
                        for name in ("starts", "features", "members", "present", "member_starts")
                    )
                    scores = np.add.reduceat(sent.value[places], starts, axis=0) - shift
                    total[present] += np.add.reduceat(scores[members], member_starts, axis=0)
            chunks = range(0, features, CHUNK_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(chunks)), pa.int32()),
                 pa.array([total[c:c + CHUNK_FEATURES].tobytes() for c in chunks], pa.binary())], names=["chunk", "sums"],
            )

        return self.table.mapInArrow(multiply, "chunk int, sums binary")

    def times(self, block: np.ndarray, means: np.ndarray) -> np.ndarray:
        """The product of the covariance with the block."""
        features, width = block.shape
        partial = self.partial_products(block, means)
        chunks, groups = -(-features // CHUNK_FEATURES), self.parts
        while True:
            # Many partial blocks meet in two or more levels.
            groups = -(-groups // PARTS_AT_ONCE)
            partial = partial.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
            partial = partial.repartition(chunks * groups, "chunk", "_group").mapInArrow(_add_up, "chunk int, sums binary")
            if groups == 1:
                break
        total = np.zeros(block.shape)
        for row in partial.collect():
            sums = np.frombuffer(row["sums"]).reshape(-1, width)
            total[row["chunk"] * CHUNK_FEATURES:][:len(sums)] += sums
        # The parts left out the means of the outer factor: its sums of scores are 0 by then.
        return total / (self.customers - 1)


def _last_start(owner: np.ndarray) -> int:
    """Where the last customer's entries begin."""
    return int(np.flatnonzero((owner[1:] != owner[:-1]).any(axis=1))[-1] + 1) if (owner[0] != owner[-1]).any() else 0


def _packed(places: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """One row: the features of each customer, and the customers of each feature that occurs."""
    first = np.concatenate([[True], (owner[1:] != owner[:-1]).any(axis=1)])
    customer, order = np.cumsum(first) - 1, np.argsort(places, kind="stable")
    present, member_starts = np.unique(places[order], return_index=True)
    arrays = (np.flatnonzero(first), places, customer[order], present, member_starts)
    return pa.RecordBatch.from_arrays(
        [pa.array([int(first.sum())], pa.int64()), *[pa.array([a.astype("<i4").tobytes()], pa.binary()) for a in arrays]],
        names=["customers", "starts", "features", "members", "present", "member_starts"],
    )


def _add_up(batches):
    """Partial blocks of the same chunk become one."""
    totals = {}
    for batch in batches:
        for chunk, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            sums = np.frombuffer(sums.as_py())
            totals[chunk] = totals[chunk] + sums if chunk in totals else sums
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
        names=["chunk", "sums"],
    )


def _of_packed(entries: DataFrame, vocabulary: DataFrame, k: int) -> tuple[DataFrame, list[float | None]]:
    """``principal_components`` by a block Krylov space, restarted with its best vectors where it would outgrow its bound."""
    known = vocabulary.select("feature_id", "customers").orderBy("feature_id").toArrow()
    ids, counts = (c.to_numpy().astype(np.int64) for c in known.columns)
    baskets = PackedBaskets.of(entries, ids)
    rows, names = baskets.customers, [f"PC{i + 1}" for i in range(k)]
    means = counts / max(rows, 1)
    total = float((means * (1 - means)).sum()) * rows / max(rows - 1, 1)
    if rows < 2 or total < 1e-12:
        return vocabulary.select("feature_id", *[F.lit(0.0).alias(n) for n in names]), [None] * k
    width = min(k + EXTRA, len(ids))
    most = max(DRIVER_BYTES // (len(ids) * 8 * 2), 4 * width)
    block = np.linalg.qr(np.random.default_rng(1).normal(size=(len(ids), width)))[0]
    space, images = block[:, :0], block[:, :0]
    for _ in range(MOST_PRODUCTS):
        space, images = np.hstack([space, block]), np.hstack([images, baskets.times(block, means)])
        small = space.T @ images
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        best = vectors[:, :width]
        left = images @ best - (space @ best) * values[:width]
        bound = max(TOLERANCE, 3e-8) * values[0]
        if (np.linalg.norm(left[:, :k], axis=0) <= bound).all() or space.shape[1] == len(ids):
            kept = [float(v) if v > 1e-9 * values[0] else 0.0 for v in values[:k]]
            kept += [0.0] * (k - len(kept))
            return _loadings(entries, ids, space @ best[:, :k], kept, names), [v / total for v in kept]
        if space.shape[1] + width > most:
            space, images = space @ best, images @ best
        # The next block is the last one's image; what is left of the best vectors after a restart.
        block = left if space.shape[1] == width else images[:, -width:]
        for _ in range(2):
            # Twice, as once leaves rounding errors where columns were nearly dependent.
            block = block - space @ (space.T @ block)
            block, size = np.linalg.qr(block)
        fresh = np.abs(np.diag(size)) > 1e-10
        block = block[:, fresh][:, :len(ids) - space.shape[1]]
        if not block.shape[1]:
            # The space is closed: its vectors are exact, and those beyond it have no variance.
            kept = [float(v) if v > 1e-9 * values[0] else 0.0 for v in values[:k]]
            kept += [0.0] * (k - len(kept))
            return _loadings(entries, ids, space @ best[:, :k], kept, names), [v / total for v in kept]
    raise RuntimeError(f"principal components did not settle in {MOST_PRODUCTS} products")


def _loadings(entries: DataFrame, ids: np.ndarray, vectors: np.ndarray, values: list[float], names: list[str]) -> DataFrame:
    """The vectors as a table, with the sign rule applied; columns without variance become 0."""
    columns = np.zeros((len(ids), len(names)))
    columns[:, :vectors.shape[1]] = vectors
    peaks = columns[np.round(np.abs(columns), 9).argmax(axis=0), np.arange(len(names))]
    columns = columns * np.where(np.array(values) > 0, np.where(peaks < 0, -1.0, 1.0), 0.0)
    table = pa.table({"feature_id": pa.array(ids, pa.int32()), **{n: columns[:, i] for i, n in enumerate(names)}})
    return materialise(entries.sparkSession.createDataFrame(table), "loadings")


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """What makes columns with these inner products orthonormal; dependent ones become 0."""
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    values, vectors = np.linalg.eigh(gram * scale[:, None] * scale)
    inverse = np.where(values > 1e-14 * values[-1], 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return (scale[:, None] * vectors) * inverse


def _inner_products(table: DataFrame, columns: list[str]) -> np.ndarray:
    """The inner products of all pairs of columns: tasks add up their rows, and their sums meet by place."""
    count = len(columns)

    def add_up(batches):
        total = np.zeros((count, count))
        for batch in batches:
            part = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            total += part.T @ part
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(count * count)), pa.array(total.ravel())], names=["place", "value"]
        )

    parts = table.select(*columns).mapInArrow(add_up, "place bigint, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    result = np.zeros(count * count)
    for row in rows:
        result[row["place"]] = row["value"]
    return result.reshape(count, count)


def _signed(loadings: DataFrame, names: list[str], values: list[float]) -> DataFrame:
    """Loadings with the sign rule applied; columns without variance become 0."""
    have = [n for n in names if n in loadings.columns]
    peaks = loadings.agg(*[
        F.max_by(F.col(n), F.struct(F.round(F.abs(F.col(n)), 9), -F.col("feature_id"))).alias(n) for n in have
    ]).first()
    signs = {n: (0.0 if not v else -1.0 if peaks[n] < 0 else 1.0) for n, v in zip(have, values)}
    columns = [(F.col(n) * signs[n] if n in have else F.lit(0.0)).alias(n) for n in names]
    return materialise(loadings.select("feature_id", *columns), "loadings")


def project(entries: DataFrame, loadings: DataFrame) -> DataFrame:
    """Each customer's score per component: the sum of the loadings of its basket (not centred)."""
    names = loadings.columns[1:]
    scores = entries.join(bounded(loadings), "feature_id").groupBy("customer_id")
    return scores.agg(*[F.sum(n).alias(n) for n in names])

"""Mixing to target weights with soft domains: a classifier's posteriors, and rates that meet the targets.

The domains are the label combinations of a labelled table (quality and toxicity). A softmax over hashed words and a few
text statistics, fitted on a bounded sample of labelled rows, gives each document its domain posteriors. With P(i, k) the
posterior and n(i) the tokens of a document, the rates r(i) >= 0 minimise

    1/2 |sum_i r(i) n(i) P(i, .) - target|^2 + RIDGE/2 sum_i n(i) (r(i) - 1)^2

by projected gradient steps. Lengths of the residual are taken relative to the domains' overlap (among documents with a
rate above 0), so that a rare domain settles as fast as a frequent one. What changes from step to step is one move of K
numbers: a pass over the table replays the moves so far for each document and adds up the expected tokens per domain and
the overlap, so nothing but these K + K x K sums comes to the driver, no rates are stored, and a lost executor costs one
repeated task.

Contract: a null or empty text has no tokens and takes the posteriors of the statistics alone; labels that are null or
of unknown ids teach nothing; without labels there is one domain, and all rates are 1; a domain that no document can
supply stays short of its target; texts are read whole; repeated rows each get their result; extra columns stay, but for
those of the result's names; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship
from salescope.sources.scratch import materialise

ship(__name__)

# The labelled documents that the classifier is fitted on, those with the least hashes of their ids.
MOST_LABELS = 12_000
BUCKETS, EPOCHS, BATCH, RATE = 1 << 17, 6, 16, 0.3
# The pull of the rates to 1, the residual that is good enough (of all tokens), and the most passes.
RIDGE, TOLERANCE, MOST_PASSES = 1e-5, 1e-4, 80
# What may be left of a residual that documents could serve when the passes run out.
LEFT = 1e-2
# The weights of the registered query and of the pipeline, by (quality, toxic).
TARGETS = {"quality1-toxic0": 0.92, "quality0-toxic0": 0.07, "quality1-toxic1": 0.008, "quality0-toxic1": 0.002}

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SYMBOLS = b"#*$%&|<>"


def features(text: str | None) -> tuple[np.ndarray, int]:
    """The buckets of the distinct words and of the statistics of a text, and its number of words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_WORD_BYTES).split()
    distinct = set(words)
    size = max(len(raw), 1)
    upper = sum(raw.count(bytes([c])) for c in range(65, 91))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    shares = {
        "upper": upper / size, "symbols": symbols / size, "marks": raw.count(b"!") / size,
        "repeats": 1 - len(distinct) / max(len(words), 1), "length": len(raw) / max(len(words), 1) / 40,
        "lines": raw.count(b"\n") / size, "bars": raw.count(b"|") / size,
    }
    told = [f"\x00{name}{min(int(math.sqrt(share) * 20), 20)}".encode() for name, share in shares.items()]
    told.append(b"\x00words%d" % len(words).bit_length())
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, [*distinct, *told]), np.uint64, len(distinct) + len(told))
    return np.unique(ids & np.uint64(BUCKETS - 1)).astype(np.int64), len(words)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def domain(quality: str = "quality", toxic: str = "toxic"):
    """The domain of a labelled row, null if a label is."""
    return F.concat(F.lit("quality"), F.col(quality).cast("string"), F.lit("-toxic"), F.col(toxic).cast("string"))


def fit(docs: DataFrame, labels: DataFrame, domains: list[str], most: int = MOST_LABELS, seed: int = 5) -> np.ndarray:
    """Scores of each bucket for each domain, by stochastic gradient descent with rates per weight."""
    order = F.xxhash64("doc_id", F.lit(13))
    chosen = labels.where("doc_id is not null").select("doc_id", domain().alias("domain"))
    chosen = chosen.where(F.col("domain").isin(domains)).orderBy(order, "doc_id", "domain").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("domain", order.alias("order"), "text")

    def of_batches(batches):
        for batch in batches:
            found = [features(t.as_py())[0].astype("<u4").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["domain", "order", "ids"]
            )

    found = rows.mapInArrow(of_batches, "domain string, order bigint, ids binary")
    found = found.orderBy("order", "domain", "ids").limit(most).collect()
    weights = np.zeros((BUCKETS, len(domains)), np.float32)
    squares = np.full((BUCKETS, 1), 1e-6, np.float32)
    ids = [np.frombuffer(r["ids"], "<u4").astype(np.int64) for r in found]
    label = np.array([domains.index(r["domain"]) for r in found], np.int64)
    rng, at = np.random.default_rng(seed), np.arange(len(found))
    for _ in range(EPOCHS):
        rng.shuffle(at)
        for start in range(0, len(at), BATCH):
            batch = at[start:start + BATCH]
            owner = np.repeat(np.arange(len(batch)), [len(ids[i]) for i in batch])
            flat = np.concatenate([ids[i] for i in batch])
            scale = np.sqrt([[len(ids[i])] for i in batch]).astype(np.float32)
            scores = np.zeros((len(batch), len(domains)), np.float32)
            np.add.at(scores, owner, weights[flat])
            wrong = softmax(scores / scale)
            wrong[np.arange(len(batch)), label[batch]] -= 1
            step = (wrong / scale)[owner]
            np.add.at(squares, flat, (step * step).sum(axis=1, keepdims=True))
            np.add.at(weights, flat, -RATE * step / np.sqrt(squares[flat]))
    return weights


def with_posteriors(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with n_tokens and posteriors, written to the shared folder; later passes read the columns they need."""
    kept = docs.drop("n_tokens", "posteriors", "rate", "copies")
    names, at = kept.columns, kept.columns.index("text")
    schema = kept.selectExpr("*", "0L as n_tokens", "array(0D) as posteriors").schema

    def of_batches(batches):
        for batch in batches:
            tokens, scores = [], []
            for text in batch.column(at):
                ids, n = features(text.as_py())
                tokens.append(n)
                scores.append(weights[ids].sum(axis=0) / math.sqrt(len(ids)))
            posteriors = softmax(np.array(scores, np.float64).reshape(-1, weights.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64()), pa.array(list(posteriors), pa.list_(pa.float64()))],
                names=[*names, "n_tokens", "posteriors"],
            )

    return kept.mapInArrow(of_batches, schema)


def replay(posteriors: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """The rates of documents after the given steps, each a move per domain."""
    rates = np.ones(len(posteriors))
    for move in steps:
        rates = np.maximum(rates - posteriors @ move - RIDGE * (rates - 1), 0.0)
    return rates


def _arrays(batch, domains: int):
    tokens = batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(np.float64)
    posteriors = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)
    return tokens, posteriors


def _summed(table: DataFrame, of_batch, size: int) -> np.ndarray:
    """The sum over all documents of ``size`` numbers that ``of_batch`` works out for a batch."""

    def of_batches(batches):
        total = np.zeros(size)
        for batch in batches:
            total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=[f"s{i}" for i in range(size)])

    sums = table.select("n_tokens", "posteriors").mapInArrow(of_batches, ", ".join(f"s{i} double" for i in range(size)))
    row = sums.agg(*[F.sum(c).alias(c) for c in sums.columns]).first()
    return np.array([x or 0.0 for x in row])


def solve(table: DataFrame, weights: list[float], epochs: float = 1.0) -> tuple[list[np.ndarray], np.ndarray]:
    """The steps whose replay gives the rates, and the last residual per domain (as shares of all tokens).

    The residual is what is supplied beyond the target; a domain that no document has keeps a negative one. An error says so
    if the passes run out with more than ``LEFT`` that documents could serve.
    """
    k = len(weights)

    tokens = _summed(table, lambda batch: np.array([_arrays(batch, k)[0].sum()]), 1)[0]
    target, steps, residual, size, last, left = np.array(weights) * epochs, [], np.zeros(k), 1.0, np.inf, 0.0
    for _ in range(MOST_PASSES if tokens else 0):
        taken = list(steps)

        def supplied(batch, taken=taken) -> np.ndarray:
            n, p = _arrays(batch, k)
            rates = replay(p, taken)
            # The overlap of domains among the documents that can still move.
            return np.concatenate([(rates * n) @ p, ((p * (n * (rates > 0))[:, None]).T @ p).ravel()])

        sums = _summed(table, supplied, k + k * k) / tokens
        residual = sums[:k] - target
        overlap = sums[k:].reshape(k, k)
        # Directions that (nearly) no document has cannot be served: what is left in them is not what a step is for.
        move = np.linalg.pinv(overlap, rcond=1e-6, hermitian=True) @ residual
        left = np.abs(overlap @ move).max()
        if left < TOLERANCE:
            break
        # A step that led away was too long, one that led nearer may have been too short.
        size, last = (size / 2 if left > last else min(1.0, size * 1.5)), left
        steps.append(size * move)
    if left > LEFT:
        raise RuntimeError(f"mixing did not settle in {MOST_PASSES} passes: {left:.4f} of all tokens off its targets")
    return steps, residual


def short_domains(domains: list[str], residual: np.ndarray) -> dict[str, float]:
    """The domains that are off their targets by more than the tolerance, with their gaps (shares of all tokens)."""
    return {d: float(r) for d, r in zip(domains, residual) if abs(r) > 10 * TOLERANCE}


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], epochs: float = 1.0, seed: int = 17) -> DataFrame:
    """(doc_id, row, n_tokens, posteriors (by sorted domain), rate, copies): the rate rounded up or down by a hash.

    ``row`` holds the columns of ``docs``. The expected tokens of domain k over all copies are its target weight times
    ``epochs`` times all tokens.
    """
    domains = sorted(targets)
    weights = fit(docs, labels, domains)
    packed = docs.select("doc_id", F.struct(*docs.columns).alias("row"), "text")
    table = materialise(with_posteriors(packed, weights).drop("text"), "posteriors")
    steps, _ = solve(table, [targets[d] / sum(targets.values()) for d in domains], epochs)
    return _rated(table, steps, seed)


def _rated(table: DataFrame, steps: list[np.ndarray], seed: int) -> DataFrame:
    names, at = table.columns, table.columns.index("posteriors")
    moves = [[float(x) for x in s] for s in steps]

    def of_batches(batches):
        taken = [np.array(m) for m in moves]
        for batch in batches:
            size = len(batch.column(at)[0]) if batch.num_rows else 1
            p = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replay(p, taken))], names=[*names, "rate"])

    rated = table.mapInArrow(of_batches, table.selectExpr("*", "0D as rate").schema)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with each row as often as the mix says; the columns stay as they are."""
    mixed = mix(docs, labels, targets or TARGETS).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its tokens, likeliest domain, posteriors, rate and copies, and by how much the domain misses its target (0
    if by no more than the tolerance)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domains = sorted(TARGETS)
    table = materialise(with_posteriors(docs, fit(docs, labels, domains)).drop("text"), "posteriors")
    steps, residual = solve(table, [TARGETS[d] for d in domains])
    gaps = short_domains(domains, residual)
    likeliest = F.element_at(F.array(*[F.lit(d) for d in domains]),
                             F.array_position("posteriors", F.array_max("posteriors")).cast("int"))
    gap = F.coalesce(*[F.when(F.col("domain") == d, F.lit(gaps.get(d, 0.0))) for d in domains], F.lit(0.0))
    return _rated(table, steps, 17).withColumn("domain", likeliest).select(
        "doc_id", "n_tokens", "domain",
        *[F.element_at("posteriors", i + 1).alias(f"p_{d.replace('-', '_')}") for i, d in enumerate(domains)],
        "rate", "copies", gap.alias("domain_gap"),
    )

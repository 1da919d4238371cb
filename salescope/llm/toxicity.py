"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal steps.

A text is lower-cased; its words, pairs of neighbours, and pairs with one or two words between them are hashed to 32 bits,
and what occurs counts once. Hashes are not folded into fewer buckets: a long text would fill a large share of them. Each
coordinate has a learning rate of its own, which falls with the gradients it has seen, and the L1 part of the proximal
step holds every weight at exactly 0 until the evidence for it outweighs the penalty. So the model that goes to the tasks is
a short sorted list of hashes with their weights, and texts are scored where they lie.

It is fitted on a bounded sample: the ``MOST_DOCS`` labelled documents with the least hash of their id, of each at most
``MOST_FEATURES`` features, those with the least hashes. Features of fewer than ``LEAST_DOCS`` sampled documents are left out.

Contract: labels of ids that no document has, null labels and null ids teach nothing; without labels, or with labels of one
kind, the score is the smoothed share of toxic labels (0.5 without any); a null or empty text has no features, and its score
is that of the intercept; texts are read whole; repeated rows each get their result; extra columns stay, but for ``score``
and ``predicted``, which are replaced; an empty table gives no rows. Scores depend on the text alone.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship

ship(__name__)

# The sample, the features of a sampled document, and the sampled documents that a feature must occur in.
MOST_DOCS, MOST_FEATURES, LEAST_DOCS = 4000, 32_768, 3
# Learning rate, its smoothing, the two penalties, and passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 10.0, 0.1, 6
# Bytes of a text that are split into words at a time.
BLOCK = 1 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# One odd multiplier for each distance between the two words of a pair.
_PAIRS = {1: 0x9E3779B1, 2: 0x85EBCA6B, 3: 0xC2B2AE35}


def word_hashes(text: str) -> np.ndarray:
    """The hashes of a text's words, in order."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    parts, at = [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw) and _WORD.match(raw, end, end + 1):
            end += 1
        words = _WORD.findall(raw, at, end)
        parts.append(np.fromiter(map(crc32, words), np.uint32, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def features(text: str | None) -> np.ndarray:
    """The distinct features of a text, sorted."""
    words = word_hashes(text or "")
    found = [words]
    for apart, odd in _PAIRS.items():
        if len(words) > apart:
            mixed = (words[:-apart] * np.uint32(odd)) ^ (words[apart:] + np.uint32(apart))
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x27D4EB2F)
            found.append(mixed ^ (mixed >> np.uint32(13)))
    return np.unique(np.concatenate(found))


class Model:
    """The intercept, and the hashes of the features whose weight is not 0."""

    def __init__(self, intercept: float, hashes: np.ndarray, weights: np.ndarray):
        self.intercept, self.hashes, self.weights = intercept, hashes, weights

    def score(self, text: str | None) -> float:
        margin = self.intercept
        if len(self.hashes):
            found = features(text)
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            margin += float(self.weights[at][self.hashes[at] == found].sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step in closed form: 0 where the sum of gradients is within the L1 penalty."""
    beyond = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -beyond / ((BETA + np.sqrt(n)) / ALPHA + L2)


def train(rows: list[tuple[int, np.ndarray]], seed: int = 7) -> Model:
    """Fit on (label, sorted features) rows, one at a time, in an order that the seed fixes."""
    toxic = sum(label for label, _ in rows)
    smoothed = (toxic + 0.5) / (len(rows) + 1)
    intercept = float(np.log(smoothed / (1 - smoothed)))
    if not 0 < toxic < len(rows):
        return Model(intercept, np.zeros(0, np.uint32), np.zeros(0))
    hashes, docs = np.unique(np.concatenate([found for _, found in rows]), return_counts=True)
    hashes = hashes[docs >= LEAST_DOCS]
    places = []
    for _, found in rows:
        at = np.searchsorted(hashes, found)
        at[at == len(hashes)] = 0
        places.append(at[hashes[at] == found] if len(hashes) else at[:0])
    z, n = np.zeros(len(hashes)), np.zeros(len(hashes))
    bias, bias_n = intercept, 0.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, at = rows[i][0], places[i]
            w = weights_of(z[at], n[at])
            wrong = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -40, 40))) - label
            z[at] += wrong - (np.sqrt(n[at] + wrong**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += wrong**2
            # The intercept has a rate of its own and no penalty.
            bias_n += wrong**2
            bias -= ALPHA * wrong / (BETA + np.sqrt(bias_n))
    w = weights_of(z, n)
    return Model(float(bias), hashes[w != 0], w[w != 0])


def held_out() -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_DOCS) -> list[tuple[int, np.ndarray]]:
    """Label and features of the sampled documents, at most ``most`` of them, in an order that the ids fix."""
    order = F.xxhash64("doc_id", F.lit(17))
    usable = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.select("doc_id", (F.col("toxic") == 1).cast("int").alias("label")).distinct()
    known = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(order, "doc_id", "label").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", order.alias("order"), "text")

    def of_batches(batches):
        for batch in batches:
            found = [features(text.as_py())[:MOST_FEATURES].astype("<u4").tobytes() for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["label", "order", "features"]
            )

    found = rows.mapInArrow(of_batches, "label int, order bigint, features binary")
    # A repeated id may bring in more rows than were chosen; the bound holds all the same.
    rows = found.orderBy("order", "label", "features").limit(most).collect()
    return [(r["label"], np.frombuffer(r["features"], "<u4")) for r in rows]


def with_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted."""
    kept = docs.drop("score", "predicted")
    names, at = kept.columns, kept.columns.index("text")
    schema = kept.selectExpr("*", "0D as score", "0 as predicted").schema

    def of_batches(batches):
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*names, "score", "predicted"],
            )

    return kept.mapInArrow(of_batches, schema)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document whether its label is held out, its score, and the predicted label."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return with_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by numpy.

A text is lower-cased, what is no letter becomes one blank, and its runs of 1 to 3 characters are hashed into buckets.
Each bucket has a small vector; the mean over all runs goes into a softmax over the languages of the labelled rows. Both
layers are trained by stochastic gradient descent on a bounded sample (``MOST_DOCS`` labelled documents with the least
hash of their id, each as a whole and as up to ``PIECES`` short pieces, so that short texts are learned as well). A part
of the sample is held back to fit the temperature of the softmax and the least score that is accepted. As both layers
are linear, scoring needs one vector of class scores per bucket: it goes to the tasks, and texts are read where they lie.

Contract: a text that is null, or has no letter, is ``und`` with score 0 and rejected; texts are read whole; without
usable labels everything is ``und``; repeated rows each get their result; extra columns stay out of the way; an empty
table gives no rows. Predictions depend on the text alone.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship

ship(__name__)

# The sample, the buckets of subwords and the length of their vectors.
MOST_DOCS, PIECES, BUCKETS, WIDTH = 3000, 4, 1 << 14, 16
EPOCHS, BATCH, RATE = 6, 32, 0.5
# The share of rightly labelled texts that the threshold may reject.
MOST_REJECTED = 0.001
# Held-back rows at which the threshold is half-way between chance and their quantile.
FEW = 100
UNDETERMINED = "und"
# Characters of a text that are hashed at a time.
BLOCK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def runs_of(codes: np.ndarray, new: int) -> np.ndarray:
    """The buckets of the runs of 1 to 3 code points that end in the last ``new`` places."""
    old = len(codes) - new
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[1:] * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + codes[2:] * np.uint32(0x165667B1)
    runs = np.concatenate([one[old:], two[max(old - 1, 0):], three[max(old - 2, 0):]])
    return (runs ^ (runs >> np.uint32(16))) & np.uint32(BUCKETS - 1)


def blocks(text: str):
    """The buckets of all runs of 1 to 3 characters of a text, blanks at both its ends included, a part of it at a time.

    Parts are cut where there is no letter, and each begins with the last two characters of the one before: what is in memory
    at a time is bounded, but for a single word, and the runs are those of the whole text.
    """
    before, at = np.array([ord(" ")], "<u4"), 0
    first = True
    while at < len(text):
        end = min(at + BLOCK, len(text))
        while end < len(text) and not _NOT_LETTERS.match(text, end, end + 1):
            end += 1
        words = _NOT_LETTERS.sub(" ", text[at:end].lower()).strip()
        at = end
        if words:
            new = np.frombuffer(f"{words} ".encode("utf-32-le", "surrogatepass"), "<u4")
            codes = np.concatenate([before, new])
            yield runs_of(codes, len(codes) if first else len(new))
            before, first = codes[-2:], False
    if first:
        yield runs_of(np.array([ord(" ")] * 2, "<u4"), 2)


def subwords(text: str) -> np.ndarray:
    """``blocks`` of a whole text."""
    return np.concatenate(list(blocks(text)))


def class_scores(text: str, table: np.ndarray) -> np.ndarray:
    """The mean class scores of all runs of a text."""
    total, n = np.zeros(table.shape[1]), 0
    for ids in blocks(text):
        counts = np.bincount(ids, minlength=BUCKETS) if len(ids) > BUCKETS else None
        total += counts @ table if counts is not None else table[ids].sum(axis=0)
        n += len(ids)
    return total / max(n, 1)


def softmax(scores: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    e = np.exp((scores - scores.max(axis=-1, keepdims=True)) / temperature)
    return e / e.sum(axis=-1, keepdims=True)


def examples(docs: DataFrame, most: int = MOST_DOCS) -> list:
    """Rows (lang, order, ids, weights) of the sample: bucket numbers and their shares, for texts and pieces."""
    order = F.xxhash64("doc_id", F.lit(5))
    # Documents of remainder 2 are held out for good.
    usable = docs.where(
        (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
        & F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED) & F.col("text").isNotNull()
    )
    # Only ids are ordered; the texts of the chosen ones are fetched by them. The ids are bounded by ``most``.
    chosen = usable.select("doc_id").distinct().orderBy(order, "doc_id").limit(most)
    rows = usable.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", order.alias("order"), "text")

    def of_batches(batches):
        for batch in batches:
            langs, orders, ids, weights = [], [], [], []
            for lang, at, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rng = np.random.default_rng(at & 0xFFFFFFFF)
                pieces = [text]
                for _ in range(PIECES if len(text) > 60 else 0):
                    length = int(rng.integers(12, 160))
                    start = int(rng.integers(0, max(1, len(text) - length)))
                    pieces.append(text[start:start + length])
                for piece in pieces:
                    if _LETTER.search(piece):
                        counts = sum(np.bincount(ids, minlength=BUCKETS) for ids in blocks(piece))
                        seen = np.flatnonzero(counts)
                        langs.append(lang)
                        orders.append(at)
                        ids.append(seen.astype("<u4").tobytes())
                        weights.append((counts[seen] / counts.sum()).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(orders, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(weights, pa.binary())],
                names=["lang", "order", "ids", "weights"],
            )

    found = rows.mapInArrow(of_batches, "lang string, order bigint, ids binary, weights binary")
    # A repeated id may bring in more rows than were chosen; the bound holds all the same.
    return found.orderBy("order", "lang", "ids").limit(most * (PIECES + 1)).collect()


class Model:
    """Class scores of each bucket, the languages, the temperature and the least accepted score."""

    def __init__(self, table, languages, temperature, threshold):
        self.table, self.languages, self.temperature, self.threshold = table, languages, temperature, threshold

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        share = softmax(class_scores(text, self.table), self.temperature)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def train(rows: list, seed: int = 3) -> Model:
    """Fit both layers on four fifths of the rows, temperature and threshold on the last fifth."""
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model(np.zeros((BUCKETS, 1)), [], 1.0, 1.0)
    rng = np.random.default_rng(seed)
    ids = [np.frombuffer(r["ids"], "<u4").astype(np.int64) for r in rows]
    shares = [np.frombuffer(r["weights"], "<f4") for r in rows]
    label = np.array([languages.index(r["lang"]) for r in rows])
    held = np.array([r["order"] % 5 == 0 for r in rows])
    vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weights = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    fitted = np.flatnonzero(~held)
    steps, done = max(1, EPOCHS * len(fitted) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(fitted)
        for start in range(0, len(fitted), BATCH):
            batch = fitted[start:start + BATCH]
            flat = np.concatenate([ids[i] for i in batch])
            share = np.concatenate([shares[i] for i in batch])[:, None]
            owner = np.repeat(np.arange(len(batch)), [len(ids[i]) for i in batch])
            mean = np.zeros((len(batch), WIDTH), np.float32)
            np.add.at(mean, owner, vectors[flat] * share)
            wrong = softmax(mean @ weights + bias)
            wrong[np.arange(len(batch)), label[batch]] -= 1
            rate = RATE * (1 - done / steps)
            back = wrong @ weights.T
            weights -= rate * (mean.T @ wrong) / len(batch) * 4
            bias -= rate * wrong.mean(axis=0)
            # A bucket moves by its share of a text, which is small: its rate is larger.
            np.add.at(vectors, flat, -rate * 8 * share * back[owner] / len(batch) * 4)
            done += 1
    table = (vectors @ weights + bias).astype(np.float64)
    judged = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    scores = np.array([shares[i] @ table[ids[i]] for i in judged])
    truth = label[judged]

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(scores, t)[np.arange(len(judged)), truth], 1e-12)).mean()

    temperature = float(min(np.geomspace(0.02, 5, 60), key=loss))
    share = softmax(scores, temperature)
    right = share.argmax(axis=1) == truth
    accepted = share.max(axis=1)[right]
    # The quantile of a sample is uncertain by its size: the fewer rows, the nearer the threshold is to chance, but never at it.
    chance, sure = 1 / len(languages), len(accepted) / (len(accepted) + FEW)
    least = float(np.quantile(accepted, MOST_REJECTED)) if len(accepted) else chance
    threshold = chance + sure * (least - chance)
    return Model(table, languages, temperature, min(threshold, 0.5))


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected (in place of columns of these names)."""
    kept = docs.drop("lang_pred", "score", "rejected")
    names, at = kept.columns, kept.columns.index("text")
    schema = kept.selectExpr("*", "'' as lang_pred", "0D as score", "false as rejected").schema

    def of_batches(batches):
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns,
                 pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[0] == UNDETERMINED or f[1] < model.threshold for f in found], pa.bool_())],
                names=[*names, "lang_pred", "score", "rejected"],
            )

    return kept.mapInArrow(of_batches, schema)


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language is rejected; the columns stay as they are, whatever their names."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return with_language(packed, train(examples(docs))).where("not rejected").select("_row.*")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the predicted language, its score, and whether it is rejected."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(examples(docs))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )

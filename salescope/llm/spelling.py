"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters.

A word's letters, counted, are a binary vector with one place for each letter and occurrence. Two words one edit apart have
vectors at a Hamming distance of at most two: one place if a letter was put in or left out, one on each side if a letter was
replaced. Every place is a part of its own, and a signature is the vector without two parts; those that take out anything
but the last occurrence of one letter on either side cannot be shared by such words, so that what is left to enumerate are
the letters themselves and the letters without any one of them. Words that share a signature are equi-joined and verified.

A signature of frequent letters may have many words, anagrams above all. So the key has a second part: with k letters in the
signature, either the first k // 2 or the last k - k // 2 code points of the two words agree, as the edit touches only one
of these stretches. Both keys are put out for each signature, so that no pair is lost, and words meet only if they share
letters and half of their spelling.

The vocabulary is counted in tasks text by text, and put out when a task holds ``MOST_WORDS`` different words; a word in every
document reaches its reducer as one row a task. Keys, and chains of forms, meet by sort-merge join, as the file of words says
too little about their size. A word's chain of forms grows fivefold in occurrences at each step, so that rounds of pointer
doubling follow from the greatest count.

Contract: a null text has no words; in texts of a null id nothing is deleted; texts are read whole, whatever their length; a
word in several rows of one id is counted in each; words of fewer than six code points or five occurrences are left out;
without words there are no rows; extra columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import LOWER, UPPER, ship
from salescope.sources.scratch import materialise

ship(__name__)

# The least code points and occurrences of a word, how much more frequent a form is, and one run in how many
# loses a code point.
LEAST_POINTS, LEAST_COUNT, FORM_TIMES, ONE_IN = 6, 5, 5, 199
# Different words that a task holds before it puts them out.
MOST_WORDS = 200_000
# Characters of a text that are split into words at a time.
BLOCK = 1 << 20
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(UPPER, LOWER)


def counted(text: str) -> Counter:
    """The lower-cased runs of letters of a text, with their numbers."""
    found, at = Counter(), 0
    while at < len(text):
        end = min(at + BLOCK, len(text))
        while end < len(text) and _RUN.match(text, end, end + 1):
            end += 1
        found.update(_RUN.findall(text[at:end].translate(_LOWER)))
        at = end
    return found


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of a document: its runs, of which a hash of id and run makes some lose a code point."""
    found = Counter()
    start = None if doc_id is None else crc32(f"{doc_id}:".encode())
    for run, n in counted(text or "").items():
        if start is not None and len(run) >= LEAST_POINTS:
            h = crc32(run.encode(), start)
            if h % ONE_IN == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_POINTS:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all documents that occur ``least`` times or more."""

    def of_batches(batches):
        held = Counter()

        def put_out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(words_of(doc_id, text.as_py()))
                if len(held) >= MOST_WORDS:
                    yield put_out()
        yield put_out()

    words = docs.select("doc_id", "text").mapInArrow(of_batches, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def signatures(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of words of one length, given as rows of code points, and the row of each key.

    A bag of letters is the sum of its letters' hashes, so that leaving out a letter is one subtraction. Keys that agree by
    chance only bring words together that verification parts again.
    """
    rows, length = codes.shape
    letters = np.sort(codes, axis=1).astype(np.uint64)
    hashes = _mixed(letters * np.uint64(0x9E3779B97F4A7C15))
    first = np.ones(codes.shape, bool)
    first[:, 1:] = letters[:, 1:] != letters[:, :-1]
    whole = hashes.sum(axis=1)
    row, at = np.nonzero(first)
    keys, owners = [], []
    for left, bags, own in ((length, whole, np.arange(rows)), (length - 1, whole[row] - hashes[row, at], row)):
        half = left // 2
        # Code points by their place from the start, and from the end, of the half.
        for side, part in ((1, codes[:, :half]), (2, codes[:, length - (left - half):])):
            spelled = np.full(rows, side, np.uint64)
            for column in part.T:
                spelled = _mixed(spelled * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
            keys.append(_mixed(bags ^ (spelled[own] + np.uint64(left))).view(np.int64))
            owners.append(own)
    return np.concatenate(keys), np.concatenate(owners)


def keyed(words: DataFrame) -> DataFrame:
    """(key, word, n): each word once for each of its signatures and halves."""

    def of_batches(batches):
        for batch in batches:
            word, n = batch.column(0), batch.column(1)
            texts = word.to_pylist()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                codes = "".join(texts[i] for i in rows).encode("utf-32-le", "surrogatepass")
                keys, owners = signatures(np.frombuffer(codes, "<u4").reshape(len(rows), length))
                owners = pa.array(rows[owners])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), word.take(owners), n.take(owners)], names=["key", "word", "n"]
                )

    return words.select("word", "n").mapInArrow(of_batches, "key bigint, word string, n bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of words one edit apart, in both directions."""
    # Both sides are the same frame, so that it is worked out and shuffled once. Without the hint Spark would take the keys
    # to be as small as the file of words, of which each has some 16 rows here, and send them all through the driver.
    keys = keyed(words)
    a, b = keys.alias("a"), keys.alias("b")
    met = a.join(b.hint("merge"), F.col("a.key") == F.col("b.key")).where(
        (F.col("a.word") < F.col("b.word")) & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    met = met.select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
    # A pair may share several keys.
    once = met.distinct()
    sides = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return once.select(F.inline(sides))


def with_forms(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's form is its most frequent near word, if that is ``times`` as frequent."""
    # Of equal counts the smallest word wins: the largest count and the smallest word are one minimum.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    near = near.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
    joined = words.join(near, "word", "left")
    enough = F.col("form_n") >= times * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )


def roots(forms: DataFrame, most: int, times: int = FORM_TIMES) -> DataFrame:
    """(word, root): for the words that have a form, the last of their chain of forms.

    Each step of a chain multiplies the count by ``times``, and no count is above ``most``: that bounds the steps, and each
    round doubles those done.
    """
    steps = max(1, math.ceil(math.log(max(most, times), times)))
    found = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        found = materialise(found, "roots")
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        # Spark knows only the bytes of the file, of which the rows in memory take several times as many.
        found = found.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return found


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words."""
    words = materialise(vocabulary(docs), "words")
    most = words.agg(F.max("n")).first()[0] or 0
    forms = materialise(with_forms(words), "forms")
    joined = forms.join(roots(forms, most), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word its form, the root of its chain of forms, its count, its near words, and the count of its form."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Periodic runs of words, by an online sparse dynamic program over diagonals.

A diagonal is a lag: it is alive at a word if the word equals the one so many places before. The program passes over the
words of a text once; each word lengthens the diagonals that go on, ends the others, and its earlier occurrences start new
ones. A diagonal that ends with enough matches is a run, which is put out at once.

What keeps it sparse is that an earlier occurrence counts only if the words before it agree as well. A run of period q has
at least max(24, 3 q) words, hence at least 16 matches on its diagonal and at least 2 q. So lags up to 15 start where 8
words agree, and lags from g to 2 g - 1 where g words do, for g = 16, 32, ... Stretches of g words that have a period of
g / 2 or less start nothing: a run made of such stretches alone has that smaller period itself, which is another lag. The
other stretches occur at most a few times within g places, so that a text of n words costs n log n steps, be it one word
a million times over. Numbers of equal stretches come from those of half the length; each pair is told from the words
themselves, never from a hash alone.

Contract: a null text, or one without words, has no runs and collapses to the empty text (null stays null); a run is
maximal, its period the smallest one, its length at least max(24, 3 periods); texts are read whole, one at a time; repeated
rows each get their result; extra columns stay, but for ``runs`` and ``collapsed``, which are replaced; an empty table gives
no rows. Null ids get a result, and nothing is planted in their texts.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import BLANKS, blank_words, ship, text_of

ship(__name__)

# The least words of a run, and how many periods it has at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# Words that must agree before a lag of less than twice as many is followed.
BASE = 8
# Bytes of a text that are split into words at a time.
BLOCK = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BLANKS = BLANKS.encode()


def word_ids(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers in order of first occurrence, and the distinct words."""
    known: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw) and raw[end] not in _BLANKS:
            end += 1
        words = raw[at:end].split()
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
        at = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(known)


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only."""
    pairs = left.astype(np.int64) * (int(right.max()) + 1) + right
    return np.unique(pairs, return_inverse=True)[1]


def _may_repeat(ids: np.ndarray) -> bool:
    """Whether ``BASE`` words occur twice, judged by hashes: a quick no for most texts, never a wrong one."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    mixed ^= mixed >> np.uint64(29)
    step = 1
    while step < BASE:
        mixed = mixed[:-step] * np.uint64(0xBF58476D1CE4E5B9) + mixed[step:]
        mixed ^= mixed >> np.uint64(31)
        step *= 2
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def _starts(ids: np.ndarray) -> dict[int, list[int]]:
    """Where diagonals begin to be followed: for the last word of agreeing stretches, the lags."""
    n, places, lags = len(ids), [], []

    def add(at: np.ndarray, lag: np.ndarray) -> None:
        places.append(at)
        lags.append(lag)

    # same[i] numbers the stretch of ``length`` words that starts at word i.
    same, length = ids, 1
    while length < BASE:
        same = _numbered(same[:-length], same[length:])
        length *= 2
    for lag in range(1, min(2 * BASE, len(same))):
        at = np.flatnonzero(same[lag:] == same[:-lag]) + lag
        add(at + length - 1, np.full(len(at), lag))
    # Once all stretches differ, all longer ones do.
    while LEAST_PERIODS * 2 * length <= n and int(same.max()) + 1 < len(same):
        half, half_length = same, length
        same = _numbered(half[:-length], half[length:])
        length *= 2
        # The nearest earlier occurrence of the last half of each stretch.
        order = np.argsort(half, kind="stable")
        nearest = np.full(len(half), n, np.int64)
        again = half[order[1:]] == half[order[:-1]]
        nearest[order[1:][again]] = (order[1:] - order[:-1])[again]
        first = np.arange(len(same))
        lag = nearest[first + half_length]
        short = lag <= half_length
        inner = first[short]
        # With this lag between both of its halves' ends, the whole stretch has the lag as its period.
        periodic = np.zeros(len(same), bool)
        periodic[inner] = half[inner] == half[inner + lag[short]]
        order = np.argsort(same, kind="stable")
        back, left = 1, True
        while left and back < len(order):
            alike = same[order[back:]] == same[order[:-back]]
            apart = order[back:] - order[:-back]
            # Occurrences of a stretch that is not periodic are far apart, so that few steps back leave the range of lags.
            near = alike & (apart < 2 * length) & ~periodic[order[back:]]
            left = bool(near.any())
            near &= apart >= length
            add(order[back:][near] + length - 1, apart[near])
            back += 1
    at, lag = np.concatenate(places), np.concatenate(lags)
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    # A lag that was started at the word before goes on by itself.
    fresh = np.ones(len(at), bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    found: dict[int, list[int]] = {}
    for i, k in zip(at[fresh].tolist(), lag[fresh].tolist()):
        found.setdefault(i, []).append(k)
    return found


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    n = len(ids)
    if n < LEAST_WORDS or not _may_repeat(ids):
        return []
    starts = _starts(ids)
    words, runs, matches = array("i", ids.tobytes()), [], {}

    def put_out(ended: list[int], at: int) -> None:
        """Runs of the diagonals that matched up to the word before ``at``; a multiple of a run's period is none."""
        firsts = set()
        for lag in sorted(ended):
            length = matches.pop(lag) + lag
            if length >= max(LEAST_WORDS, LEAST_PERIODS * lag) and at - length not in firsts:
                firsts.add(at - length)
                runs.append((at - length, length, lag))

    queue, next_start = sorted(starts), 0
    i = queue[0] if queue else n
    while i < n:
        word, ended = words[i], []
        for lag in matches:
            if words[i - lag] == word:
                matches[lag] += 1
            else:
                ended.append(lag)
        if ended:
            put_out(ended, i)
        if next_start < len(queue) and queue[next_start] == i:
            next_start += 1
            for lag in starts[i]:
                if lag not in matches:
                    k = i
                    while k >= lag and words[k] == words[k - lag]:
                        k -= 1
                    if k < i:
                        matches[lag] = i - k
        # Without a living diagonal nothing happens before the next start.
        i = i + 1 if matches or next_start >= len(queue) else queue[next_start]
        if not matches and next_start >= len(queue):
            break
    put_out(list(matches), n)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(raw: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    """The runs of a text, and its words joined by one blank, without those that any run repeats."""
    ids, words = word_ids(raw)
    runs = find_runs(ids)
    if runs:
        kept = np.ones(len(ids), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        ids = ids[kept]
    return runs, b" ".join(map(words.__getitem__, array("i", ids.tobytes())))


def with_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs`` and the ``collapsed`` text."""
    kept = docs.drop("runs", "collapsed")
    names, at = kept.columns, kept.columns.index("text")
    schema = kept.select("*", F.lit(None).cast(RUNS).alias("runs"), F.lit(None).cast("string").alias("collapsed")).schema
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def of_batches(batches):
        for batch in batches:
            done = []
            for text in batch.column(at):
                value = text.as_py()
                runs, rest = collapsed((value or "").encode())
                done.append((runs, None if value is None else rest.decode()))
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in d[0]] for d in done], run_type)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, runs, pa.array([d[1] for d in done], pa.string())], names=[*names, "runs", "collapsed"]
            )

    return kept.mapInArrow(of_batches, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a run planted at the end of the texts whose id's crc32 is divisible by ten; other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.withColumn("_h", h).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, blank_words(text_of())).otherwise(F.array().cast("array<string>"))
    )
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    docs = docs.withColumn("_a", F.when(n > 0, F.pmod(g, n)).cast("int"))
    docs = docs.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.pmod(g, F.lit(8))))).cast("int"))
    period, rest = F.slice("_words", F.col("_a") + 1, F.col("_p")), n - F.col("_a")
    whole = F.flatten(F.array_repeat(period, F.ceil(rest / F.col("_p")).cast("int")))
    planted = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(whole, F.lit(1), rest))
    text = F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return docs.withColumn("text", text).drop("_h", "_words", "_a", "_p")


def _greatest(runs: Column) -> Column:
    """The run with the greatest length by period, compared as whole numbers; of equal ones the first."""

    def later(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, nothing, later)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of runs, the one with the greatest exponent, and digests of all runs and of what is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_runs(with_planted_runs(docs)).withColumn("_top", _greatest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_top.start", "_top.length", "_top.period",
        F.floor(1000 * F.col("_top.length") / F.col("_top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )

"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering.

Statistics of each text are built-in expressions. On a bounded number of labelled rows (``MOST_LABELS``, those with the
least hash of their id), rules for poor texts are grown one after the other: a conjunction takes the condition that
gains most, until it is precise; it is pruned on rows it was not grown on; rows it covers leave. The list becomes one
ordered conditional expression, so that the verdict is worked out where the text is read.

Contract: a null or empty text has no words, fails the base rule and is not kept; labels that are null, or of ids that
no document has, teach nothing; without labels the list is empty and keeps; repeated rows each get their result; very
long texts are read whole; extra columns stay out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import blank_words, text_of, with_run_hashes

# The most labelled rows the list is learned from; they go to the driver as statistics only.
MOST_LABELS = 20_000
# Conditions of a rule, rules of a list, rows a rule must cover, and its least precision on rows apart.
MOST_CONDITIONS, MOST_RULES, LEAST_ROWS, LEAST_PRECISION = 3, 12, 8, 0.9
# Thresholds tried for a statistic.
MOST_THRESHOLDS = 64
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share")


def with_base(docs: DataFrame) -> DataFrame:
    """``doc_id`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what the statistics need."""
    text = text_of()
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(F.translate(line, "\t\x0b\x0c\r", "    ")) != "")
    rows = docs.select(
        "doc_id",
        blank_words(text).alias("_words"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("_upper"),
        F.regexp_count(text, F.lit("[!?]")).alias("_marks"),
    )
    rows = rows.select(
        "doc_id", "n_symbols", "_upper", "_marks", "_words",
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
    )
    rows = with_run_hashes(rows, "_words", {"_threes": 3})
    # Most texts repeat no three words. In the others, runs are sorted by hash and compared with those next to them.
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_threes")) < F.size("_threes"),
        F.array_sort(F.transform("_threes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    n = F.size("_sorted")
    ahead = F.zip_with("_sorted", F.slice("_sorted", F.lit(2), n), lambda a, b: a["h"] == b["h"])
    rows = rows.withColumn("_same", ahead)
    behind = F.concat(F.array(F.lit(False)), F.slice("_same", F.lit(1), n - 1))
    twice = F.zip_with("_same", behind, lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
    starts = F.zip_with("_sorted", twice, lambda s, again: F.when(again, s["i"]))
    rows = rows.withColumn("_starts", F.array_sort(F.array_compact(starts)))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("_starts", start, lambda s, i: F.struct(
        (i + 3).alias("end"), (s["n"] + F.least(i + 3 - s["end"], F.lit(3))).alias("n")
    ))
    return rows.select(
        "doc_id", F.size("_words").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered["n"], F.lit(0)).cast("bigint").alias("n_repeat_words"), "_upper", "_marks", "_n_lines",
    )


def with_statistics(base: DataFrame) -> DataFrame:
    """Add the shares that rules are made of; a share of nothing is 0."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0))

    return base.withColumns({
        "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "_n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("_upper", "word_chars"),
        "mark_share": share("_marks", "n_words"),
    }).drop("_upper", "_marks", "_n_lines")


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.statistic] > self.threshold if self.above else row[self.statistic] <= self.threshold

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


def _counts(rule: list[Condition], rows: list[dict]) -> tuple[int, int]:
    """Poor and good rows that a rule covers."""
    covered = [r["poor"] for r in rows if all(c.holds(r) for c in rule)]
    return sum(covered), len(covered) - sum(covered)


def _best_condition(rows: list[dict]) -> Condition | None:
    """The condition with the largest gain of information on the rows it leaves, times the poor rows it keeps."""
    poor, best, gained = sum(r["poor"] for r in rows), None, 0.0
    if not poor or poor == len(rows):
        return None
    before = math.log2(poor / len(rows))
    for name in STATISTICS:
        values = sorted((r[name], r["poor"]) for r in rows)
        # One pass over the sorted values: p poor ones of i + 1 rows lie at or below values[i].
        p, step = 0, max(1, len(values) // MOST_THRESHOLDS)
        for i, (value, is_poor) in enumerate(values[:-1]):
            p += is_poor
            if value == values[i + 1][0] or (i % step and is_poor == values[i + 1][1]):
                continue
            for above, kept, n in ((False, p, i + 1), (True, poor - p, len(values) - i - 1)):
                if kept and (gain := kept * (math.log2(kept / n) - before)) > gained + 1e-9:
                    best, gained = Condition(name, above, float(value)), gain
    return best


def learn(rows: list[dict]) -> list[list[Condition]]:
    """Rules for poor rows, in order. Two of three rows grow a rule, the third prunes and judges it."""
    grow, judge, rules = [r for r in rows if r["part"]], [r for r in rows if not r["part"]], []
    while len(rules) < MOST_RULES:
        rule, left = [], grow
        while len(rule) < MOST_CONDITIONS and (found := _best_condition(left)):
            rule.append(found)
            left = [r for r in left if found.holds(r)]
        if not rule:
            return rules
        worth = {k: (p - n) / (p + n) if (p + n) else -1.0 for k in range(1, len(rule) + 1)
                 for p, n in [_counts(rule[:k], judge)]}
        rule = rule[:max(worth, key=lambda k: (worth[k], -k))]
        p, n = _counts(rule, judge)
        if p + n < LEAST_ROWS or p < LEAST_PRECISION * (p + n):
            return rules
        rules.append(rule)
        grow, judge = ([r for r in part if not all(c.holds(r) for c in rule)] for part in (grow, judge))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as an ordered conditional: the first rule that holds rejects, what no rule covers is kept."""
    if not rules:
        return F.lit(True)
    ordered = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        ordered = F.when(holds, False) if ordered is None else ordered.when(holds, False)
    return ordered.otherwise(True)


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> list[dict]:
    """Statistics of the labelled documents with the least hashes, at most ``most`` of them."""
    order = F.xxhash64("doc_id", F.lit(11))
    chosen = labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
    chosen = chosen.orderBy(order, "doc_id", "quality").limit(most)
    rows = with_statistics(with_base(docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")))
    rows = rows.join(F.broadcast(chosen), "doc_id").select(
        *STATISTICS, (F.col("quality") == 0).cast("int").alias("poor"),
        (F.pmod(order, F.lit(3)) > 0).alias("part"), order.alias("_order"),
    )
    # No document may bring in more rows than are labelled, however often it is repeated.
    return [r.asDict() for r in rows.orderBy("_order", *STATISTICS).limit(most).collect()]


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its base statistics, the base rule, and the verdict of the learned list."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = learn(labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return with_statistics(with_base(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )

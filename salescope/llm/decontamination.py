"""Benchmark decontamination: windows of test words in a hash set, looked up at every word of the training texts.

The windows of the benchmark are hashed. As long as they are few (``SET_WINDOWS``), the set of hashes goes to every task
and each text is scanned where it lies: the hash of ten words in a row is put together from hashes of 1, 2, 4 and 8
words, and only hits leave the row. A larger benchmark meets the text windows in a shuffled join instead, with the same
result. Hits are verified on the words themselves.

Contract: a null or empty text has no words and no hits, as has an item without words; extra columns stay out of the
way; repeated rows each get their result (documents are told apart by id and text); a null id is an id like any other;
an item with a null id hits, but is not counted among the items; very long texts are scanned whole, in one row; empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import item_words, text_of, with_run_hashes
from salescope.sources.scratch import materialise

# Words of a window.
WINDOW = 10
# The most windows whose hashes are given to every task (8 bytes each).
SET_WINDOWS = 50_000


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (number, check, hash, length, words, item_id), one per window and item; items of fewer words are a window as a
    whole. ``number`` and ``check`` name the window. Written once: the windows and their items are read apart."""
    items = benchmark.select("item_id", item_words(text_of()).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    found = items.select(
        F.col("item_id").cast("string").alias("item_id"),
        length.alias("length"),
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size("words") - length + 1),
            lambda i: F.array_join(F.slice("words", i, length), " "),
        )).alias("words"),
    ).distinct()
    runs = {f"_of{n}": n for n in range(1, window + 1)}
    hashed = with_run_hashes(found.withColumn("_words", F.split("words", " ")), "_words", runs)
    own = F.coalesce(*[F.when(F.col("length") == n, F.element_at(name, 1)) for name, n in runs.items()])
    number, check = (F.xxhash64("words", F.lit(seed)) for seed in (71, 72))
    rows = hashed.select(number.alias("number"), check.alias("check"), own.alias("hash"), "length", "words", "item_id")
    return materialise(rows, "benchmark-windows")


def _place_if(length: int, known: list[int] | None):
    """The place of a window by its hash and start, or null if the hash is not among the known ones."""

    def place(h: Column, i: Column) -> Column:
        words = F.array_join(F.slice("_words", i + 1, length), " ")
        found = F.struct(i.alias("start"), F.lit(length).alias("length"), h.alias("hash"), words.alias("words"))
        return found if known is None else F.when(h.isin(known), found)

    return place


def hits(docs: DataFrame, windows: DataFrame, set_windows: int = SET_WINDOWS) -> DataFrame:
    """One row per document and verified place of a window: doc_id, text_key, n_words, start, length, number, check.

    Every document also has one row whose start is null, so that none is lost.
    """
    # Without their items, of which one window may have any number.
    windows = windows.select("number", "check", "hash", "length", "words").distinct()
    # Lengths (at most the window's) and, within the bound, hashes: the only things that reach the driver.
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    few = windows.limit(set_windows + 1).count() <= set_windows
    known = {n: [] for n in lengths}
    if few:
        for n, h in windows.select("length", "hash").distinct().collect():
            known[n].append(h)
    words = docs.select(
        "doc_id", F.xxhash64(text_of()).alias("text_key"), item_words(text_of()).alias("_words")
    )
    runs = {f"_of{n}": n for n in lengths}
    words = with_run_hashes(words, "_words", runs)
    places = F.array(F.struct(F.lit(None).cast("int").alias("start"), F.lit(0).alias("length"),
                              F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("string").alias("words")))
    for name, n in runs.items():
        found = F.transform(name, _place_if(n, known[n] if few else None))
        places = F.concat(places, F.array_compact(found))
    scanned = words.select("doc_id", "text_key", F.size("_words").alias("n_words"), F.explode(places).alias("_at"))
    scanned = scanned.select("doc_id", "text_key", "n_words", "_at.*")
    found = scanned.join(F.broadcast(windows) if few else windows, ["hash", "length", "words"], "left")
    return found.where(F.col("start").isNull() | F.col("number").isNotNull()).drop("hash", "words")


def hit_counts(found: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit (words in any place), item_ids, places (distinct, by start).

    ``found`` are the hits of ``windows``. Items meet the distinct windows of each document in a shuffled join.
    """
    window = F.when(F.col("start").isNotNull(), F.struct("number", "check"))
    place = F.when(F.col("start").isNotNull(), F.struct("start", "length"))
    grouped = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.sum(F.when(F.col("start").isNull(), 1).otherwise(0)).alias("_copies"),
        F.array_sort(F.collect_set(place)).alias("places"),
        F.collect_set(window).alias("_windows"),
    )
    # One thin row per document, read twice below: the texts are scanned once.
    grouped = materialise(grouped, "hit-counts")
    named = grouped.select("doc_id", "text_key", F.inline("_windows"))
    items = named.join(windows.select("number", "check", "item_id"), ["number", "check"]).groupBy("doc_id", "text_key")
    items = items.agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    items = items.withColumnsRenamed({"doc_id": "_item_doc", "text_key": "_item_key"})
    same = grouped["doc_id"].eqNullSafe(items["_item_doc"]) & (grouped["text_key"] == items["_item_key"])
    none = F.array().cast("array<string>")
    grouped = grouped.join(items, same, "left").withColumn("item_ids", F.coalesce("item_ids", none))
    grouped = grouped.drop("_windows", "_item_doc", "_item_key")
    # Places come by start: each adds what reaches beyond the furthest end so far.
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("places", start, lambda s, p: F.struct(
        F.greatest(s["end"], p["start"] + p["length"]).alias("end"),
        (s["n"] + F.greatest(p["start"] + p["length"] - F.greatest(s["end"], p["start"]), F.lit(0))).alias("n"),
    ))
    counted = grouped.withColumn("n_hit", covered["n"].cast("bigint"))
    return counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")


def remove_documents(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.0, **kwargs) -> DataFrame:
    """``docs`` without those of which more than ``max_share`` of the words are hit. Columns stay as they are."""
    windows = benchmark_windows(benchmark)
    counts = hit_counts(hits(docs, windows, **kwargs), windows)
    bad = counts.where((F.col("n_hit") > 0) & (F.col("n_hit") > max_share * F.col("n_words")))
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_bad_key"])
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, **kwargs) -> DataFrame:
    """``docs`` with the hit words, and what stands between them, cut out of ``text``. Columns stay as they are."""
    windows = benchmark_windows(benchmark)
    counts = hit_counts(hits(docs, windows, **kwargs), windows).where("n_hit > 0")
    found = counts.select(
        F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key"), F.col("places").alias("_places")
    ).dropDuplicates(["_hit_id", "_hit_key"])
    same = docs["doc_id"].eqNullSafe(found["_hit_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_hit_key"]
    )
    joined = docs.join(found, same, "left")
    # Odd pieces are words: pieces[k] stands before word k, and words[k] is its text in the original case.
    pattern = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    gaps = F.split("text", pattern, -1)
    words = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    hit = F.array_distinct(F.flatten(F.transform(
        "_places", lambda p: F.sequence(p["start"], p["start"] + p["length"] - 1)
    )))
    kept = F.zip_with(gaps, words, lambda gap, word: F.struct(gap.alias("gap"), word.alias("word")))
    kept = F.transform(kept, lambda x, i: F.struct(x["gap"].alias("gap"), x["word"].alias("word"), i.alias("i")))
    kept = F.array_join(F.transform(kept, lambda x: F.when(
        F.array_contains(hit, x["i"]), F.when(F.array_contains(hit, x["i"] - 1), F.lit("")).otherwise(x["gap"])
    ).otherwise(F.concat(x["gap"], F.coalesce(x["word"], F.lit(""))))), "")
    text = F.when(F.col("_places").isNull(), F.col("text")).otherwise(kept)
    return joined.withColumn("text", text).select(*[joined[c] for c in docs.columns if c != "text"], "text").select(
        *docs.columns
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its words, hit words and benchmark items found in it."""
    windows = benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return hit_counts(hits(docs, windows), windows).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# The words of a text and the nine after each, the windows made of them, and the places of those of the benchmark.
_AHEAD = ", ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, 10)]])
OP4_SQL = rf"""
WITH item AS (
  SELECT item_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
doc AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_word AS (
  SELECT item_id, r, least(len(w), 10) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS s FROM item),
doc_word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS s FROM doc),
item_ahead AS (SELECT item_id, n, [{_AHEAD}] AS ahead FROM item_word WINDOW o AS (PARTITION BY r ORDER BY s)),
doc_ahead AS (SELECT r, s, [{_AHEAD}] AS ahead FROM doc_word WINDOW o AS (PARTITION BY r ORDER BY s)),
win AS (SELECT DISTINCT item_id, n, array_to_string(ahead[1:n], ' ') AS t FROM item_ahead WHERE ahead[n] IS NOT NULL),
place AS (
  SELECT r, s, n, array_to_string(ahead[1:n], ' ') AS t
  FROM doc_ahead, (SELECT DISTINCT n FROM win) WHERE ahead[n] IS NOT NULL),
hit AS (SELECT r, s, place.n, item_id FROM place JOIN win USING (t, n)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(i) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

"""Repeated passages by a depth-limited radix sort of suffixes.

Two suffixes matter only if they agree in their first ``WINDOW`` bytes, so suffixes are sorted no deeper than that, most
significant digit first, and a suffix leaves as soon as nothing shares its digits so far. At the end, equal groups are
exactly the repeated windows; in each, the least document keeps the bytes.

The first digit must spread all suffixes over the cluster, and nearly all of them should leave there. It is the window's
least hash of ``GRAM`` bytes: equal windows have equal ones, and neighbouring windows mostly share theirs, so that the
suffixes travel as runs of windows (fragments) instead of one by one.

1. For each block of documents, the distinct first digits go to cells, which tell each block those that stand in a
   second text. Whole copies of a text count as one text.
2. Blocks send the fragments with these digits, once for all documents of the block. Equal fragments are one to begin with.
3. Fragments go once, with the places they come from, to cells in proportion to the windows found. Equal ones collapse
   there, windows are sorted by the further digits, eight bytes at a time, and each place is told the least document of
   each of its windows. A digit with very many windows is not sorted in one task: they are grouped by a shuffle of their own.
   A long run of one digit, such as a repeated pattern, is cut into fragments of ``MOST_WINDOWS`` windows.
4. What starts in a document with a smaller id than one's own is removed.

Contract: a null text is empty; texts are read whole as UTF-8 bytes, one at a time, and matches never cross documents; a
text shorter than a window keeps all its bytes; ids are whole numbers; a row without an id neither removes nor loses anything; rows that share an
id do not remove from each other; repeated rows each get their result; extra columns stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship
from salescope.llm.minhash import mixed
from salescope.sources.scratch import discard, materialise

ship(__name__)

# Bytes of a repeated window, and of the grams whose least hash is the first digit.
WINDOW, GRAM = 50, 16
# Bytes of text in a block, windows of a fragment and, about, of a cell, and windows of a digit that one task sorts.
BLOCK_BYTES, MOST_WINDOWS, CELL_WINDOWS, HOT_WINDOWS = 8_000_000, 4096, 1_000_000, 2_000_000
# Fragments whose lost stretches are found at a time.
ROWS_AT_ONCE = 500
# Bits of a digit that go to its cell's members; further bits name the cell.
_LOW_BITS = 32


def first_digits(data: np.ndarray) -> np.ndarray:
    """For each window of a text its least gram hash."""
    if len(data) < WINDOW:
        return np.zeros(0, np.uint64)
    hashes, size = data.astype(np.uint64) + np.uint64(1), 1
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + hashes[size:]
        size *= 2
    least, have, want = mixed(hashes), 1, WINDOW - GRAM + 1
    while have * 2 <= want:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:len(least) - (want - have)], least[want - have:])


def runs_of(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal digits."""
    if not len(digits):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(digits[1:] != digits[:-1]) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(digits)]])


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def least_documents(pieces: list[bytes], digits: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each piece, one after the other, the least document of a piece that has it too; and its piece.

    The radix sort: windows start in groups by ``digits``; each pass splits the groups by eight more bytes, and windows
    whose group has one document only drop out.
    """
    lengths = np.array([len(p) for p in pieces])
    counts = lengths - WINDOW + 1
    data = np.frombuffer(b"".join(pieces) + b"\0" * 8, np.uint8)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(pieces)), counts)
    starts = np.arange(ends[-1])
    starts += (np.cumsum(lengths) - lengths - (ends - counts))[owner]
    least = documents[owner]
    alive, group = np.arange(len(owner)), digits[owner]
    # The last digit overlaps the one before, as windows are no multiple of eight bytes.
    for offset in [-1, *range(0, WINDOW - 8, 8), WINDOW - 8]:
        if offset < 0:
            order = np.argsort(group, kind="stable")
            group = group[order]
            new = np.concatenate([[True], group[1:] != group[:-1]])
        else:
            at = starts[alive] + offset
            digit = np.zeros(len(alive), np.uint64)
            for i in range(8):
                digit = (digit << np.uint64(8)) | data[at + i]
            order = np.lexsort((digit, group))
            digit, group = digit[order], group[order]
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        alive = alive[order]
        first = np.flatnonzero(new)
        documents_of = documents[owner[alive]]
        low, high = np.minimum.reduceat(documents_of, first), np.maximum.reduceat(documents_of, first)
        number = np.cumsum(new) - 1
        stay = (low != high)[number]
        if offset == WINDOW - 8:
            least[alive[stay]] = low[number[stay]]
        alive, group = alive[stay], number[stay]
        if not len(alive):
            break
    return least, owner


def lost_spans(
    ids: np.ndarray, of_row: np.ndarray, starts: np.ndarray, counts: np.ndarray, runs: np.ndarray, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, start, end) of each maximal stretch of windows that a place of a fragment loses.

    Fragment by fragment, ``ids`` and ``starts`` are its ``of_row`` places; ``counts`` and ``least`` its ``runs`` runs of
    windows with their least documents. A stretch starts at a run for the documents above its least one that are not
    above that of the run before, and ends likewise: both are a range of the fragment's places by document, so that places
    and runs meet only where there is a stretch.
    """
    values, ranks = np.unique(np.concatenate([ids, least]), return_inverse=True)
    base, ranks, low = len(values) + 1, ranks[:len(ids)], ranks[len(ids):]
    keys = np.repeat(np.arange(len(of_row)), of_row) * base + ranks
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    own = np.repeat(np.arange(len(runs)), runs) * base
    opening = np.unique(own, return_index=True)[1]
    border = opening[1:]
    # Before the first run of a fragment and after its last one nothing is lost.
    before, after = np.append(base - 1, low[:-1]), np.append(low[1:], base - 1)
    before[border], after[border - 1] = base - 1, base - 1
    above = np.searchsorted(keys, own + low, "right")

    def edges(beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.maximum(np.searchsorted(keys, own + beside[:len(own)], "right") - above, 0)
        run = np.repeat(np.arange(len(n)), n)
        at = above[run] + np.arange(len(run)) - (np.cumsum(n) - n)[run]
        by_place = np.lexsort((run, at))
        return at[by_place], run[by_place]

    (at, first), (_, last) = edges(before), edges(after)
    # Where each run ends among the windows of its fragment.
    ends = np.cumsum(counts)
    ends -= np.repeat((ends - counts)[opening], runs[runs > 0])
    place = order[at]
    return place, starts[place] + (ends - counts)[first], starts[place] + ends[last] + WINDOW - 1


def _sizes(docs: DataFrame) -> tuple[int, int]:
    """Numbers of blocks and cells, both in proportion to the bytes of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, total // BLOCK_BYTES)
    return blocks, 256 * (1 << max(0, (blocks // 1024).bit_length()))


def _shared_digits(docs: DataFrame, cells: int) -> DataFrame:
    """(block, cell, digits): of each block's first digits those that stand in another text, too."""
    bits = cells.bit_length() - 1

    def send(batches):
        for batch in batches:
            found = {}
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                digits = first_digits(text_bytes(raw))
                if len(digits):
                    mark = xxhash.xxh3_64_intdigest(raw.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF
                    own = np.unique(digits[runs_of(digits)[0]] >> np.uint64(64 - bits - _LOW_BITS))
                    found.setdefault(block, []).append((mark, own))
            rows = []
            for block, parts in found.items():
                digits = np.concatenate([d for _, d in parts])
                marks = np.repeat(np.array([m for m, _ in parts], np.uint64), [len(d) for _, d in parts])
                cell = (digits & np.uint64(cells - 1)).astype(np.int64)
                order = np.argsort(cell, kind="stable")
                digits, marks, cell = digits[order] >> np.uint64(bits), marks[order], cell[order]
                for start, end in zip(*runs_of(cell.astype(np.uint64))):
                    rows.append((block, int(cell[start]), digits[start:end].astype("<u4").tobytes(),
                                 marks[start:end].astype("<u4").tobytes()))
            names = ["block", "cell", "digits", "marks"]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names
            )

    def meet(table: pa.Table) -> pa.Table:
        """The digits of a cell that come with two marks, for each block that has them."""
        parts = [np.frombuffer(x, "<u4") for x in table.column("digits").to_pylist()]
        marks = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("marks").to_pylist()])
        digits, block = np.concatenate(parts), np.repeat(table.column("block").to_numpy(), [len(p) for p in parts])
        order = np.argsort(digits, kind="stable")
        digits, marks, block = digits[order], marks[order], block[order]
        first = runs_of(digits.astype(np.uint64))[0]
        number = np.cumsum(np.concatenate([[True], digits[1:] != digits[:-1]])) - 1
        shared = (np.minimum.reduceat(marks, first) != np.maximum.reduceat(marks, first))[number]
        digits, block = digits[shared], block[shared]
        order = np.argsort(block, kind="stable")
        digits, block = digits[order], block[order]
        blocks, found = [], []
        for start, end in zip(*runs_of(block.astype(np.uint64))):
            blocks.append(int(block[start]))
            found.append(np.unique(digits[start:end]).tobytes())
        cell = table.column("cell")[0].as_py()
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "cell": pa.array([cell] * len(blocks), pa.int64()),
            "digits": pa.array(found, pa.binary()),
        })

    sent = docs.select("block", "text").mapInArrow(send, "block bigint, cell bigint, digits binary, marks binary")
    return sent.groupBy("cell").applyInArrow(meet, "block bigint, cell bigint, digits binary")


def _fragments(docs: DataFrame, shared: DataFrame, copies: DataFrame, cells: int) -> DataFrame:
    """(digit, bytes, doc_ids, text_keys, starts) of the distinct fragments of each block whose digit is shared.

    ``copies``: (block, row keys) of the documents that repeat a text as a whole; they are left out.
    """
    bits = cells.bit_length() - 1
    told = shared.select("block", "cell", "digits", F.lit(None).cast("array<bigint>").alias("copies")).union(
        copies.select("block", F.lit(-1).cast("bigint"), F.lit(None).cast("binary"), "copies")
    )
    schema = "digit bigint, bytes binary, doc_ids array<bigint>, text_keys array<bigint>, starts array<int>"

    def of_block(texts: pa.Table, told: pa.Table) -> pa.Table:
        known, gone = [np.zeros(0, np.uint64)], set()
        for cell, digits, copied in zip(*(told.column(n).to_pylist() for n in ("cell", "digits", "copies"))):
            if digits is not None:
                known.append((np.frombuffer(digits, "<u4").astype(np.uint64) << np.uint64(bits)) | np.uint64(cell))
            gone.update(copied or ())
        known = np.sort(np.concatenate(known))
        found, seen = {}, set()
        columns = ("row_key", "doc_id", "text_key", "text")
        for row, doc, key, text in zip(*(texts.column(n).to_pylist() for n in columns)):
            # Whole copies, and rows that repeat one of the block.
            if not len(known) or row in gone or row in seen:
                continue
            seen.add(row)
            data = text_bytes(text)
            digits = first_digits(data)
            starts, ends = runs_of(digits)
            digits = digits[starts]
            names = digits >> np.uint64(64 - bits - _LOW_BITS)
            at = np.minimum(np.searchsorted(known, names), len(known) - 1)
            raw = data.tobytes()
            for i in np.flatnonzero(known[at] == names) if len(names) else ():
                for start in range(starts[i], ends[i], MOST_WINDOWS):
                    piece = raw[start:min(start + MOST_WINDOWS, ends[i]) + WINDOW - 1]
                    entry = found.setdefault(piece, (int(digits[i].view(np.int64)), [], [], []))
                    entry[1].append(doc)
                    entry[2].append(key)
                    entry[3].append(start)
        pieces = list(found)
        return pa.table({
            "digit": pa.array([found[p][0] for p in pieces], pa.int64()),
            "bytes": pa.array(pieces, pa.binary()),
            "doc_ids": pa.array([found[p][1] for p in pieces], pa.list_(pa.int64())),
            "text_keys": pa.array([found[p][2] for p in pieces], pa.list_(pa.int64())),
            "starts": pa.array([found[p][3] for p in pieces], pa.list_(pa.int32())),
        })

    return docs.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(of_block, schema)


def _spans_of(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, start, end) of what is lost at the places of fragments: lists of doc_ids, text_keys and starts, and
    the least documents of the windows as runs, counts and least."""

    def flat(lists):
        return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)

    for batch in (rows.slice(at, ROWS_AT_ONCE) for at in range(0, rows.num_rows, ROWS_AT_ONCE)):
        ids, of_row = flat(batch.column(0))
        keys, starts = (flat(batch.column(i))[0] for i in (1, 2))
        counts, runs = flat(batch.column(3))
        least = flat(batch.column(4))[0]
        place, start, end = lost_spans(ids, of_row, starts, counts, runs, least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (ids[place], keys[place], start, end)],
            names=["doc_id", "text_key", "start", "end"],
        )


def _lost(fragments: DataFrame, hot_windows: int) -> DataFrame:
    """(doc_id, text_key, start, end): what is lost at the places of the fragments.

    Cells give spans at once: a second Python operator on their rows would be a second Python process in each task.
    """
    windows_of = F.octet_length("bytes") - WINDOW + 1
    total = fragments.agg(F.sum(windows_of)).first()[0] or 0
    cells = total // CELL_WINDOWS + 1
    # One row for each ``hot_windows`` windows at most: small enough to broadcast, and mostly empty.
    hot = fragments.groupBy("digit").agg(F.sum(windows_of).alias("n")).where(F.col("n") > hot_windows).select("digit")
    hot = F.broadcast(hot)
    places = ["doc_ids", "text_keys", "starts"]
    schema = "doc_id bigint, text_key bigint, start bigint, end bigint"

    def of_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table.column("doc_ids").combine_chunks()
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        # Fragments that several blocks have are one piece.
        number, piece_of = {}, []
        for piece in table.column("bytes").to_pylist():
            piece_of.append(number.setdefault(piece, len(number)))
        piece_of = np.array(piece_of)
        low, high = np.full(len(number), np.iinfo(np.int64).max), np.full(len(number), np.iinfo(np.int64).min)
        np.minimum.at(low, piece_of, np.minimum.reduceat(values, offsets[:-1]))
        np.maximum.at(high, piece_of, np.maximum.reduceat(values, offsets[:-1]))
        digits = np.zeros(len(number), np.int64)
        digits[piece_of] = table.column("digit").to_numpy()
        windows, owner = least_documents(list(number), digits, low)
        edges = np.concatenate([[True], (windows[1:] != windows[:-1]) | (owner[1:] != owner[:-1])])
        first = np.flatnonzero(edges)
        counts, least, piece = np.diff(np.append(first, len(windows))), windows[first], owner[first]
        ends = np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=len(number)))])
        loses = np.bincount(piece, least < high[piece], minlength=len(number)) > 0
        chosen = pa.array(np.flatnonzero(loses[piece_of]))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int64())) for v in (counts, least)]
        pieces = pa.array(piece_of[loses[piece_of]])
        found = [table.column(n).combine_chunks() for n in places]
        del table, number, windows, owner, edges
        for at in range(0, len(chosen), ROWS_AT_ONCE):
            rows, own = chosen.slice(at, ROWS_AT_ONCE), pieces.slice(at, ROWS_AT_ONCE)
            columns = [*(x.take(rows) for x in found), *(x.take(own) for x in lists)]
            yield from _spans_of(pa.RecordBatch.from_arrays(columns, names=[*places, "counts", "least"]))

    cold = fragments.join(hot, "digit", "left_anti").withColumn("_cell", F.pmod(F.xxhash64("digit"), F.lit(cells)))
    sorted_ones = cold.drop("id").groupBy("_cell").applyInArrow(of_cell, schema)
    frequent = fragments.join(hot, "digit", "left_semi")
    windows = frequent.select(
        "id", F.array_min("doc_ids").alias("low"), F.posexplode(F.transform(
            F.sequence(F.lit(1), windows_of), lambda i: F.substring("bytes", i, F.lit(WINDOW)),
        )).alias("at", "window"),
    )
    least = windows.groupBy("window").agg(F.min("low").alias("least"))
    grouped = windows.join(least, "window").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("at", "least"))).alias("all")
    )
    told = frequent.join(grouped, "id").select(
        *places, F.transform("all", lambda x: F.lit(1).cast("bigint")).alias("counts"),
        F.transform("all", lambda x: x["least"]).alias("least"),
    )
    return sorted_ones.union(told.mapInArrow(lambda batches: (x for b in batches for x in _spans_of(b)), schema))


def repeated_spans(docs: DataFrame, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(doc_id, text_key, spans) of the documents that lose bytes; ``spans`` are (start, end) in bytes, in any order."""
    usable = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_key"), "text"
    )
    usable = usable.where(F.octet_length("text") >= WINDOW)
    blocks, cells = _sizes(usable)
    row_key = F.xxhash64("doc_id", "text_key")
    # By text as well: rows that share an id are not all one block's.
    block = F.pmod(row_key, F.lit(blocks))
    thin = usable.select("doc_id", "text_key", F.md5("text").alias("_md5"), F.octet_length("text").alias("size"))
    thin = materialise(thin.distinct(), "suffix-texts")
    least = thin.groupBy("_md5").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    # Written, so that both sides are shuffled for the join and Spark can split a text with very many copies.
    least = materialise(least.where("_first < _last"), "suffix-copied")
    copied = thin.join(least, "_md5").where("doc_id > _first")
    placed = usable.withColumn("block", block).withColumn("row_key", row_key)
    shared = materialise(_shared_digits(placed, cells), "suffix-digits")
    copies = copied.groupBy(block.alias("block")).agg(F.collect_set(row_key).alias("copies"))
    fragments = _fragments(placed, shared, copies, cells).withColumn("id", F.monotonically_increasing_id())
    fragments = materialise(fragments, "fragments")
    discard(shared)

    lost = _lost(fragments, hot_windows)
    whole = copied.select("doc_id", "text_key", F.lit(0).cast("bigint"), F.col("size").cast("bigint"))
    spans = lost.union(whole).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = materialise(spans, "repeats")
    discard(fragments)
    return spans


def remove_repeats(docs: DataFrame, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_bytes: what is left of each text (not always valid UTF-8)."""
    spans = repeated_spans(docs, hot_windows).withColumnsRenamed(
        {"doc_id": "_doc", "text_key": "_key", "spans": "_spans"}
    )
    keyed = docs.drop("n_bytes", "n_removed", "n_spans", "kept_bytes").withColumn("_own", F.xxhash64("text"))
    joined = keyed.join(spans, (keyed["doc_id"] == spans["_doc"]) & (keyed["_own"] == spans["_key"]), "left")
    joined = joined.drop("_doc", "_key", "_own")
    names = [c for c in joined.columns if c != "_spans"]
    text_at, spans_at = joined.columns.index("text"), joined.columns.index("_spans")
    schema = joined.drop("_spans").selectExpr(
        "*", "0L as n_bytes", "0L as n_removed", "0L as n_spans", "binary('') as kept_bytes"
    ).schema

    def cut(batches):
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for text, spans in zip(batch.column(text_at), batch.column(spans_at)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                at, lost, runs, parts = 0, 0, 0, []
                last = -1
                for span in sorted((s["start"], s["end"]) for s in spans.as_py() or ()):
                    start, end = max(span[0], at), span[1]
                    if end <= at:
                        continue
                    if span[0] > last:
                        runs += 1
                    parts.append(raw[at:start])
                    lost += end - start
                    at = last = end
                parts.append(raw[at:])
                sizes.append(len(raw))
                removed.append(lost)
                counts.append(runs)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if i != spans_at),
                 pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(kept, pa.binary())],
                names=[*names, "n_bytes", "n_removed", "n_spans", "kept_bytes"],
            )

    return joined.mapInArrow(cut, schema)


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the bytes that repeat an earlier document, and a digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )

"""Near-duplicate documents: SuperMinHash, banding, verification on whole shingle sets, and union-find grouping.

Documents with equal sets are one to begin with. Of each bucket of a band, all documents join the least one: that makes
families of documents that may be similar, without any pair of a bucket being listed. A family then meets in a task. A
large one is dealt to chunks of bounded size, each of which is compared by itself and with the family's least document.
What the chunks of such a family left in several groups meets once more by bucket: fingerprints of the documents outside
the main group and of the others in the bucket, in parts of bounded size. Only documents of which a fingerprint may be
similar to one of another chunk and group go, with their texts, as guests to that chunk. Being of one family is no reason
to compare: two documents are if they share a bucket, are not in one group already, and sizes and signatures allow the
wanted similarity; then their whole sets decide. The components of the links found are the groups.

Two sets just similar enough share no band with a probability of one in a million (``band_rows``), less if they are more
similar. A signature turns a pair away only if it lies ``SIGMAS`` deviations below the wanted similarity.

Contract: a null or empty text, or one without words, has an empty set and is linked with nothing; a text of fewer words
than a shingle is one shingle; very long texts count whole; a row without an id is linked with nothing, stays, and has no
group; rows that share an id share its group if their texts are alike; extra columns stay; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship
from salescope.llm.components import components
from salescope.llm.minhash import band_rows, bands, common, fingerprint, set_key, shingle_set, signature
from salescope.sources.scratch import materialise

ship(__name__)

# Characters of text, and documents, that a chunk of a family holds, and characters that a task works on at a time. All pairs
# of a bucket may be compared, so that short texts are bounded by their number.
CHUNK_CHARS, CHUNK_DOCS, BATCH_CHARS = 24_000_000, 20_000, 8_000_000
# Members up to which a family is one bucket: sorting them into buckets would cost more than to compare them.
ONE_BUCKET = 256
# Deviations by which a signature may fall short of the wanted similarity.
SIGMAS = 6


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_chars, n_shingles, set_key, fingerprint, bands) of each row, written to the shared folder."""
    rows, count = band_rows(percent)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of_batches(batches):
        for batch in batches:
            sizes, keys, prints, found = [], [], [], []
            for text in batch.column(3):
                elements = shingle_set(text.as_py(), words)
                sizes.append(len(elements))
                if len(elements):
                    values = signature(elements, rows * count)
                    keys.append(set_key(elements))
                    prints.append(fingerprint(values))
                    found.append(bands(values, rows))
                else:
                    keys.append(None)
                    prints.append(None)
                    found.append(None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(prints, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_chars", "n_shingles", "set_key", "fingerprint", "bands"],
            )

    text = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), "text"
    )
    schema = (
        f"doc_id {kind}, text_key bigint, n_chars int, n_shingles bigint, set_key binary, fingerprint binary, "
        "bands array<bigint>"
    )
    return materialise(text.mapInArrow(of_batches, schema), "signatures")


def least_matches(percent: int, registers: int) -> float:
    """Equal registers below which two sets cannot be similar enough, but for a deviation of ``SIGMAS``."""
    share = percent / 100
    return registers * (share - SIGMAS * math.sqrt(share * (1 - share) / registers))


def _registers(prints, percent: int) -> tuple[np.ndarray, float]:
    """A row of registers for each fingerprint, filled up to whole words, and the equal ones that two rows need.

    The filling is equal everywhere, and is added to what is needed.
    """
    table = np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)
    filling = -table.shape[1] % 8
    return np.pad(table, ((0, 0), (0, filling))), least_matches(percent, table.shape[1]) + filling


def _fits(prints, sizes, own_print, own_size, least: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The equal registers of each row and one document, and whether they and the sizes allow the wanted similarity."""
    # Eight comparisons are the bytes of a word; a product adds up the bytes of the sum of words (at most 21 each).
    words = (prints == own_print).view(np.uint64).sum(axis=1)
    near = ((words * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int16)
    return near, (near >= least) & (100 * np.minimum(sizes, own_size) >= percent * np.maximum(sizes, own_size))


def _verified(x: int, candidates, near, sets, group, percent: int):
    """The rows of ``candidates`` that are similar to row ``x`` and not yet in its group, which they join.

    ``near``: the equal registers of each candidate.
    """
    # The likeliest first: once linked, the rest of that group need not be looked at.
    left = candidates[np.argsort(-near, kind="stable")]
    left = left[group[left] != group[x]]
    while len(left):
        y, left = left[0], left[1:]
        both = common(sets[x], sets[y])
        if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
            yield y
            group[group == group[x]] = group[y]
            left = left[group[left] != group[x]]


def _buckets(table, rows: int, count: int):
    """(bands before it, members) of each bucket: members agree in the registers of a band. A small family is one bucket."""
    if len(table) <= ONE_BUCKET:
        yield 0, np.arange(len(table))
        return
    for band in range(count):
        which = np.unique(table[:, band * rows:(band + 1) * rows], axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(which, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(which[order])) + 1):
            if len(members) > 1:
                yield band, members


def link_family(ids, texts, prints, words: int, percent: int):
    """Links (a, b) that join the similar ones of a family or of one of its chunks, bucket by bucket."""
    rows, count = band_rows(percent)
    sets = [shingle_set(t, words) for t in texts]
    sizes = np.array([len(s) for s in sets])
    table, least = _registers(prints, percent)
    group = np.arange(len(ids))
    for done, members in _buckets(table, rows, count):
        parts, which, many = np.unique(group[members], return_inverse=True, return_counts=True)
        if len(parts) == 1:
            continue
        # Those outside the largest group, one after the other, with that group and with those before them.
        outside = which != many.argmax()
        members = np.concatenate([members[~outside], members[outside]])
        own, own_sizes = table[members], sizes[members]
        for at in range(many.max(), len(members)):
            x, before = members[at], members[:at]
            near, fits = _fits(own[:at], own_sizes[:at], own[at], own_sizes[at], least, percent)
            found = np.flatnonzero(fits & (group[before] != group[x]))
            if done and len(found):
                # What shares an earlier bucket was compared there.
                same = (own[found, :done * rows] == own[at, :done * rows]).reshape(len(found), done, rows)
                found = found[~same.all(axis=2).any(axis=1)]
            for y in _verified(x, before[found], near[found], sets, group, percent):
                yield ids[x], ids[y]


class _Meetings:
    """A table of guests and hosts, from which the guests' possible links are drawn."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        self.guest, self.minor, self.group, self.chunk, self.sizes = (
            table.column(n).to_numpy() for n in ("guest", "minor", "component", "chunk", "n_shingles")
        )
        self.prints, self.least = _registers(table.column("fingerprint").to_pylist(), percent)

    def among(self, rows):
        """(guest, hosts, equal registers) of each guest of ``rows`` that may be similar to a host there.

        Hosts of the guest's own group or chunk are left out. Two documents outside the main group meet twice; the guest
        from the lesser chunk is the one that counts.
        """
        hosts = rows[~self.guest[rows]]
        prints, sizes, group, chunk, minor = (
            a[hosts] for a in (self.prints, self.sizes, self.group, self.chunk, self.minor)
        )
        for x in rows[self.guest[rows]]:
            near, fits = _fits(prints, sizes, self.prints[x], self.sizes[x], self.least, self.percent)
            fits &= (group != self.group[x]) & ((chunk > self.chunk[x]) | (~minor & (chunk != self.chunk[x])))
            if fits.any():
                yield x, hosts[fits], near[fits]


def possible_guests(table: pa.Table, percent: int) -> pa.Table:
    """The rows of buckets that may be similar to one of another chunk, once for each chunk (``home``) where they shall meet.

    A guest and its hosts meet in the hosts' chunk, in the guest's ``part``.
    """
    # (row, home, part, whether as a guest), each once and in order.
    meetings, found = _Meetings(table, percent), {}
    keys, part = table.column("_meeting").to_numpy(), table.column("part").to_numpy()
    order = np.argsort(keys, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
        for x, hosts, _ in meetings.among(rows):
            homes = meetings.chunk[hosts]
            found.update(dict.fromkeys((x, home, part[x], 1) for home in np.unique(homes)))
            found.update(dict.fromkeys((y, home, part[x], 0) for y, home in zip(hosts, homes)))
    row, home, part, guest = np.array(list(found), np.int64).reshape(-1, 4).T
    kept = ["family", "doc_id", "text_key", "n_shingles", "fingerprint", "component", "chunk", "minor"]
    table = table.select(kept).take(pa.array(row))
    for name, values in (("home", home.astype(np.int32)), ("part", part.astype(np.int32)), ("guest", guest == 1)):
        table = table.append_column(name, pa.array(values))
    return table


def link_guests(table: pa.Table, words: int, percent: int):
    """Links (a, b) of the guests of a chunk with its hosts, as far as they join groups."""
    ids, sets = table.column("doc_id").to_pylist(), [shingle_set(t, words) for t in table.column("text").to_pylist()]
    group = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
    for x, hosts, near in _Meetings(table, percent).among(np.arange(len(ids))):
        for y in _verified(x, hosts, near, sets, group, percent):
            yield ids[x], ids[y]


def _as_links(found) -> pa.Table:
    found = list(found)
    return pa.table({
        "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())
    })


def _distinct(table: pa.Table, *names: str) -> pa.Table:
    """The table in the order of ``names``, with one row of each: repeated rows would be compared for nothing."""
    table = table.sort_by([(n, "ascending") for n in names])
    keys = np.column_stack([table.column(n).to_numpy() for n in names])
    return table.filter(pa.array(np.concatenate([[True], np.any(keys[1:] != keys[:-1], axis=1)])))


def _chunks(chars: Column, docs: Column) -> Column:
    """The chunks that so many characters, and documents, take."""
    return F.greatest(F.ceil(chars / CHUNK_CHARS), F.ceil(docs / CHUNK_DOCS)).cast("int")


def _within_chunks(placed: DataFrame, texts: DataFrame, total: int, words: int, percent: int) -> DataFrame:
    """Links inside each chunk; the least document of a family is in all of its chunks, so that copies of it are joined."""
    homes = F.when(F.col("doc_id") == F.col("_hub"), F.sequence(F.lit(0), F.col("_parts") - 1)).otherwise(F.array("chunk"))
    # A chunk of a large family has a task call of its own; smaller families share one.
    few = F.pmod(F.xxhash64("family"), F.lit(max(1, total // BATCH_CHARS)))
    batch = F.when(F.col("_parts") > 1, F.xxhash64("family", "home")).otherwise(few)
    keyed = placed.withColumn("home", F.explode(homes)).select(
        "doc_id", "text_key", "fingerprint", "family", "home", batch.alias("_batch")
    ).join(texts, ["doc_id", "text_key"])

    def of_batch(table: pa.Table) -> pa.Table:
        found = []
        table = _distinct(table, "family", "home", "doc_id", "text_key")
        keys = np.column_stack([table.column(n).to_numpy() for n in ("family", "home")])
        edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        for start, end in zip([0, *edges], [*edges, len(keys)]):
            part = table.slice(start, end - start)
            found += link_family(*(part.column(n).to_pylist() for n in ("doc_id", "text", "fingerprint")), words, percent)
        return _as_links(found)

    return keyed.groupBy("_batch").applyInArrow(of_batch, "a bigint, b bigint")


def _meet_by_bucket(left: DataFrame, percent: int) -> DataFrame:
    """The documents of ``left`` that shall meet in a chunk; see ``possible_guests``. No text travels here.

    Buckets are those of the bands, told by the bytes of the fingerprint: documents that share a band share them.
    """
    rows, count = band_rows(percent)
    bucket = F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda band: F.xxhash64("family", band, F.substring("fingerprint", band * rows + 1, F.lit(rows))),
    )
    banded = left.withColumn("bucket", F.explode(bucket))
    # Of interest are buckets with several groups, and parts of a bucket for so many hosts and guests.
    buckets = materialise(
        banded.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("_docs"), F.sum(F.col("minor").cast("long")).alias("_minor"),
            F.min("component").alias("_least"), F.max("component").alias("_most"),
        ).where("_minor > 0 and _least < _most").select(
            "bucket", "_docs", F.ceil(F.col("_docs") / CHUNK_DOCS).cast("int").alias("_hosts"),
            F.ceil(F.col("_minor") / CHUNK_DOCS).cast("int").alias("_visits"),
        ),
        "buckets",
    )
    total = buckets.agg(F.sum("_docs")).first()[0] or 0
    met = banded.join(buckets, "bucket")
    stay = met.select(
        "*", F.lit(False).alias("guest"),
        F.pmod(F.xxhash64("doc_id", "text_key"), "_hosts").cast("int").alias("_host"),
        F.explode(F.sequence(F.lit(0), F.col("_visits") - 1)).alias("_visit"),
    )
    go = met.where("minor").select(
        "*", F.lit(True).alias("guest"), F.explode(F.sequence(F.lit(0), F.col("_hosts") - 1)).alias("_host"),
        F.pmod(F.xxhash64("text_key", "doc_id"), "_visits").cast("int").alias("_visit"),
    )
    meeting = F.xxhash64("bucket", "_host", "_visit")
    # Parts of a large bucket have a task call of their own; smaller buckets share one.
    few = F.pmod("bucket", F.lit(max(1, total // CHUNK_DOCS)))
    met = stay.unionByName(go).select(
        "family", "doc_id", "text_key", "n_shingles", "fingerprint", "component", "chunk", "part", "minor", "guest",
        meeting.alias("_meeting"), F.when(F.col("_hosts") * F.col("_visits") > 1, meeting).otherwise(few).alias("_batch"),
    )
    return met.groupBy("_batch").applyInArrow(
        lambda table: possible_guests(table, percent),
        "family bigint, doc_id bigint, text_key bigint, n_shingles bigint, fingerprint binary, component bigint, chunk int, "
        "minor boolean, home int, part int, guest boolean",
    )


def _between_chunks(placed: DataFrame, joined: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between the chunks of large families whose chunks (``joined``: node, component) left several groups.

    Of two documents in different groups, one at least is outside the family's main group. Only those go to other chunks, as
    guests in parts of a chunk's size, and only where their fingerprints met that of a possible partner.
    """
    groups = joined.select(F.col("node").alias("doc_id"), "component")
    spread = materialise(
        placed.where("_parts > 1").join(groups, "doc_id", "left").select(
            F.col("doc_id").cast("bigint").alias("doc_id"), "text_key", "n_chars", "n_shingles", "fingerprint",
            F.col("family").cast("bigint").alias("family"), "chunk",
            F.coalesce("component", F.col("doc_id").cast("bigint")).alias("component"),
        ),
        "spread",
    )
    weight = spread.groupBy("family", "component").agg(
        F.sum("n_chars").alias("_chars"), F.count(F.lit(1)).alias("_docs")
    )
    largest = F.max(F.struct("_chars", "component", "_docs"))
    main = weight.groupBy("family").agg(
        largest["component"].alias("_main"),
        _chunks(F.sum("_chars") - largest["_chars"], F.sum("_docs") - largest["_docs"]).alias("_guests"),
    ).where("_guests > 0")
    left = materialise(
        spread.join(main, "family").select(
            "family", "doc_id", "text_key", "n_shingles", "fingerprint", "component", "chunk",
            (F.col("component") != F.col("_main")).alias("minor"),
            F.pmod(F.xxhash64("doc_id", "text_key"), "_guests").cast("int").alias("part"),
        ),
        "outside",
    )

    def of_batch(table: pa.Table) -> pa.Table:
        return _as_links(link_guests(_distinct(table, "guest", "doc_id", "text_key"), words, percent))

    wanted = _meet_by_bucket(left, percent).dropDuplicates(["family", "home", "part", "guest", "doc_id", "text_key"])
    wanted = wanted.withColumn("_batch", F.xxhash64("family", "home", "part"))
    return wanted.join(texts, ["doc_id", "text_key"]).groupBy("_batch").applyInArrow(of_batch, "a bigint, b bigint")


def _grouped(families: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the similar documents of each family.

    ``families``: (doc_id, text_key, n_chars, n_shingles, fingerprint, family).
    """
    weight = families.groupBy("family").agg(
        F.sum("n_chars").alias("_chars"), F.count(F.lit(1)).alias("_docs"), F.min("doc_id").alias("_hub")
    )
    weight = weight.withColumn("_parts", F.greatest(_chunks(F.col("_chars"), F.col("_docs")), F.lit(1))).drop("_docs")
    total, most = weight.agg(F.sum("_chars"), F.max("_parts")).first()
    placed = families.join(weight, "family").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_key"), "_parts").cast("int"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    joined = components(_within_chunks(placed, texts, total or 0, words, percent))
    if (most or 1) == 1:
        return joined
    joined = materialise(joined, "joined")
    between = _between_chunks(placed, joined, texts, words, percent)
    return components(joined.select(F.col("component").alias("a"), F.col("node").alias("b")).union(between))


def group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of each row; ``doc_id`` must be a whole number.

    ``component_id`` is the least id that is reached by links of at least ``percent`` hundredths of similarity.
    """
    signed = signatures(docs, words, percent)
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    # Of documents with equal sets, the least stands for all.
    first = F.min(F.struct("doc_id", "text_key", "n_chars", "n_shingles", "fingerprint", "bands")).alias("_first")
    reps = materialise(usable.groupBy("set_key").agg(first).select("set_key", "_first.*"), "representatives")
    buckets = reps.select("doc_id", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("_last")).where("a < _last")
    near = buckets.join(leaders.select("bucket", "a"), "bucket").where("doc_id <> a").select("a", F.col("doc_id").alias("b"))
    family = components(near).select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    members = materialise(
        reps.select("doc_id", "text_key", "n_chars", "n_shingles", "fingerprint").join(family, "doc_id"), "families"
    )
    grouped = _grouped(members, docs, words, percent)
    grouped = grouped.select(F.col("node").alias("doc_id"), "component")
    by_set = reps.select("set_key", "doc_id").join(grouped, "doc_id", "left").select(
        "set_key", F.coalesce("component", "doc_id").alias("_component")
    )
    rows = signed.select("doc_id", "text_key", "n_shingles", "set_key").join(by_set, "set_key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return rows.select(
        "doc_id", "text_key", "n_shingles", own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, the one with the least id; the columns stay as they are."""
    gone = group(docs, words, percent).where("not kept").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")
    ).distinct()
    same = (docs["doc_id"] == gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_key"])
    return docs.join(gone, same, "left_anti")


def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are similar by 85 hundredths or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group(docs, words=3, percent=85).drop("text_key")

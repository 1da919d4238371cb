"""Secret scans with an inverted index of trigrams.

From each rule's pattern follows a Boolean query over trigrams that any match must contain: an "or" of "and"s. The index
holds, for each trigram that some query asks for, the documents with it; intersecting the postings leaves the candidates
of a rule, and only these are matched against its pattern. A rule without mandatory trigrams scans every text. Trigrams
are taken from lower-cased texts, so that one index serves patterns of either case; a candidate too many costs time,
none is missed.

Contract: a null text is empty and has no spans; texts are scanned whole, however long; repeated rows each get their
result, and a null id is an id like any other (rows that share an id share their candidates, which are verified on each
text); extra columns stay out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import text_of
from salescope.sources.scratch import materialise


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and to RE2; ``least`` is the least length of ``group`` (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in their order.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Further public formats of keys and tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES
# A part of a pattern that stands for more strings than this counts as unknown text.
MOST_STRINGS = 16


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The sets of lower-case trigrams of which any match has one whole set; [] if a match need not have any.

    The parsed pattern becomes a list of alternatives. Each alternative is a list of known strings, in order, with
    unknown text between them; a trigram inside a known string is mandatory for it.
    """
    alternatives = _alternatives(list(sre_parser.parse(pattern)))
    sets = set()
    for pieces in alternatives:
        known = frozenset(p[i:i + 3] for p in pieces if p is not None for i in range(len(p) - 2))
        if not known:
            return []
        sets.add(known)
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def _alternatives(nodes: list) -> list[tuple[str | None, ...]]:
    """Known strings in order, None where text is unknown; one tuple for each alternative."""
    done = [("",)]
    for op, value in nodes:
        found = _of(op, value)
        if len(done) * len(found) > MOST_STRINGS * 4:
            found = [(None,)]
        done = list(dict.fromkeys(_joined(a, b) for a, b in itertools.product(done, found)))
    return done


def _joined(a: tuple, b: tuple) -> tuple:
    """Two alternatives one after the other: strings that touch become one."""
    if a[-1] is not None and b[0] is not None:
        return (*a[:-1], a[-1] + b[0], *b[1:])
    return a + b


def _of(op, value) -> list[tuple[str | None, ...]]:
    """The alternatives of one node of a parsed pattern."""
    if op is sre.LITERAL:
        return [(chr(value).lower(),)] if value < 128 else [(None,)]
    if op is sre.IN:
        known = []
        for kind, x in value:
            if kind is sre.LITERAL and x < 128:
                known.append(chr(x).lower())
            elif kind is sre.RANGE and x[1] < 128 and x[1] - x[0] < MOST_STRINGS:
                known += [chr(c).lower() for c in range(x[0], x[1] + 1)]
            else:
                return [(None,)]
        known = list(dict.fromkeys(known))
        return [(c,) for c in known] if len(known) <= MOST_STRINGS else [(None,)]
    if op is sre.SUBPATTERN:
        return _alternatives(list(value[-1]))
    if op is sre.BRANCH:
        return list(dict.fromkeys(itertools.chain.from_iterable(_alternatives(list(x)) for x in value[1])))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = value
        body = _alternatives(list(inner))
        if (low, high) == (0, 1):
            return list(dict.fromkeys([("",), *body]))
        if low == 0:
            return [(None,)]
        if low == high == 1:
            return body
        # At least once: what the first and the last repetition hold, with unknown text in between.
        return [_joined(_joined(a, (None,)), (None,)) for a in body]
    if op is sre.AT:
        return [("",)]
    return [(None,)]


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the given lower-case trigrams, kept by trigram.

    Each text is lower-cased once and searched for each trigram, which is faster than one pattern for all of them.
    """
    lowered = docs.select("doc_id", F.lower(text_of()).alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    postings = lowered.select("doc_id", F.explode(found).alias("trigram"))
    return materialise(postings.repartition("trigram", "doc_id").sortWithinPartitions("trigram"), "postings")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows (doc_id, kinds): the rules whose trigram queries a document fulfils; rules that scan fully are left out."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    terms = [
        (kind, k, t, 1 << i, (1 << len(s)) - 1)
        for kind, sets in queries.items()
        for k, s in enumerate(sets)
        for i, t in enumerate(sorted(s))
    ]
    wanted = sorted({t for _, _, t, _, _ in terms})
    schema = "kind string, conjunction int, trigram string, bit bigint, whole bigint"
    terms = docs.sparkSession.createDataFrame(terms, schema)
    postings = trigram_index(docs, wanted)
    # The terms of all rules: a few hundred rows, set by the rules and not by the data.
    met = postings.join(F.broadcast(terms), "trigram").groupBy("doc_id", "kind", "conjunction", "whole")
    met = met.agg(F.bit_or("bit").alias("bits")).where("bits = whole")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, order: int) -> Column:
    """The places of a rule in ``text`` by code points, as structs (start, order, end, kind)."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    tested = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    # The text between matches and the matches themselves, by their lengths: a match starts where those before it end.
    before = F.transform(F.split("text", rule.pattern, -1), lambda p: F.length(p))
    steps = F.zip_with(
        F.zip_with(F.slice(before, F.lit(1), F.size(matches)), matches, lambda b, m: F.struct(
            b.alias("gap"), F.length(m).alias("length"))),
        tested,
        lambda s, t: F.struct(s["gap"].alias("gap"), s["length"].alias("length"), F.length(t).alias("tested")),
    )
    def placed(steps: Column) -> Column:
        ends = _running(F.transform(steps, lambda s: s["gap"] + s["length"]))
        spans = F.zip_with(steps, ends, lambda s, end: F.when(s["tested"] >= rule.least, F.struct(
            (end - s["length"]).alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )))
        return F.array_compact(spans)

    return _with(steps, placed)


def _with(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _running(numbers: Column) -> Column:
    """The sums of all numbers up to each one: as many passes as the number of them has bits, each adding what stands twice
    as far ahead as the pass before. No array grows element by element."""

    def summed(numbers: Column) -> Column:
        n = F.size(numbers)

        def add(sums: Column, k: Column) -> Column:
            by = F.pow(F.lit(2), k).cast("int")
            ahead = F.concat(F.array_repeat(F.lit(0), by), F.slice(sums, F.lit(1), n - by))
            return F.zip_with(sums, ahead, lambda a, b: a + b)

        passes = F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1)
        return F.when(n > 1, F.aggregate(passes, numbers, add)).otherwise(numbers)

    return _with(numbers, summed)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): all places of all rules, sorted by start and then by the order of the rules."""
    thin = docs.select("doc_id", text_of().alias("text"))
    found = candidates(thin, rules).withColumnRenamed("doc_id", "_id")
    joined = thin.join(found, thin["doc_id"].eqNullSafe(found["_id"]), "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    parts = []
    for i, rule in enumerate(rules):
        spans = _spans(rule, i)
        if trigram_query(rule.pattern):
            candidate = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            candidate = F.col("text").rlike(rule.pattern)
        parts.append(F.when(candidate, spans).otherwise(none))
    return joined.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the spans of secrets, their numbers by base rule, and a digest of the base spans."""
    spans = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["order"] < len(BASE_RULES))

    def count(order: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["order"] == order)).cast("bigint")

    return spans.select(
        "doc_id",
        *[count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def _spans_sql(order: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    # DuckDB takes options apart from the pattern; (?i) at its start is understood by RE2 as well.
    return f"""
  SELECT r, {order} AS o, '{rule.kind}' AS kind, s, s + length(m) AS e FROM (
    SELECT r, m, t, (sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m))::BIGINT AS s FROM (
      SELECT r, unnest(string_split_regex(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) AS g,
        unnest(regexp_extract_all(text, '{pattern}')) AS m,
        unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS t,
        unnest(range(len(regexp_extract_all(text, '{pattern}')))) AS i
      FROM doc WHERE regexp_matches(text, '{pattern}')))
  WHERE length(t) >= {rule.least}"""


OP3_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
span AS ({' UNION ALL '.join(_spans_sql(i, rule) for i, rule in enumerate(RULES))}),
listed AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < {len(BASE_RULES)}) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
  FROM span GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (r)
"""

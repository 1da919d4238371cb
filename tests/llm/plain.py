"""Plain Python versions of the operators' contracts, and rows with all the odd cases."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, row string, rate string"


def odd_documents(spark, texts=None):
    """Nulls in every column, empty, short, long and repeated texts, and extra columns whose names clash."""
    long = " ".join(f"word{i % 977} the of" for i in range(40_000))
    twin = "the quick brown fox jumps over the lazy dog and runs away from the very old bear " * 4
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n ", "en", "s", 4), (4, "one", "en", None, 3),
        (5, "one two", "en", "s", 7), (6, "One TWO", "fr", "s", 7), (7, twin, "en", "s", len(twin)),
        (8, twin, "en", "s", len(twin)), (8, twin, "en", "s", len(twin)), (9, twin + "zebra", "en", "s", None),
        (10, long, "en", "s", len(long)), (11, long + " end", "en", "s", 1), (None, twin, "en", "s", 1),
        (12, "éÉ ñ 日本 straße", "de", "s", 1), (13, "1234 5678 !!", None, "s", 1), (14, twin.upper(), "en", "s", 1),
    ] + list(texts or ())
    return spark.createDataFrame([(*r, "own", "own", "own", "own") for r in rows], SCHEMA)


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def groups(rows, length, percent):
    """id -> (set size, least id reachable)."""
    sets = {}
    for i, text in rows:
        words = blank_words((text or "").translate(LOWER))
        sets[i] = {tuple(words[k:k + length]) for k in range(max(1, len(words) - length + 1))} if words else set()
    holders, shared = defaultdict(list), Counter()
    for i, found in sets.items():
        for shingle in found:
            holders[shingle].append(i)
    for ids in holders.values():
        shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1:])
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            up[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def quality(text):
    words, lines = blank_words(text), (text or "").split("\n")
    runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, twice = set(), 0
    for line in lines:
        if blank_words(line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), twice, len(hit)


def repeats(rows, window=50):
    """id -> (bytes, removed, spans, digest) for rows with distinct ids."""
    first = {}
    for i, text in sorted((i, text or "") for i, text in rows):
        raw = text.encode()
        for p in range(len(raw) - window + 1):
            first.setdefault(raw[p:p + window], i)
    done = {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            if first[raw[p:p + window]] < i:
                gone[p:p + window] = b"\1" * window
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        done[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return done


def licenses(text):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    words = item_words(text)
    places = [(i, label) for phrase, label in phrases.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))

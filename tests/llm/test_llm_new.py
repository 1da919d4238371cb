"""Toxicity, spelling variants and periodic runs: against plain Python, odd rows included."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction
from zlib import crc32

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from salescope.llm import periodic, spelling, toxicity
from salescope.llm.queries import QUERIES


def _documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def _folder(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(7, 1, 1), (8, 1, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


# Periodic runs.

def _runs(words):
    """All lags one after the other, all stretches of each."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    seen, found = set(), []
    for q in range(1, len(ids) // 3 + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, lengths = edges[::2], edges[1::2] - edges[::2] + q
        long = lengths >= max(24, 3 * q)
        for start, length in zip(starts[long].tolist(), lengths[long].tolist()):
            if (start, length) not in seen:
                seen.add((start, length))
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _op13(doc_id, text):
    words = plain.blank_words(text)
    n, h = len(words), crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op13_query(spark, sf):
    got = sorted(tuple(r) for r in QUERIES["op13_periodic"](spark, sf).collect())
    assert got == sorted(_op13(*d) for d in _documents(spark, sf)) and sum(r[1] > 0 for r in got) > 10


def test_runs_of_random_texts():
    rng = np.random.default_rng(5)
    total = 0
    for _ in range(400):
        n, letters = int(rng.integers(1, 300)), int(rng.integers(1, 4))
        ids = rng.integers(0, letters, n).astype(np.int32)
        for _ in range(rng.integers(0, 6)):
            p, start, length = int(rng.integers(1, 60)), int(rng.integers(0, n)), int(rng.integers(1, 250))
            for i in range(max(start, p), min(n, start + length)):
                ids[i] = ids[i - p]
        found = periodic.find_runs(ids)
        assert found == _runs(ids.tolist())
        total += len(found)
    assert total > 100


def test_runs_of_repetitive_words_of_all_sizes():
    thue = [bin(i).count("1") & 1 for i in range(700)]
    fibonacci = [0]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    for words in (thue, b, fibonacci * 23, fibonacci * 24, [0, 1] * 12, ([0] * 40 + [1]) * 9, ([0] * 24 + [1] + [0] * 30 + [2]) * 4):
        assert periodic.find_runs(np.array(words, np.int32)) == _runs(words)


def test_long_periodic_text_takes_few_steps():
    for ids in (np.zeros(300_000, np.int32), (np.arange(300_000) % 1000).astype(np.int32), (np.arange(300_000) % 41 // 40).astype(np.int32)):
        runs = periodic.find_runs(ids)
        assert max(length for _, length, _ in runs) == 300_000


def test_words_of_long_texts_as_of_short_ones(monkeypatch):
    raw = " a bb\x0bccc\x1fd e \n\n bb ".encode() * 30
    whole = periodic.word_ids(raw)
    monkeypatch.setattr(periodic, "BLOCK", 3)
    parts = periodic.word_ids(raw)
    assert whole[0].tolist() == parts[0].tolist() and whole[1] == parts[1] == [b"a", b"bb", "ccc\x1fd e".encode()]


def test_odd_documents_have_runs(spark, tmp_path):
    docs = plain.odd_documents(spark, [
        (40, "x " * 24, "en", "s", 1), (41, "x " * 23, "en", "s", 1), (42, "a b c d e f g h " * 3 + "a", None, None, None),
        (45, "x y " * 30 + "z " * 30, "en", "s", 1), (46, "x y " * 30 + "z " * 30, "en", "s", 1)])
    rows = QUERIES["op13_periodic"](spark, _folder(spark, tmp_path, docs)).collect()
    want = [_op13(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    done = periodic.with_runs(docs.withColumn("runs", F.lit("mine")))
    assert done.columns == [*docs.columns, "runs", "collapsed"]
    by_id = {r.doc_id: r for r in done.collect()}
    assert by_id[1].collapsed is None and by_id[1].runs == [] and by_id[2].collapsed == ""
    assert by_id[40].collapsed == "x" and by_id[41].runs == [] and by_id[42].collapsed == "a b c d e f g h"
    assert by_id[45].collapsed == "x y z" and by_id[45].score == "own"
    assert periodic.with_runs(docs.limit(0)).count() == 0


# Spelling variants.

def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def _variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(plain.LOWER)
            h = crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    # Words that are near share a stretch left when one place is blanked or taken out.
    places = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            places[w[:i] + "*" + w[i:]].add(w)
            if i < len(w):
                places[w[:i] + "*" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in places.values():
        for a in group:
            near[a].update(b for b in group if _near(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_op12_query(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    rows = [tuple(r) for r in QUERIES["op12_spelling"](spark, folder).collect()]
    want = _variants(_documents(spark, folder))
    assert len(rows) == len(want) and set(rows) == want and sum(r[1] is not None for r in rows) > 0


def test_near_words_are_all_found(spark):
    rng = np.random.default_rng(8)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 10))) for _ in range(900)} | {"aaaaaa", "aaaaaaa", "àaaaaaa", "ÿaaaaa"}
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = [(r.word, r.near) for r in spelling.near_pairs(frame).collect()]
    want = {(a, b) for a in words for b in words if _near(a, b)}
    assert len(got) == len(want) and set(got) == want and len(want) > 1000


def test_chains_of_forms(spark):
    # Each word one edit from the next and at least five times as rare, in a chain of seven.
    chain = ["abcdefg"[:k] + "x" * (10 - k) for k in range(8)]
    frame = spark.createDataFrame([(w, 5 * 5**k) for k, w in enumerate(chain)] + [("zzzzzz", 5)], "word string, n long")
    forms = spelling.with_forms(frame)
    got = {r.word: r.root for r in spelling.roots(forms, 5**8).collect()}
    assert got == {w: chain[-1] for w in chain[:-1]}
    by_word = {r.word: (r.n_near, r.form) for r in forms.collect()}
    assert by_word["zzzzzz"] == (0, None) and by_word[chain[0]] == (1, chain[1]) and by_word[chain[3]] == (2, chain[4])


def test_keys_and_chains_do_not_go_through_the_driver(spark, tmp_path):
    """A small file of words has many more keys than Spark takes it to have."""
    spark.range(2000).selectExpr("substr(sha2(cast(id as string), 256), 1, 9) as word", "id + 5 as n").write.parquet(str(tmp_path / "w"))
    words = spark.read.parquet(str(tmp_path / "w"))
    chains = spelling.roots(words.select("word", F.col("word").alias("form")), 5)
    for frame in (spelling.near_pairs(words), chains):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_ties_of_forms_go_to_the_smallest(spark):
    frame = spark.createDataFrame([("abcdef", 5), ("abcdeé", 25), ("abcdez", 25), ("abcdeÿ", 24)], "word string, n long")
    got = {r.word: (r.form, r.form_n, r.n_near) for r in spelling.with_forms(frame).collect()}
    assert got["abcdef"] == ("abcdez", 25, 3) and got["abcdeé"] == (None, None, 3)


def test_odd_documents_have_variants(spark, tmp_path, monkeypatch):
    docs = plain.odd_documents(spark, [
        (50, "straße Straße STRAßE straßen straße straße ÀÉÎÕÜÿ×÷ " * 9, "de", "s", 1), (None, "strasse " * 7, "de", "s", 1)])
    folder = _folder(spark, tmp_path, docs)
    want = _variants([(r.doc_id, r.text) for r in docs.collect()])
    assert set(map(tuple, QUERIES["op12_spelling"](spark, folder).collect())) == want and len(want) == 4
    monkeypatch.setattr(spelling, "BLOCK", 7)
    monkeypatch.setattr(spelling, "MOST_WORDS", 5)
    assert set(map(tuple, QUERIES["op12_spelling"](spark, folder).collect())) == want
    assert spelling.variants(docs.limit(0)).count() == 0


# Toxicity.

def test_op11_query(spark, sf):
    rows = QUERIES["op11_toxicity"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in _documents(spark, sf))
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxicity_of_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    english = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").where("lang = 'en'").collect()}
    rows = [r for r in QUERIES["op11_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    clean = [r.predicted for r in rows if not labels[r.doc_id]]
    toxic = [r.predicted for r in rows if labels[r.doc_id] and r.doc_id in english]
    # Labels of other languages are noise; of the English ones, a few in a hundred are as well.
    assert len(toxic) > 40 and np.mean(toxic) > 0.85 and np.mean(clean) < 0.005


def test_held_out_labels_teach_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(toxicity.labelled_rows(docs, x)) for x in (labels, other))
    assert a.intercept == b.intercept and np.array_equal(a.hashes, b.hashes) and np.array_equal(a.weights, b.weights)
    assert len(toxicity.labelled_rows(docs, labels, 10)) == 10


def test_weights_are_sparse_and_steps_are_those_of_the_definition(monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        label = int(rng.random() < 0.3)
        found = set(rng.integers(100, 2000, 40).tolist()) | ({1, 2} if label else set()) | {3}
        rows.append((label, np.array(sorted(found), np.uint32)))
    model = toxicity.train(rows)
    assert {1, 2} <= set(model.hashes.tolist()) and len(model.hashes) < 60
    # One coordinate at a time, by the published update.
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    few = rows[:50]
    model = toxicity.train(few)
    z, n, docs = defaultdict(float), defaultdict(float), Counter(k for _, f in few for k in f.tolist())
    share = (sum(y for y, _ in few) + 0.5) / 51
    bias, bias_n = np.log(share / (1 - share)), 0.0

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return -(z[k] - np.sign(z[k]) * toxicity.L1) / ((toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for i in np.random.default_rng(7).permutation(50):
        y, found = few[i][0], [k for k in few[i][1].tolist() if docs[k] >= toxicity.LEAST_DOCS]
        w = {k: weight(k) for k in found}
        g = 1 / (1 + np.exp(-(bias + sum(w.values())))) - y
        for k in found:
            z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / toxicity.ALPHA * w[k]
            n[k] += g * g
        bias_n += g * g
        bias -= toxicity.ALPHA * g / (toxicity.BETA + bias_n ** 0.5)
    want = {k: weight(k) for k in z if weight(k)}
    assert dict(zip(model.hashes.tolist(), model.weights.tolist())) == pytest.approx(want) and model.intercept == pytest.approx(bias)


def test_features_of_blocks_as_of_the_whole(monkeypatch):
    text = "One two, two! THREE éé 4 " * 50
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "BLOCK", 5)
    assert np.array_equal(whole, toxicity.features(text)) and len(toxicity.features(None)) == 0


def test_odd_documents_have_scores(spark, tmp_path):
    docs = plain.odd_documents(spark)
    rows = QUERIES["op11_toxicity"](spark, _folder(spark, tmp_path, docs)).collect()
    assert len(rows) == docs.count() and {r.held_out for r in rows if r.doc_id is None} == {False}
    assert all(0 <= r.score <= 1 for r in rows)
    model = toxicity.train([])
    assert model.score("any text") == model.score(None) == 0.5
    scored = toxicity.with_toxicity(docs, model)
    assert scored.columns == [*(c for c in docs.columns if c != "score"), "score", "predicted"]
    assert scored.limit(0).count() == 0 and toxicity.labelled_rows(docs, docs.limit(0).selectExpr("doc_id", "1 as toxic")) == []

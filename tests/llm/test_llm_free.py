"""Near duplicates, mixing, language, licences, pages, repeats, the pipeline: against plain Python."""

import time
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salescope.llm import components, html, language, licenses, minhash, mixing, neardup, suffixes
from salescope.llm.queries import QUERIES


def _documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# Near duplicates.

def test_op1_query(spark, sf):
    want = plain.groups([(r.doc_id, r.text) for r in _documents(spark, sf).collect()], 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_neardup"](spark, sf).collect()}
    assert got == want


def _family(seed, size, edits, length=60):
    """A text and copies, each with some words replaced."""
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(0, 10**6)}" for _ in range(length)]
    texts = [base]
    for _ in range(size - 1):
        copy = list(base)
        for at in rng.choice(length, rng.integers(0, edits + 1), replace=False):
            copy[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


def test_groups_of_families_in_any_chunks(spark, monkeypatch):
    texts = [t for seed, (size, edits) in enumerate([(60, 4), (25, 2), (8, 6), (2, 1), (1, 0)]) for t in _family(seed, size, edits)]
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)]
    want = plain.groups(rows, 3, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chars, most in ((10**7, 10**6), (2000, 10**6), (10**7, 7)):
        # Small chunks make families of several chunks, which meet pair by pair.
        monkeypatch.setattr(neardup, "CHUNK_CHARS", chars)
        monkeypatch.setattr(neardup, "CHUNK_DOCS", most)
        monkeypatch.setattr(neardup, "BATCH_CHARS", chars)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.group(docs, 3, 85).collect()}
        assert got == want


def test_task_input_does_not_grow_with_the_family(spark, monkeypatch):
    texts = _family(11, 120, 2, 200) + _family(12, 40, 9)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "CHUNK_CHARS", 9000)
    monkeypatch.setattr(neardup, "BATCH_CHARS", 3000)
    seen, plain_group = [], type(docs).groupBy

    def noted(self, *cols):
        if [c for c in cols if isinstance(c, str)] == ["_batch"] and "text" in self.columns:
            seen.append(self)
        return plain_group(self, *cols)

    monkeypatch.setattr(type(docs), "groupBy", noted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.group(docs, 3, 85).collect()}
    monkeypatch.setattr(type(docs), "groupBy", plain_group)
    assert got == plain.groups(rows, 3, 85)
    sizes = [r[1] for f in seen for r in f.groupBy("_batch").agg(F.sum(F.length("text"))).collect()]
    # A chunk and its guests at most, and no copy of the whole family for each of its chunks.
    assert max(sizes) <= 4 * 9000 and sum(sizes) <= 4 * sum(map(len, texts))


def _order_notes(count, seed=5):
    """Short texts from one template, alike enough to share buckets and not to be linked; every fifth has a near copy."""
    rng, texts = np.random.default_rng(seed), []
    for i in range(count):
        a, b, c = (f"{x:x}" for x in rng.integers(0, 16**5, 3))
        note = f"your order number {a} for {b} has been shipped today and should reach you at {c} soon"
        texts += [note, note + " x"] if i % 5 == 0 else [note]
    return texts


def test_links_of_a_family_by_bucket_are_those_of_all_its_pairs():
    texts = _order_notes(400) + _family(31, 200, 3) + _family(32, 40, 9)
    ids, signed = list(range(len(texts))), []
    rows, count = minhash.band_rows(85)
    for text in texts:
        signed.append(minhash.fingerprint(minhash.signature(minhash.shingle_set(text, 3), rows * count)))
    assert len(texts) > neardup.ONE_BUCKET
    got = {i: i for i in ids}
    for a, b in neardup.link_family(ids, texts, signed, 3, 85):
        got = {i: min(got[a], got[b]) if got[i] in (got[a], got[b]) else got[i] for i in ids}
    assert got == {i: component for i, (_, component) in plain.groups(list(zip(ids, texts)), 3, 85).items()}


def test_a_family_of_texts_that_are_not_alike_enough(spark, monkeypatch):
    """Many buckets, many chunks, hardly a link: only fingerprints that share a bucket are compared between chunks."""
    rows = list(enumerate(_order_notes(700)))
    monkeypatch.setattr(neardup, "CHUNK_DOCS", 60)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.group(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == plain.groups(rows, 3, 85)


def test_rows_that_share_an_id_are_linked_by_each_of_their_texts(spark):
    (a, b), (c, d) = _family(21, 2, 1), _family(22, 2, 1)
    docs = spark.createDataFrame([(5, a), (5, c), (9, b + " end"), (8, d + " end")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in neardup.group(docs, 3, 85).collect()}
    assert got == {(5, 5), (8, 5), (9, 5)}


def test_groups_of_odd_documents(spark):
    docs = plain.odd_documents(spark)
    rows = neardup.group(docs, 3, 85).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[1] == got[1][:0] + (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 5, True) and got[6] == (1, 5, False)
    assert [got[i][1] for i in (7, 8, 9, 14)] == [7] * 4 and got[11][1] == 10
    assert got[None][1] is None and got[None][2]
    kept = neardup.keep_one(docs, 3, 85)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "10", "12", "13", "None"])
    assert neardup.group(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for n in (1, 3, 40, 500, 20_000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(n * 0.8)], rng.integers(0, 2**63, n - int(n * 0.8), dtype=np.uint64)]))
        same = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = minhash.signature(a, 256), minhash.signature(b, 256)
        assert np.isfinite(x).all()
        errors.append(abs((x == y).mean() - same))
    assert max(errors[2:]) < 0.12 and minhash.signature(np.zeros(0, np.uint64), 8).max() == np.inf


def test_signature_is_that_of_one_element_at_a_time():
    """The definition: element by element, each with a shuffle of its own; no early stop."""
    elements, m = np.random.default_rng(3).integers(0, 2**63, 30, dtype=np.uint64), 24
    want = np.full(m, np.inf)
    for e in elements:
        order = list(range(m))
        for j in range(m):
            bits = int(minhash.mixed(np.array([e], np.uint64) + np.array([j + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0])
            k = j + (bits & 0xFFFFFFFF) % (m - j)
            order[j], order[k] = order[k], order[j]
            want[order[j]] = min(want[order[j]], (bits >> 32) / 2**32 + j)
    assert np.array_equal(minhash.signature(elements, m), want)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bands_miss_one_in_a_million(percent):
    rows, count = minhash.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** count <= 1e-6


@pytest.mark.parametrize("told", [10**6, 0])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, told):
    monkeypatch.setattr(components, "MOST_TOLD", told)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 600)]
    links = chain + star + [(7, 7), (9, 8), (8, 9), (3, 1), (2, 3), (None, 4)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 600)} == {500}
    assert got[9] == got[8] == 8 and got[1] == got[2] == got[3] == 1 and 7 not in got


# Mixing.

def test_mixing_meets_the_targets(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_mixing"](spark, folder).collect()
    assert len(rows) == _documents(spark, folder).count()
    total = sum(r.n_tokens for r in rows)
    for name, weight in mixing.TARGETS.items():
        share = sum(r.n_tokens * r.rate * r[f"p_{name.replace('-', '_')}"] for r in rows) / total
        assert abs(share - weight) < 2e-4
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)


def test_replayed_rates_are_those_of_a_solver_that_stores_them():
    """Replaying the moves gives the stored rates, and they meet targets that zero rates are needed for."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3] * 3, 500)
    n = rng.integers(1, 100, 500).astype(float)
    target, rates, steps = np.array([0.7, 0.25, 0.05]), np.ones(500), []
    for _ in range(60):
        measure = np.linalg.inv((p * (n * (rates > 0))[:, None]).T @ p / n.sum())
        move = measure @ (rates * n @ p / n.sum() - target)
        steps.append(move)
        rates = np.maximum(rates - p @ move - mixing.RIDGE * (rates - 1), 0)
    assert np.allclose(mixing.replay(p, steps), rates) and np.abs(rates * n @ p / n.sum() - target).max() < 1e-3


def _nonnegative_least_squares(a, target, weight, sweeps=4000):
    """min |a r - target|^2 + sum weight (r - 1)^2 over r >= 0, one coordinate at a time."""
    rates = np.ones(a.shape[1])
    left = a @ rates - target
    for _ in range(sweeps):
        for i in range(len(rates)):
            best = max(0.0, rates[i] - (a[:, i] @ left + weight[i] * (rates[i] - 1)) / (a[:, i] @ a[:, i] + weight[i]))
            left += a[:, i] * (best - rates[i])
            rates[i] = best
    return rates, left


@pytest.mark.parametrize("target", [[0.7, 0.25, 0.05], [0.2, 0.2, 0.6]])
def test_mixing_against_an_independent_solution(spark, target):
    rng = np.random.default_rng(7)
    p, n = rng.dirichlet([0.4] * 3, 60), rng.integers(5, 90, 60)
    table = spark.createDataFrame([(int(c), x.tolist()) for c, x in zip(n, p)], "n_tokens long, posteriors array<double>").repartition(3)
    steps, residual = mixing.solve(table, target)
    a = (p * n[:, None]).T / n.sum()
    _, left = _nonnegative_least_squares(a, np.array(target), np.full(60, 1e-9))
    rates = mixing.replay(p, steps)
    assert np.abs(left).max() < 1e-3 and np.abs(a @ rates - target).max() < 1e-3 and (rates >= 0).all()
    assert np.abs(a @ rates - target - residual).max() < 1e-3 and mixing.short_domains(["a", "b", "c"], residual) == {}


def test_mixing_shows_a_domain_that_nothing_supplies_and_passes_that_run_out(spark, monkeypatch):
    rng = np.random.default_rng(8)
    p = np.column_stack([rng.dirichlet([0.5] * 2, 50), np.zeros(50)])
    rows = [(10, x.tolist()) for x in p]
    table = spark.createDataFrame(rows, "n_tokens long, posteriors array<double>")
    _, residual = mixing.solve(table, [0.5, 0.4, 0.1])
    assert mixing.short_domains(["a", "b", "c"], residual) == {"c": pytest.approx(-0.1, abs=1e-3)}
    monkeypatch.setattr(mixing, "MOST_PASSES", 1)
    with pytest.raises(RuntimeError, match="did not settle in 1 passes"):
        mixing.solve(table, [0.95, 0.05, 0.0])


def test_mixing_odd_documents(spark):
    docs = plain.odd_documents(spark)
    labels = spark.createDataFrame([(7, 1, 0), (10, 0, 0), (99, 1, 1), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    mixed = mixing.mix(docs, labels, mixing.TARGETS).collect()
    assert len(mixed) == docs.count() and all(np.isfinite(r.rate) for r in mixed)
    again = mixing.resample(docs, labels)
    assert again.schema == docs.schema
    assert mixing.mix(docs.limit(0), labels, mixing.TARGETS).count() == 0
    none = mixing.mix(docs, labels.limit(0), {"quality1-toxic0": 1.0}).collect()
    assert all(abs(r.rate - 1) < 1e-3 for r in none)


# Language.

def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op6_language"](spark, folder).join(_documents(spark, folder).select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97 and np.mean([r.rejected for r in rows]) < 0.01


def test_foreign_text_is_rejected_on_few_rows(spark):
    model = language.train(language.examples(_documents(spark, "/root/testdata/sf0.01")))
    foreign = ["路尽头的老房子是住在那里的人的父亲建造的", "Το παλιό σπίτι στο τέλος του δρόμου", "पुराना घर सड़क के अंत में है"]
    scores = [model.predict(t)[1] for t in foreign]
    assert model.threshold > 1 / len(model.languages) and min(scores) < model.threshold, (scores, model.threshold)


def test_language_of_odd_documents(spark):
    docs = plain.odd_documents(spark)
    kept = language.keep_known(docs)
    assert kept.schema == docs.schema
    model = language.train(language.examples(docs))
    found = {r.doc_id: r for r in language.with_language(docs.select("doc_id", "text"), model).collect()}
    for i in (1, 2, 3, 13):
        assert (found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True)
    assert language.train([]).predict("some text") == ("und", 0.0)
    assert language.keep_known(docs.limit(0)).count() == 0


def test_long_texts_are_read_whole():
    table = np.random.default_rng(0).normal(size=(language.BUCKETS, 2))
    text = "abc déf, 12 Xy!! " * 4_000
    whole = language.subwords(text)
    cleaned = " " + " ".join(["abc déf xy"] * 4_000) + " "
    assert len(whole) == 3 * len(cleaned) - 3
    monkey = language.BLOCK
    try:
        for language.BLOCK in (1, 7, 1000):
            assert sorted(np.concatenate(list(language.blocks(text)))) == sorted(whole)
            assert np.allclose(language.class_scores(text, table), table[whole].mean(axis=0), atol=1e-9)
    finally:
        language.BLOCK = monkey


# Licences.

LICENSES = [
    (40, "Licensed under the Apache License, Version 2.0. MIT-License. GNU General Public\nLicense CC-BY cc by", "en", "s", 1),
    (41, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause */", "en", "s", 1),
    (42, "gnu gnu general public license license mit mit license émit license", "en", "s", 1),
    (43, "spdx license identifier", "en", "s", 1),
]


def test_licenses(spark, sf):
    odd = plain.odd_documents(spark, LICENSES)
    for docs in (odd, _documents(spark, sf)):
        texts = [(r.doc_id, plain.licenses(r.text)) for r in docs.collect()]
        got = [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in licenses.scan(docs).collect()]
        assert sorted(map(str, got)) == sorted(map(str, texts))
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(odd).collect()}
    assert found[41] == ("bsd,gpl,mit", 1.0) and found[43] == ("", 0.0) and found[1] == ("", 0.0)
    assert found[40] == ("apache,cc-by,gpl,mit", 0.3)
    assert licenses.scan(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text, want", [
    ("MIT", ({"mit"}, 1.0)), ("MIT AND GPL-3.0", ({"mit", "gpl"}, 0.3)), ("GPL-2.0 OR MIT AND AGPL-3.0", ({"gpl", "mit", "agpl"}, 0.3)),
    ("(GPL-2.0 OR MIT) AND AGPL-3.0", ({"gpl", "mit", "agpl"}, 0.2)), ("GPL-2.0 WITH Classpath-exception", ({"gpl"}, 0.6)),
    ("", None), ("AND", None), ("((", None), ("MIT AND", ({"mit"}, 1.0)), ("MIT) x", ({"mit"}, 1.0)), ("(MIT", ({"mit"}, 1.0)),
    ("MIT */ AND GPL", ({"mit"}, 1.0)), ("Own-1.0", ({"own-1.0"}, licenses.UNKNOWN)), ("MIT OR (GPL-2.0 AND", ({"mit", "gpl"}, 1.0)),
])
def test_license_expressions(text, want):
    assert licenses.evaluate(text) == want


def test_automaton_finds_overlapping_phrases():
    found = licenses.Automaton(["a b a", "b a", "a"]).find("a b a b a x a".encode().split())
    assert sorted(found) == sorted([(0, "a"), (0, "a b a"), (1, "b a"), (2, "a"), (2, "a b a"), (3, "b a"), (4, "a"), (6, "a")])


# Pages.

def test_pages_against_their_marked_articles(spark):
    import html as entities
    import re

    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op9_html"](spark, folder).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        inside = re.sub(r"<script.*?</script>|<!--.*?-->", "", inside, flags=re.S)
        assert r.text == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inside)).split()) and r.n_chars == len(r.text)


LONG = "The house at the end of the road was built by the father of the man who lives in it, and it is as old as the town. "


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a &lt;b&gt; &eacute;&nbsp;c</p>", "a <b> é c"),
    (f"<div class='sidebar'><p>{LONG}</p></div><p>{LONG}</p><form>{LONG}</form>", LONG.strip()),
    (f"<nav>x</nav><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><footer>{LONG}</footer>", f"Title {LONG}Short. {LONG}".strip()),
    (f"<p>{LONG}</p><div id=comments><p>{LONG * 3}</p></div>", LONG.strip()),
    (f"<article><p>{LONG}</p><p>x<b>y</b>z</p><aside>no</aside></article><p>{LONG}</p>", f"{LONG}xyz".strip()),
    (f"<p><a href='x'>{LONG}</a></p><p>{LONG}</p>", LONG.strip()),
    (f"<script>if (a < b) '<p>{LONG}</p>'</script><p>{LONG}<!-- <p>no</p> --></p><style>p{{}}", LONG.strip()),
    ("<div class=\"cookie-notice\">" + LONG + "</div><main><p>One.</p></main>", "One."),
    ("<p title='a>b'>In < out", "In < out"),
])
def test_page_cases(page, want):
    assert html.main_text(page) == want


RUSSIAN = ("Старый дом в конце дороги построил отец человека, который живёт там до сих пор, и дом этот не моложе города. " * 3).strip()
CHINESE = "路尽头的老房子是住在那里的人的父亲建造的它和这座城市一样古老" * 8


@pytest.mark.parametrize("page, want", [
    (f"<nav>x</nav><h1>Дом</h1><p>{RUSSIAN}</p><p>Коротко.</p><p>{RUSSIAN}</p><footer>{RUSSIAN}</footer>", f"Дом {RUSSIAN} Коротко. {RUSSIAN}"),
    (f"<p>{CHINESE}</p><p>短。</p><p><a href=x>{CHINESE}</a></p>", f"{CHINESE} 短。"),
    (f"<p>{RUSSIAN[:100].strip()} <a href=x>там</a></p>", f"{RUSSIAN[:100].strip()} там"),
    (f"<article><p>{LONG}</p><ul><li><a href=x>A reference</a></li></ul></article>", f"{LONG}A reference"),
])
def test_pages_in_other_scripts_and_linked_articles(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<div class='content has-sidebar no-comments with-header'><p>{LONG}</p></div>", LONG.strip()),
    (f"<article class='post has-comments category-social'><p>{LONG}</p></article><p>{LONG}</p>", LONG.strip()),
    (f"<article><div class='entry-header'><h1>Title</h1></div><p>{LONG}</p></article>", f"Title {LONG}".strip()),
    (f"<div class='layout-sidebar'><p>{LONG * 3}</p></div><p>{LONG}</p>", f"{LONG * 4}".strip()),
    (f"<p>{LONG * 2}</p><div class='site-sidebar'><p>{LONG}</p></div>", f"{LONG * 2}".strip()),
    (f"<p>{LONG}</p><div id='comments-area'><article class='comment-body'><p>{LONG * 3}</p></article></div>", LONG.strip()),
])
def test_pages_with_marks_that_only_tell_the_layout(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<html><head><title>T</title><meta x=y><body><p>{LONG}</p>", LONG.strip()),
    (f"<head><title>T</title><style>p</style><p>{LONG}</p><p>{LONG}</p>", f"{LONG * 2}".strip()),
    (f"<article><p>{LONG}<svg><path d=x><p>{LONG}</p><video src=x><p>{LONG}</p><object><canvas><p>{LONG}</p></article>", f"{LONG * 4}".strip()),
    (f"<article><p>{LONG}</p><svg><text>no</text></svg><video>no</video><p>{LONG}</p></article>", f"{LONG * 2}".strip()),
    (f"<body><form method=post><nav>{LONG}</nav><p>{LONG}</p><p>{LONG}</p><footer>{LONG}</footer></form>", f"{LONG * 2}".strip()),
    (f"<p>{LONG * 2}</p><form><p>{LONG}</p><input name=x></form>", f"{LONG * 2}".strip()),
    (f"<form class=search><p>{LONG * 2}</p></form><p>{LONG}</p>", LONG.strip()),
    (f"<header><p>{LONG}</p></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>", f"Title {LONG}".strip()),
    (f"<article><p>{LONG} 1 <2 and 3> 2 <b>bold</b></p></article>", f"{LONG} 1 <2 and 3> 2 bold".replace("  ", " ")),
])
def test_pages_with_missing_ends_forms_and_own_headers(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("unit", ["<a ", "</b>", "<b></i>", "<svg>", "<!", "<div><i></b>", "<nav><article></article>", "<a '", "<p><b>", "<form>x"])
def test_broken_pages_take_seconds(unit):
    begin = time.time()
    html.main_text(unit * (1_000_000 // len(unit)))
    assert time.time() - begin < 20


def test_pages_without_article_tags_keep_most_of_their_text(spark):
    import re

    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").limit(120)
    whole = {r.page_id: r.text for r in html.extract(pages).collect()}
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    found, wanted, got = 0, 0, 0
    for r in html.extract(bare).collect():
        want, have = set(whole[r.page_id].split()), set(r.text.split())
        found, wanted, got = found + len(want & have), wanted + len(want), got + len(have)
    assert found / wanted > 0.9 and found / max(got, 1) > 0.9, (found / wanted, found / max(got, 1))


def test_pages_with_nulls_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, None, None, "t", 5), (None, "u", f"<p>{LONG}</p>", "t", 5), (1, None, None, "t", 5)],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html.extract(pages).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, None, "", 0), (1, None, "", 0), (None, "u", LONG.strip(), len(LONG) - 1)]))
    assert html.extract(pages.limit(0)).count() == 0


# Repeats.

def _cut(docs, **kwargs):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.digest) for r in
            suffixes.remove_repeats(docs, **kwargs).withColumn("digest", F.sha2("kept_bytes", 256)).collect()}


def test_op10_query(spark, sf):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffixes"](spark, sf).collect()}
    assert got == plain.repeats([(r.doc_id, r.text) for r in _documents(spark, sf).collect()])


@pytest.mark.parametrize("hot", [suffixes.HOT_WINDOWS, 2])
def test_repeats_of_built_texts(spark, hot):
    rng = np.random.default_rng(6)
    passages = ["".join(rng.choice(list("abcdefé "), 80)) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (6, "ab" * 200), (7, "zz" + "ab" * 90 + "yy")]
    for i in range(8, 60):
        picked = [passages[k] for k in rng.integers(0, 4, rng.integers(0, 4))]
        noise = ["".join(rng.choice(list("ghijkl"), rng.integers(0, 30))) for _ in range(4)]
        rows.append((i, "".join(a + b for a, b in zip(noise, [*picked, ""] * 4))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert _cut(docs, hot_windows=hot) == plain.repeats(rows)


def test_repeats_of_odd_documents(spark):
    docs = plain.odd_documents(spark)
    done = suffixes.remove_repeats(docs)
    assert set(done.columns) == set(docs.columns) | {"n_bytes", "n_removed", "n_spans", "kept_bytes"}
    got = {r.doc_id: r for r in done.collect()}
    assert done.count() == docs.count() and got[None].n_removed == 0 and got[7].n_removed == 0
    assert got[8].n_removed == got[8].n_bytes and got[1].n_bytes == 0 and got[12].n_removed == 0
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("pattern", ["=", "abcdefg"])
def test_long_run_of_a_pattern_in_small_pieces(spark, pattern):
    """30 MB of one pattern: its windows travel in pieces that collapse, and no task holds them all."""
    n = 30_000_000 // len(pattern)
    docs = spark.createDataFrame([(1, pattern * 60), (2, pattern * n), (3, "own text " + pattern * 9)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed").collect()}
    assert got[1][1] == 0 and got[2] == (len(pattern) * n,) * 2
    assert got[3][1] == (0 if pattern == "=" else 63)


def test_small_pieces_and_cells_lose_nothing(spark, sf, monkeypatch):
    monkeypatch.setattr(suffixes, "MOST_WINDOWS", 7)
    monkeypatch.setattr(suffixes, "CELL_WINDOWS", 900)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 40_000)
    rows = [(r.doc_id, r.text) for r in _documents(spark, sf).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _cut(docs) == plain.repeats(rows)


def test_one_python_process_in_each_task_of_the_cells(spark, sf, monkeypatch):
    """The spans come from the cells' own function: no Python operator stands upon another in a task."""
    plans, original = {}, suffixes.materialise

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return original(df, name)

    monkeypatch.setattr(suffixes, "materialise", noted)
    suffixes.repeated_spans(_documents(spark, sf))
    assert plans["repeats"].index("FlatMapGroupsInArrow") < plans["repeats"].index("MapInArrow")
    # A text with very many copies meets its first one in a join whose sides are both shuffled just for it.
    assert "suffix-copied" in plans


def test_rows_that_share_an_id_lose_bytes_by_their_own_text(spark):
    a, b = "".join(f"{i}, " for i in range(40)), "".join(f"{i}; " for i in range(40))
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (3, b + a[:60] + b), (3, "own " * 20)], "doc_id long, text string")
    got = {(r.doc_id, r.text): r.n_removed for r in suffixes.remove_repeats(docs).collect()}
    assert got == {(1, a): 0, (2, b): 0, (3, a): len(a), (3, b + a[:60] + b): 2 * len(b) + 60, (3, "own " * 20): 0}


def test_places_and_runs_meet_only_where_something_is_lost():
    """The stretches of each place, against every window of every place; one of a fragment for each place that loses all."""
    rng = np.random.default_rng(3)
    for _ in range(100):
        rows = rng.integers(0, 5)
        of_row, runs = rng.integers(1, 6, rows), rng.integers(1, 7, rows)
        ids, starts = rng.integers(-3, 9, of_row.sum()), rng.integers(0, 50, of_row.sum())
        counts, least = rng.integers(1, 5, runs.sum()), rng.integers(-3, 9, runs.sum())
        want, row_of_run = [], np.repeat(np.arange(rows), runs)
        for place, row in enumerate(np.repeat(np.arange(rows), of_row)):
            mine = row_of_run == row
            lost = np.repeat(least[mine], counts[mine]) < ids[place]
            edges = np.diff(np.concatenate([[0], lost.astype(int), [0]]))
            ends = np.flatnonzero(edges == -1) + suffixes.WINDOW - 1
            want += [(place, starts[place] + a, starts[place] + b) for a, b in zip(np.flatnonzero(edges == 1), ends)]
        assert sorted(zip(*suffixes.lost_spans(ids, of_row, starts, counts, runs, least))) == sorted(want)
    n = 3000
    places = suffixes.lost_spans(np.arange(n) + n, np.array([n]), np.zeros(n, int), np.ones(n, int), np.array([n]), np.arange(n))
    assert np.array_equal(places[0], np.arange(n)) and set(places[2]) == {n + suffixes.WINDOW - 1}


def test_equal_windows_have_equal_first_digits():
    rng = np.random.default_rng(8)
    shared = rng.integers(97, 100, 120).astype(np.uint8)
    a, b = (np.concatenate([rng.integers(97, 123, n).astype(np.uint8), shared]) for n in (33, 70))
    assert np.array_equal(suffixes.first_digits(a)[33:], suffixes.first_digits(b)[70:])
    want = [suffixes.first_digits(a[i:i + 50])[0] for i in range(len(a) - 49)]
    assert suffixes.first_digits(a).tolist() == want


# The pipeline.

def test_pipeline_stage_by_stage(spark, sf):
    docs = _documents(spark, sf)
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    items = [plain.item_words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}

    known = corpus_pipeline.materialise(steps["language"](spark, docs, sf), "test")
    assert known.columns == names and known.count() >= 0.99 * docs.count()
    single = corpus_pipeline.materialise(steps["near_duplicates"](spark, known, sf), "test")
    want = plain.groups([(r.doc_id, r.text) for r in known.collect()], 5, 80)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in want.items() if i == c}
    clean = corpus_pipeline.materialise(steps["decontamination"](spark, single, sf), "test")

    def leaks(text):
        w = plain.item_words(text)
        return any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect() if not leaks(r.text)}
    mixed = corpus_pipeline.materialise(steps["mixing"](spark, clean, sf), "test")
    assert mixed.columns == names and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    dealt = steps["sharding"](spark, mixed, sf)
    rows = dealt.collect()
    assert len(rows) == mixed.count() and set(dealt.columns) == {*names, "shard", "slot"}
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)



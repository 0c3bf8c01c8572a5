"""Operators that learn, and extraction: invariants, brute-force parts and held-out results."""

from __future__ import annotations

import math
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from meterbook.llm import html_extract, lm_score, quality_classifier, toxicity
from meterbook.llm.line_dedup import without_repeated_lines
from tests.llm.helpers import ODD, SCHEMA, corpus, documents, prose, words


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Home</a></header>
    <ul id="menu"><li><a href=a>One</a><li><a href=b>Two</a></ul><div class="cookie-notice">We use cookies on this site and it is for the good of all of you who are with us.</div>
    <div class="content"><h2>Big title</h2><p>The fox is in the garden and it was not of the kind that we have seen before on this side of the river, as they say.
    <p>Short one.<p>Tom &amp; J&eacute;r<b>ry</b> went &#8212; home.<br>Then   slept.</div><script>var x = "</p>";</script>
    <aside><p>The other story of the day that is to be read by all of you who are with us.</p></aside><form><p>Send it to us as soon as it is done by you, for it is what we are here for.</p></form>
    <section id="comments"><p>I think that this is the best of all that I have read on the site, and it was a joy.</p></section><footer>&copy; 2020</footer></body>"""
    assert html_extract.main_text(page) == (
        "Big title The fox is in the garden and it was not of the kind that we have seen before on this side of the river, as they say. "
        "Short one. Tom & Jérry went — home. Then slept."
    )
    assert [html_extract.main_text(x) for x in (None, "", "  ", "<!-- open", "<script>x", "<p>a < b</p>")] == ["", "", "", "", "", "a < b"]


FOX = "The fox is in the garden and it was not of the kind that we have seen before on this side of the river, as they say."
HILL = "It was on the other side of the hill that they had seen it, and he is not the one who was with them, as it is known."


def test_main_text_after_elements_that_are_not_shown():
    for page, text in (
        (f"<html><head><title>x</title><body><article><p>{FOX}</article>", FOX),
        (f"<head><title>x</title><article><p>{FOX}</article>", FOX),
        (f'<body><p>{FOX}</p><svg class="icon"/><p>{HILL}</p>', f"{FOX} {HILL}"),
        (f'<body><p>{FOX}</p><svg class="icon"><path d="1"><p>{HILL}</p>', f"{FOX} {HILL}"),
        (f"<body><div>{FOX}<svg><style/><text>x</text></svg> {HILL}</div>", f"{FOX} {HILL}"),
        (f"<body><p>{FOX} <math/> {HILL}</p>", f"{FOX} {HILL}"),
        (f"<body><div><video src=x>No video.</div><p>{HILL}</p>", HILL),
        (f"<div><select><option>a<option>b</div><p>{HILL}</p>", HILL),
        (f"<template><div>{FOX}</div></template><p>{HILL}</p>", HILL),
        (f"<svg><foreignObject><p>{FOX}</p></foreignObject></svg><p>{HILL}</p>", HILL),
    ):
        assert html_extract.main_text(page) == text, page


def test_short_blocks_beside_excluded_ones():
    aside = '<aside>x</aside><table><tr><td>1</td><td>2</td></tr></table><div class="share">s</div><figure><figcaption>cap</figcaption></figure>'
    for between, text in (('<div class="ad">x</div><ul><li>a</li><li>b</li></ul>', "a b"), (aside, "1 2 cap")):
        for start, end in (("<article>", "</article>"), ('<body><div class="content">', "</div>")):
            assert html_extract.main_text(f"{start}<p>{FOX}</p>{between}<p>{HILL}</p>{end}") == f"{FOX} {text} {HILL}"


def test_names_inside_an_article_and_unlisted_languages():
    for inner, text in (
        (f'<p class="teaser">{HILL}</p>', HILL), (f'<p class="share-price">{HILL}</p>', HILL), (f'<div class="search-results"><p>{HILL}</p></div>', HILL),
        (f'<div class="ad-box"><p>{HILL}</p></div>', ""), (f'<div id="related"><p>{HILL}</p></div>', ""), (f'<div class="wide shareButtons">{HILL}</div>', ""),
        (f'<section class="comment-thread"><p>{HILL}</p></section>', ""), (f'<div class="related-articles"><p>{HILL}</p></div>', ""),
    ):
        assert html_extract.main_text(f"<article><p>{FOX}</p>{inner}</article>") == f"{FOX} {text}".strip(), inner
    finnish = "Kettu juoksi eilen puutarhan halki joelle, jonka toisella puolella asuvat ihmiset katselivat hiljaa ikkunoistaan sateista maisemaa."
    chinese = "昨天傍晚狐狸穿过花园跑向河边，" * 6
    for words in (finnish, chinese):
        page = f'<body><ul id="menu"><li><a href=a>One</a></ul><div><p>{words}</p><p>Lyhyt.</p><p>{words}</p></div><footer><p>{words}</p></footer></body>'
        assert html_extract.main_text(page) == f"{words} Lyhyt. {words}"


def test_extract_rows(spark):
    rows = [(1, "u", "<article><p>x y</p></article>", 5), (1, "u", "<article><p>x y</p></article>", 5), (None, None, None, 5)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("x y", 3), ("x y", 3)]


def test_kth_largest(spark):
    values = [0.5, 0.5, 0.5, -3.25, 1e9, 7.0, 7.0, -1e-300]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    for k in range(1, len(values) + 1):
        assert quality_classifier.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_resampling_rejects_what_looks_like_bad_labels(spark):
    good = [prose(i, 120) for i in range(80)]
    bad = [" ".join(w + "%%%" for w in prose(300 + i, 120).split()) for i in range(40)]
    docs = documents(spark, good + bad + [None, ""])
    labels = spark.createDataFrame([(i, 1, None) for i in range(40)] + [(80 + i, 0, 1) for i in range(20)] + [(None, 1, 1), (999, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["selected"] for r in quality_classifier.resample(docs, labels).collect()}
    assert len(got) == 122
    assert not any(got[i] for i in range(80, 120))
    assert sum(got[i] for i in range(80)) == 80
    kept = quality_classifier.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s}


def test_resampling_without_labels_keeps_all(spark):
    docs = documents(spark, corpus())
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_classifier.keep_selected(docs, none).count() == docs.count()
    assert quality_classifier.resample(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_lm_counts_and_base(spark):
    texts = corpus() + [prose(i, 150) for i in range(100, 160)]
    got = {r["doc_id"]: r for r in lm_score.score(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    counts = Counter(w for i, t in enumerate(texts) if not held[i] for w in [*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        w, r = [*words(t), None], got[i]
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(counts[x] > 0 for x in w), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def test_lm_probabilities_sum_to_one():
    model = lm_score.LogBilinear(np.arange(lm_score.CLASSES, dtype=float))
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 5, 4000)
    where = np.array([0, 1000, 4000])
    model.train(stream, *lm_score.contexts(stream, where), rng, {})
    one, two = 3, lm_score.BEGIN
    scores = (model.context[one] * model.near + model.context[two] * model.far) @ model.target.T + model.bias
    assert math.isclose(np.exp(scores - model.normaliser(one)[two]).sum(), 1, rel_tol=1e-4)


def test_lm_learns_order():
    """After training on a cycle the next class is likely, whatever its frequency."""
    stream = np.tile(np.array([1, 2, 3]), 4000)
    model = lm_score.LogBilinear(np.bincount(stream, minlength=lm_score.CLASSES).astype(float))
    where = np.array([0, len(stream)])
    model.train(stream, *lm_score.contexts(stream, where), np.random.default_rng(2), {})
    scores = (model.context[2] * model.near + model.context[1] * model.far) @ model.target.T + model.bias
    assert np.exp(scores[3] - model.normaliser(2)[1]) > 0.6


def test_subsequence_kernel_against_all_subsequences():
    from itertools import combinations

    def slow(s: str, t: str) -> float:
        weights: list[dict] = []
        for x in (s, t):
            found: dict = {}
            for places in combinations(range(len(x)), toxicity.LENGTH):
                key = "".join(x[i] for i in places)
                found[key] = found.get(key, 0) + toxicity.DECAY ** (places[-1] - places[0] + 1)
            weights.append(found)
        return sum(v * weights[1].get(k, 0) for k, v in weights[0].items())

    for s, t in (("idiot", "idxiot"), ("abcabc", "acb"), ("ab", "abc"), ("moron", "moron")):
        fast = toxicity.kernel(toxicity.codes_of([s, "zzzzzz"]), toxicity.codes_of([t]))[0]
        assert math.isclose(fast, slow(s, t), rel_tol=1e-4, abs_tol=1e-7)


def _abuse(n: int) -> tuple[list, list]:
    texts, labels = [], []
    for i in range(n):
        text = prose(i, 60)
        if i % 4 == 0:
            w = text.split()
            w[10], w[30] = ("grumbold", "snarfle.") if i % 8 else ("snarfle", "grumbold,")
            text = " ".join(w)
        texts.append(text)
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_toxicity_on_held_out_rows_and_gapped_words(spark):
    texts, labels = _abuse(200)
    odd = ["", None, "such a GRUM-BOLD and s-n-a-r-f-l-e you are", "g r u m b o l d and s n a r f l e you are", "x" * 4000]
    docs = documents(spark, texts + odd)
    rows = [(i, 1, y) for i, y in enumerate(labels)] + [(None, 1, 1), (5000, 0, 1)]
    got = {r["doc_id"]: r for r in toxicity.score(docs, spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")).collect()}
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held)
    assert np.mean([got[i]["predicted"] == labels[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[200 + i]["predicted"] for i in range(5)] == [0, 0, 1, 1, 0]


def test_inserted_letters_are_similar():
    marks = toxicity.Landmarks(["idiot", "loser", "disgusting"])
    altered = ["ixdxixoxt", "ixxdxxixxoxxt", "lqowsherr", "dbihsjgkulswtmipnyg", "ibdicot"]
    similar = marks.similarities(altered)
    assert (similar[range(5), [0, 0, 1, 2, 0]] > 0.8).all()
    assert (marks.similarities(["les", "los", "edition", "resolution", "dugongs", "tsetse"]) < 0.5).all()


def test_toxicity_of_words_with_inserted_letters(spark):
    texts, labels = _abuse(200)
    odd = ["such a gxrxuxmxbxoxlxd and sqnqaqrqfqlqe you are", "a gruhmwbojlyd or a snvavrvflve it is", prose(901, 40)]
    rows = [(i, 1, y) for i, y in enumerate(labels)]
    got = toxicity.score(documents(spark, texts + odd), spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")).collect()
    assert [next(r["predicted"] for r in got if r["doc_id"] == 200 + i) for i in range(3)] == [1, 1, 0]


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(documents(spark, corpus()), none).collect()} == {0.0}
    assert toxicity.score(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_sentences_of_a_batch():
    marks = toxicity.Landmarks(["idiot", "moron"])
    found = list(toxicity.Reader(marks).sentences(pa.array(["You idiot! Fine.\nA moron, an idiot.", None, "nothing", "IDIOT"])))
    rows, similar = found[0]
    assert rows.tolist() == [0, 0, 3]
    assert (similar > 0.99).tolist() == [[True, False], [True, True], [True, False]]


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, last, small)
        assert result.columns == docs.columns, name
        assert result.count() <= last.count()
        last = spark.createDataFrame(result.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, last, small)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in last.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_join", "decontamination", "packing"]


def test_every_row_is_scored_also_a_repeated_one(spark):
    docs = documents(spark, [*ODD, *(prose(i, 60) for i in range(10))])
    twice = docs.unionAll(docs.where("doc_id % 3 = 0"))
    got = lm_score.score(twice).collect()
    assert len(got) == twice.count()
    assert len({(r["doc_id"], r["base_score"], r["score"], r["n_known"]) for r in got}) == docs.count()


def test_objects_travel_to_executors_without_this_package(spark, tmp_path):
    from meterbook.llm.tables import send

    script = "import pickle, sys; print(type(pickle.loads(sys.stdin.buffer.read())).__name__, 'meterbook' in sys.modules)"
    done = subprocess.run([sys.executable, "-I", "-c", script], input=send(spark, lm_score.LogBilinear(np.ones(4))).value, capture_output=True, cwd=tmp_path)
    assert done.stdout.split() == [b"LogBilinear", b"False"], done.stderr


def test_columns_of_any_name_and_ids_with_several_texts(spark):
    rows = [(0, "shared line of some words", 1, 2, 3), (5, "the only copy of it", 1, 2, 3), (5, "shared line of some words", 1, 2, 3), (None, "alone", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _stay int, _gone int, _log_weight int")
    kept = without_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == ["alone", "shared line of some words", "the only copy of it"]
    one = docs.where("doc_id = 0").withColumn("_row", F.lit(1))
    assert without_repeated_lines(one).count() == 1
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_classifier.keep_selected(docs.withColumn("_id", F.lit(3)), labels).columns == [*docs.columns, "_id"]


def test_kernel_does_the_same_few_steps_for_long_units(monkeypatch):
    """Array operations over all places at once, not one for each pair of places."""

    def steps(width: int) -> int:
        units, count = toxicity.codes_of(["ab" * (width // 2)]), 0

        def seen(frame, event, arg):
            nonlocal count
            count += event == "c_call"

        sys.setprofile(seen)
        try:
            toxicity.kernel(units, units)
        finally:
            sys.setprofile(None)
        return count

    assert steps(24) == steps(4)
    s, t = (toxicity.codes_of([a + b + c for a in "abx" for b in letters for c in "byz"]) for letters in ("bc", "cb"))
    whole = toxicity.kernel(s, t), toxicity.kernel(s, t[:1])
    monkeypatch.setattr(toxicity, "KERNEL_ROWS", 4)
    assert np.array_equal(whole, (toxicity.kernel(s, t), toxicity.kernel(s, t[:1])))


def test_sums_of_rare_tokens_leave_packed():
    """A row for each bucket of documents; every document has one row with its whole sum in the end."""
    vocabulary = [lm_score._pack(0, np.full(2, b), np.array([10 + b, 20 + b], np.uint64), np.array([9, 0])) for b in (0, 1)]
    documents = np.arange(-500, 500)
    entries = [lm_score._pack(1, np.full(1000, b), np.full(1000, 10 + b, np.uint64), documents) for b in (0, 1)]
    entries += [lm_score._pack(1, np.full(1, 1), np.full(1, 99, np.uint64), np.full(1, 7000))]  # not in the vocabulary
    batches = [vocabulary[0], entries[0], vocabulary[1], *entries[1:]]
    packed = list(lm_score._rare_sums(8)(iter(batches)))
    assert sum(map(len, packed)) == 8
    table = pa.Table.from_batches(packed).sort_by("bucket")
    rows = [r for b in lm_score._sums_by_document(iter(table.to_batches())) for r in b.to_pylist()]
    assert sorted(r["row_key"] for r in rows) == documents.tolist()
    assert {(r["known"], r["logs"]) for r in rows} == {(2, 2.0)}

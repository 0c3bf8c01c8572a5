"""Operators with an exact meaning, held against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterbook.llm import decontaminate, packing, quality_rules, url_filter
from meterbook.llm import text as tx
from meterbook.llm.components import components, group_members, parity_sketch, plausible, wide_sketch
from meterbook.llm.line_dedup import _similar, content, line_classes, shingle_set, without_repeated_lines
from meterbook.llm.ngram_join import one_of_each, similar_documents
from meterbook.llm.queries import tokenizer_file
from tests.llm.helpers import SCHEMA, close_pairs, corpus, documents, least_of_component, prose, shingles, words


def test_words_and_shingles_on_bytes():
    rows = [*corpus(), "x\x0by\x1cz w", " lead", "trail ", "A" * 3 + "É"]
    data, places = tx.texts(pa.array(rows, pa.string()))
    hashes, at = tx.word_hashes(data, places)
    names: dict = {}
    for i, row in enumerate(rows):
        expected = words(row)
        assert at[i + 1] - at[i] == len(expected)
        for word, h in zip(expected, hashes[at[i] : at[i + 1]].tolist(), strict=True):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    found, bounds = tx.shingles(hashes, at)
    for i, row in enumerate(rows):
        assert len(set(found[bounds[i] : bounds[i + 1]].tolist())) == len(shingles(row))


def test_stretches_of_a_long_text_agree(monkeypatch):
    data, places = tx.texts(pa.array([prose(5, 3000), "ab cd", None, "é " * 50]))
    whole = tx.word_endings(data, places)
    monkeypatch.setattr(tx, "STRETCH", 64)
    assert all((a == b).all() for a, b in zip(whole, tx.word_endings(data, places), strict=True))


def test_components(spark):
    random.seed(3)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(500, i) for i in range(501, 700)] + [(7, 7), (None, 3)]
    links += [(i, i + 1) for i in range(1000, 1040)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5))
    got = {r["node"]: r["component"] for r in found.collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == least_of_component({x for p in real for x in p}, real)


def test_ngram_join(spark):
    texts = corpus()
    docs = documents(spark, texts)
    docs = docs.unionAll(docs.where("doc_id in (0, 12)")).repartition(4)  # repeated rows
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    least = least_of_component(sets, close_pairs(sets))
    got = {tuple(r) for r in similar_documents(docs).collect()}
    assert got == {(i, len(sets[i]), least[i]) for i in sets}


def test_similar_documents_of_ids_with_several_texts(spark):
    one, two, three = prose(1, 90), prose(2, 90), prose(3, 90)
    near = two.rsplit(" ", 1)[0]
    rows = [(1, one), (5, one), (5, near), (7, two), (9, one[:300]), (11, three), (13, prose(4, 90)), (15, three), (15, prose(4, 90)), (17, prose(5, 90))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    linked = close_pairs({i: shingles(t) for i, (_, t) in enumerate(rows)})
    least = least_of_component({d for d, _ in rows}, [(rows[i][0], rows[j][0]) for i, j in linked])
    assert (least[7], least[5], least[13], least[15], least[17]) == (1, 1, 11, 11, 17)
    got = similar_documents(docs).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(least.items())


def test_large_sets_are_told_apart_by_wide_sketches(spark):
    """Sets too large for the fixed sketch: unrelated ones go, similar ones stay, also where the sizes of their sketches differ."""
    pool = np.random.default_rng(7).integers(0, 1 << 63, 40_000, np.uint64)
    sets = {1: pool[:6000], 2: pool[5000:11_000], 3: pool[20_000:24_000], 4: pool[20_000:24_200], 5: pool[:5900], 6: pool[30_000:30_500]}
    rows = [(i, len(s), parity_sketch(s).tolist(), x if (x := wide_sketch(s)) is None else x.tolist()) for i, s in sets.items()]
    assert {i: x and len(x) for i, _, _, x in rows} == {1: 128, 2: 128, 3: 64, 4: 128, 5: 128, 6: None}
    digests = spark.createDataFrame(rows, "doc bigint, n bigint, sketch array<bigint>, wide array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 5), (2, 5), (6, 6)], "a bigint, b bigint")
    wide = digests.where("wide is not null").select("doc", "n", "wide")
    found = plausible(pairs, digests.select("doc", "n", "sketch"), (4, 5), wide)
    assert {tuple(r) for r in found.collect()} == {(3, 4), (1, 5), (6, 6)}


def test_groups_of_one_link_are_not_compared_again(spark):
    stars = spark.createDataFrame([(1, 1, 2), (2, 1, 2), (2, 1, 3), (3, 4, 5)], "sig bigint, a bigint, b bigint")
    assert {tuple(r) for r in group_members(stars).collect()} == {(2, 1), (2, 2), (2, 3)}


def test_long_similar_documents(spark):
    base = [prose(i, 4600).split() for i in range(6)]
    texts = [" ".join(w) for w in base]
    texts += [" ".join(base[0][:4100]), " ".join(base[1][:3000]), " ".join([*base[2][:2300], *base[3][2300:]])]
    texts += [" ".join("edit" if i % 61 == 0 else x for i, x in enumerate(base[4])), " ".join("edit" if i % 29 == 0 else x for i, x in enumerate(base[5]))]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    least = least_of_component(sets, close_pairs(sets))
    assert (least[6], least[7], least[8], least[9], least[10]) == (0, 7, 8, 4, 10)
    got = {tuple(r) for r in similar_documents(documents(spark, texts).repartition(3)).collect()}
    assert got == {(i, len(sets[i]), least[i]) for i in sets}


def test_one_of_each_keeps_columns(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + [None])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3]


def test_line_classes(spark):
    texts = [None, "", "x", "same line of the text\n\nx\nsame line of the text "] + [
        prose(i, 40) + "\nA long line that is found in all of them, but for number %d at its end" % (i % 3) for i in range(8)
    ]
    lines = {(i, k): content(x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if content(x)}
    kinds = {c: k for k, c in enumerate(sorted(set(lines.values())))}
    least = least_of_component(kinds.values(), close_pairs({k: shingle_set(c) for c, k in kinds.items()}))
    heads: dict = {}
    for place in sorted(lines):
        heads.setdefault(least[kinds[lines[place]]], place)
    expected = {(*p, *heads[least[kinds[c]]], heads[least[kinds[c]]] == p) for p, c in lines.items()}
    docs = documents(spark, texts)
    assert {tuple(r) for r in line_classes(docs).collect()} == expected
    left = without_repeated_lines(docs)
    assert left.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    for i, t in enumerate(texts):
        stay = [x for k, x in enumerate((t or "").split("\n")) if not content(x) or heads[least[kinds[content(x)]]] == (i, k)]
        if not (t or "").strip() or any(content(x) for x in stay):
            assert got[i] == (t if t is None else "\n".join(stay))
        else:
            assert i not in got


def test_contained_items(spark):
    items = [prose(50 + i, n) for i, n in enumerate((5, 6, 9, 13, 14, 30, 33, 70))]
    texts = [*corpus(), *[prose(200 + i, 400) + " " + t.upper() + " " + prose(300 + i, 90) for i, t in enumerate(items)]]
    texts += [prose(7, 30) + " " + " ".join(t.split()[: int(len(t.split()) * f)]) for t in items[3:] for f in (0.75, 0.85, 0.9)]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, "too few words"), (92, "Words"), (93, "hold in common here"), (94, " "), (None, items[0])], "item_id bigint, text string")
    texts += ["a text of TOO few\twords", "too few", "too few words"]
    sets = {i: shingles((t or "").lower()) for i, t in enumerate(texts)}
    expected = set()
    for j, item in enumerate(items):
        s = shingles(item)
        expected |= {(i, j, len(s), len(s & x)) for i, x in sets.items() if len(s & x) * 5 >= len(s) * 4}
    for j, item in ((91, "too few words"), (92, "words"), (93, "hold in common here")):
        expected |= {(i, j, 1, 1) for i, x in enumerate(texts) if f" {item} " in f" {' '.join(words(x))} "}
    assert {92, 93} < {e[1] for e in expected} and sum(e[1] == 91 for e in expected) == 2
    docs = documents(spark, texts)
    assert {tuple(r)[:4] for r in decontaminate.contained_items(docs, benchmark).collect()} == expected
    clean = decontaminate.clean_documents(docs, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == set(sets) - {e[0] for e in expected}


def test_packing_plan_is_complete_and_reductions_lose_nothing():
    random.seed(5)

    def best(items: list[int], capacity: int) -> int:
        least = [len(items)]

        def place(i: int, rooms: list[int]) -> None:
            if len(rooms) >= least[0]:
                return
            if i == len(items):
                least[0] = len(rooms)
                return
            for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
                rooms[k] -= items[i]
                place(i + 1, rooms)
                rooms[k] += items[i]
            place(i + 1, [*rooms, capacity - items[i]])

        place(0, [])
        return least[0]

    for _ in range(300):
        capacity = random.choice([10, 20, 50])
        items = sorted((random.randint(1, capacity) for _ in range(random.randint(1, 8))), reverse=True)
        fixed, left = packing.dominating_sets(Counter(items), capacity)
        groups = fixed + packing.best_fit(left, capacity)
        assert all(sum(g) <= capacity for g, _ in groups)
        assert sum((Counter({x: n * t for x, n in Counter(g).items()}) for g, t in groups), Counter()) == Counter(items)
        assert sum(t for _, t in fixed) + (best(sorted(left.elements(), reverse=True), capacity) if left else 0) == best(items, capacity)


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [*corpus(), "<|endoftext|> it's 12 ØÆ ﬁ Ⅻ naïve-co_op\x0bÁ"]
    docs = documents(spark, texts)
    rows = packing.pack(docs.unionAll(docs.where("doc_id = 9")), tokenizer_file(), 256).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file())
    expected = Counter()
    for i, t in enumerate([*texts, texts[9]]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], "<u4").tobytes()
            expected[(i if i < len(texts) else 9, piece, at, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 256


def test_rules_counts(spark):
    texts = [*corpus(), "a b c d e a b c d e f", "x\nx\n \n x\nx", "# * $ % & | < > ##", "p q r s t u v p q r s t u v " * 3]

    def counts(t):
        w = words(t, lower=False)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = {x for x, n in Counter(windows).items() if n > 1}
        lines = [x for x in (t or "").split("\n") if words(x)]
        covered = {i + j for i, x in enumerate(windows) if x in twice for j in range(5)}
        n = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)
        return (*n, n[0] < 10 or 100 * n[4] > 20 * n[0])

    got = {r["doc_id"]: tuple(r)[1:] for r in quality_rules.apply_rules(documents(spark, texts)).collect()}
    assert {i: x[:6] for i, x in got.items()} == {i: counts(t) for i, t in enumerate(texts)}
    assert all(not (x[5] and x[6]) for x in got.values())


def test_rules_follow_the_source(spark):
    plain = [prose(i, 80) for i in range(70)]
    signs = [" ".join(w + "%%" for w in prose(100 + i, 80).split()) for i in range(3)]
    rows = [(i, t, "en", "web") for i, t in enumerate(plain + signs)] + [
        (1000 + i, " ".join(w + "%%" for w in prose(500 + i, 80).split()), None, "code") for i in range(60)
    ]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert {i for i, k in got.items() if not k} == {70, 71, 72}


def test_thresholds_come_from_the_sketches(spark):
    """Every measure with spread has its own threshold in each source, however small; repeats can fail below the base rule's share."""

    def text(i, sign=0, same=0, again=0):
        w = prose(i, 120).split()
        w[:sign] = [x + "%" for x in w[:sign]]
        lines = [" ".join(w[k : k + 6]) for k in range(0, 120, 6)]
        return "\n".join(lines + ["another line"] * (same + 1) + [" ".join(w[: 5 + again])] * (again > 0))

    w = prose(201, 480).split()
    many = "\n".join([" ".join(w[k : k + 24]) for k in range(0, 480, 24)] + ["x"] * 60)
    rows = [(i, text(i, i % 3, i % 2, i % 4 * (i % 5 == 0)), "en", "forum") for i in range(80)]
    rows += [(100 + i, text(100 + i), "en", "news") for i in range(80)]
    rows += [(200, text(200, again=12), "en", "forum"), (201, many, "en", "forum"), (202, text(202, sign=60), "en", "forum")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    counts = quality_rules.counted(docs)
    found = {r["t_source"]: r for r in quality_rules.thresholds(quality_rules.sketches(quality_rules.measured(counts))).collect()}
    values = {s: [r for r in quality_rules.measured(counts).collect() if r["source"] == s] for s in found}
    for s, r in found.items():
        for m, (outer, reach, least) in quality_rules.MEASURES.items():
            x = sorted(v[m] for v in values[s])
            at = lambda q, x=x: x[max(-int(-q * len(x) // 1), 1) - 1]
            spread = at(outer) - at(0.5)
            assert r[f"{m}_max"] == pytest.approx(at(0.5) + (reach * spread if spread > 0 else least))
    assert all(found["forum"][f"{m}_max"] != found["news"][f"{m}_max"] for m in quality_rules.MEASURES)
    assert found["news"]["repeat_rate_max"] < 0.2
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(docs).collect()}
    assert (got[202]["kept"], got[201]["kept"], got[201]["base_failed"]) == (False, False, False)
    assert all(got[i]["kept"] for i in range(100, 180))


def test_url_filter(spark):
    entries = spark.createDataFrame(
        [("block", "domain", "a.com", "add", 10), ("block", "domain", "a.com", "add", 12), ("block", "domain", "a.com", "remove", 20),
         ("block", "domain", "a.com", "add", 30), ("allow", "prefix", "x.a.com/ok/", "add", 15), ("block", "url", "x.a.com/ok/bad?q=1", "add", 0),
         ("block", "domain", None, "add", 1), ("block", "domain", "b.org", "add", 5), ("block", "domain", "b.org", "remove", 5)],
        "list string, kind string, address string, action string, at int",
    )
    urls = ["http://u@X.A.com.:80/ok/1", "https://x.a.com/ok/bad?q=1#f", "http://a.com", "http://nota.com/", None, "", "mailto:x", "http://b.org/"]
    captures = spark.createDataFrame(
        [(i, u, t, "extra") for i, u in enumerate(urls) for t in (5, 10, 16, 20, 30, None)], "page_id bigint, url string, fetched_at int, rank string"
    )
    got = {(r["page_id"], r["fetched_at"]): r["verdict"] for r in url_filter.judged(captures, entries).collect()}
    assert len(got) == len(urls) * 6
    assert [got[0, t] for t in (5, 10, 16, 20, 30, None)] == ["none", "block", "allow", "allow", "allow", "none"]
    assert [got[1, t] for t in (5, 10, 16, None)] == ["block", "block", "block", "none"]
    assert [got[2, t] for t in (5, 10, 16, 20, 30)] == ["none", "block", "block", "none", "block"]
    assert {got[i, t] for i in (3, 4, 5, 6, 7) for t in (5, 16, 30)} == {"none"}


def test_open_groups_of_lines_close(spark):
    """Families of lines with up to eight edits share buckets without being one component at first."""
    base = [prose(100 + k, 40).replace("\n", " ") for k in range(6)]
    lines = {}
    for k, line in enumerate(base):
        for e in range(9):
            for v in range(4):
                w = line.split(" ")
                for x in range(e):
                    w[(x * 5 + v * 7) % len(w)] = f"edit{v}{x}"
                lines[(k * 100 + e * 10 + v, 0)] = " ".join(w)
    kinds = {c: i for i, c in enumerate(sorted(set(map(content, lines.values()))))}
    least = least_of_component(kinds.values(), close_pairs({k: shingle_set(c) for c, k in kinds.items()}))
    heads = {}
    for place in sorted(lines):
        heads.setdefault(least[kinds[content(lines[place])]], place)
    expected = {(*p, *heads[least[kinds[content(x)]]]) for p, x in lines.items()}
    docs = spark.createDataFrame([(p[0], x) for p, x in lines.items()], "doc_id bigint, text string").repartition(3)
    assert {tuple(r)[:4] for r in line_classes(docs).collect()} == expected


@pytest.mark.parametrize("n", [1, 700, 1024, 5000])
def test_similar_lines_are_verified_as_sets(n):
    """Any number of pairs and of distinct contents at once, the most included."""
    some = [prose(i, 8).replace("\n", " ") for i in range(2 * n)]
    pairs = [(i, i + n, some[i], some[i] + "x" if i % 3 == 0 else some[i + n]) for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs, strict=True)], ["a", "b", "content_a", "content_b"])
    found = [r for b in _similar(iter([batch])) for r in b.column(0).to_pylist()]
    sets = [(shingle_set(a), shingle_set(b)) for _, _, a, b in pairs]
    assert found == [i for i, (a, b) in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)]


@pytest.mark.parametrize("name", ["join", "lines", "items", "pack", "rules", "urls"])
def test_empty_tables(spark, name):
    docs = spark.createDataFrame([], SCHEMA)
    nothing = {
        "join": lambda: similar_documents(docs),
        "lines": lambda: without_repeated_lines(docs),
        "items": lambda: decontaminate.contained_items(docs, spark.createDataFrame([], "item_id bigint, text string")),
        "pack": lambda: packing.pack(docs, tokenizer_file()),
        "rules": lambda: quality_rules.apply_rules(docs),
        "urls": lambda: url_filter.judged(
            spark.createDataFrame([], "page_id bigint, url string, fetched_at int"),
            spark.createDataFrame([], "list string, kind string, address string, action string, at int"),
        ),
    }[name]
    assert nothing().count() == 0

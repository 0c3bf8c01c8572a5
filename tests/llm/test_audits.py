"""Token files, source divergence and the filter audit, held against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from meterbook.llm import filter_audit, simple8b, source_divergence, token_files
from meterbook.llm.queries import tokenizer_file
from meterbook.llm.tokens import Tokens
from tests.llm.helpers import LOWER, ODD, SCHEMA, WORD, corpus, documents, prose

STRANGE = [
    "<|endoftext|> A<|ENDofTEXT|>b <|startoftext|>", "İSTANBUL ΣΑΣ ΌΣΟΣ. don't I'VE é É ́a 가 ﬁ ß ẞ ×÷", "x̀" * 50, "日本語 テスト 1234 5a6",
    " lead", "a\x00b\x1cc\x7f d", "!!'s ''' 'T", "tab\tand nbsp　wide",
]


@pytest.mark.parametrize("kept, stretch", [(400_000, 4 << 20), (40, 64)])
def test_tokens_are_those_of_the_tokenizer(kept, stretch):
    rows = [*STRANGE, *corpus()]
    tokens = Tokens(tokenizer_file(), kept, stretch)
    assert tokens.by_run
    seen = 0
    for low, ids, places in tokens.closed_rows(pa.array(rows), 2):
        for i in range(len(places) - 1):
            assert ids[places[i] : places[i + 1]].tolist() == [*tokens._ids(rows[low + i] or ""), 2]
            seen += 1
    assert seen == len(rows)


def test_tokens_of_another_tokenizer_are_taken_from_whole_texts():
    tokens = Tokens(tokenizer_file("byte_bpe_50k.json"))
    rows = ["a  b", None, "two\n words"]
    (_, ids, places), = tokens.closed_rows(pa.array(rows), 9)
    assert not tokens.by_run
    assert [ids[i:j].tolist() for i, j in zip(places, places[1:])] == [[*tokens._ids(r or ""), 9] for r in rows]


@pytest.mark.parametrize("top", [1, 2, 9, 300, 50_000, 2**32, 2**60, 2**64])
def test_simple8b_round_trip(top):
    rng = np.random.Generator(np.random.PCG64(top % 97))
    for n in (0, 1, 2, 59, 241, 40_000):
        values = rng.integers(0, top, n, dtype=np.uint64)
        values[rng.random(n) < 0.3] = 0
        packed = simple8b.pack(values)
        assert (simple8b.unpack(packed.words, packed.blocks, packed.escapes) == values).all()
        assert len(packed.words) <= n
        blocks = len(packed.blocks) - 1
        for b in range(0, blocks, 5):
            found = simple8b.unpack(packed.words, packed.blocks, packed.escapes, b, min(b + 2, blocks))
            assert (found == values[packed.blocks[b] : packed.blocks[min(b + 2, blocks)]]).all()
    assert top < 2**62 or len(packed.escapes)


def test_segments_are_checked():
    good = token_files.segment_bytes(3, 70, [5, None], np.array([0, 2, 5]), np.array([1, 2, 3, 2**63, 5], np.uint64)) + token_files.SEPARATOR.encode()
    s = token_files.Segment(memoryview(good))
    assert (s.shard, s.before, s.docs, s.ids().tolist(), s.ids(1, 4).tolist()) == (3, 70, [5, None], [1, 2, 3, 2**63, 5], [2, 3, 2**63])
    for at in (0, 80, len(good) - 3):
        with pytest.raises(ValueError):
            token_files.Segment(memoryview(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :]))


def test_token_files(spark, tmp_path):
    texts = [*STRANGE, *corpus()]
    docs = documents(spark, texts)
    extra = spark.createDataFrame([(None, "null id", "", "", 0, "", "", 0), (4, "again", "", "", 0, "", "", 0), (4, "again", "", "", 0, "", "", 0)], SCHEMA)
    docs = docs.unionAll(extra).repartition(5)
    token_files.write_tokens(docs, tokenizer_file(), str(tmp_path / "t"), segment=500)
    read = token_files.with_starts(token_files.read_tokens(spark, str(tmp_path / "t"), with_ids=True)).orderBy("start").collect()
    encode = Tokens(tokenizer_file())._ids
    want = Counter((i, tuple(encode(t or "")) + (2,)) for i, t in [*enumerate(texts), (None, "null id"), (4, "again"), (4, "again")])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in read) == want
    at = 0
    for before, r in zip([None, *read], read, strict=False):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert before is None or before["doc_id"] is None or before["doc_id"] <= r["doc_id"]
        at += len(r["ids"])
    assert token_files.round_trip(docs.limit(0), tokenizer_file()).collect() == []


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, least, top):
    used, holders, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        used[lang, source].update(terms)
        holders[lang].update(set(terms))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in holders[lang].items() if n >= least]

        def p(counts, kept=kept):
            n = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // n for t in kept}

        of = {s: p(used[lang, s]) for s in sources}
        whole = p(sum((used[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(of[s][t] - whole[t], t) for t in kept if used[lang, s][t] and of[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)}
    return out


def test_divergence(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(source_divergence, "CELLS", 30)
    texts = [*ODD, *(prose(i % 7, 40 + i) for i in range(60)), "Ünï_COde x9y É"] * 2
    rows = [(i, t, (None, "en", "de", "")[i % 4], (None, "a", "b", "c", "é")[i % 5 if i % 4 else 0]) for i, t in enumerate(texts)]
    rows += [(9, "lonely", "xx", "a"), (9, None, "xx", "b"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").selectExpr("*", "1 AS term", "2 AS n", "3 AS value").repartition(3)
    got = [tuple(r) for r in source_divergence.divergence(frame, least=8, top=6).collect()]
    want = brute_divergence([r[1:] for r in rows], 8, 6)
    assert set(got) == want and len(got) == len(want)
    assert {p for _, _, p, *_ in want} == {"pair", "term"} and any(v == 0 for *_, v, _ in want)
    assert source_divergence.divergence(frame.limit(0)).collect() == []


def test_terms_of_a_long_text_in_stretches():
    raw = (prose(3, 4000) + " É1x").encode()
    assert sum((Counter(x) for x in source_divergence.term_lists(raw, 64)), Counter()) == source_divergence.term_counts(raw)


def test_probabilities_are_exact_for_large_counts():
    counts = np.array([[10**14 + 7, 3, 0], [1, 0, 9 * 10**14]], np.int64)
    totals = counts.sum(1)
    got = source_divergence.probabilities(counts, totals, 3)
    want = [[1 + 10**9 * (int(c) + 5) // (int(n) + 15) for c in row] for row, n in zip(counts, totals, strict=True)]
    assert got.tolist() == want


def brute_audit(rows, labels):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    tags = defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        if i is not None:
            tags[i] = [tags[i][0] or quality == 1, tags[i][1] or toxic == 1]
    judged = defaultdict(list)
    for i, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = "".join(
            letter
            for letter, bad in zip(
                "ABCDE",
                (
                    len(words) < 50,
                    100 * len(set(words)) < 65 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                    bool(re.search(r"[#$%&*|]", text)),
                    i is not None and i > least[text],
                ),
                strict=True,
            )
            if bad
        )
        judged[source or ""].append((fails, *(tags[i] if i is not None else (False, False))))
    orders = ["".join(p) for p in permutations("ABCDE")]
    out = set()
    for part, docs in judged.items():
        steps, removed_by = [], Counter()
        for order in orders:
            for k, letter in enumerate(order):
                there = [d for d in docs if not set(order[:k]) & set(d[0])]
                here = [d for d in there if letter in d[0]]
                gone = [d for d in docs if letter in d[0] and set(order[:k]) & set(d[0])]
                removed_by[letter] += len(here)
                only = sum(d[0] == letter for d in docs)
                steps.append((letter, part, order, k + 1, len(there) - len(here), len(here), len(gone), only, sum(d[1] for d in here), sum(d[2] for d in here)))
        out |= {(*s[1:], removed_by[s[0]]) for s in steps}
    return out


def audit_rows():
    long, up = prose(1, 80), prose(2, 70).title()
    texts = [*ODD, long, up, long + " #", up + " a|b", "ab " * 60, prose(5, 60), long, long, up, None, ""]
    rows = [(1000 - i, t, (None, "a", "b")[i % 3]) for i, t in enumerate(texts)]
    rows += [(i, t, "a") for i, t in enumerate(texts[5:])]  # smaller ids that come later
    rows += [(3, texts[8], "b"), (3, texts[8], "b"), (None, long, "a"), (None, long, "b"), (None, None, None)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 1000, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (6, None, None)]
    return rows, labels


def test_filter_audit_retracts(spark, tmp_path):
    rows, labels = audit_rows()
    path = str(tmp_path / "documents.parquet")
    kind = "doc_id bigint, text string, source string"
    for at in range(0, len(rows), 6):  # many files, and so many micro-batches
        spark.createDataFrame(rows[at : at + 6], kind).selectExpr("*", "1 AS part", "2 AS mask", "3 AS bucket").coalesce(1).write.mode("append").parquet(path)
    tags = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    counters = filter_audit.stream_counters(spark, path, tags, str(tmp_path / "run"), buckets=3, files_per_batch=1)
    want = brute_audit(rows, labels)
    assert {tuple(r) for r in filter_audit.report(counters).collect()} == want
    signed = spark.read.parquet(str(tmp_path / "run/deltas"))
    assert signed.filter("n < 0").count() > 0  # smaller ids did come later
    # More files later: only those are read, and the counters are right again.
    more = [(0, rows[10][1], "c"), (2000, prose(5, 60), "a")]
    spark.createDataFrame(more, kind).selectExpr("*", "1 AS part", "2 AS mask", "3 AS bucket").write.mode("append").parquet(path)
    counters = filter_audit.stream_counters(spark, path, tags, str(tmp_path / "run"), buckets=3, files_per_batch=1)
    assert {tuple(r) for r in filter_audit.report(counters).collect()} == brute_audit(rows + more, labels)


def test_filter_audit_without_broadcast_in_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filter_audit, "BROADCAST_IDS", 0)
    monkeypatch.setattr(filter_audit, "HELD_ROWS", 5)
    monkeypatch.setattr(filter_audit, "LONG_TEXT", 100)
    rows, labels = audit_rows()
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(path)
    tags = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = [tuple(r) for r in filter_audit.audit(spark, path, tags).collect()]
    assert set(got) == brute_audit(rows, labels) and len(got) == len(set(got))


def test_filter_audit_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([], "doc_id bigint, text string, source string").write.parquet(path)
    tags = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(spark, path, tags).collect() == []

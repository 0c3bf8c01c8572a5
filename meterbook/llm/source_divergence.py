"""How the words of each source differ from those of its language (operator 12).

A term is a run of letters (ASCII letters and everything beyond ASCII). One ``bytes.translate`` lowers
A-Z and blanks every other ASCII byte, ``bytes.split`` cuts, and a Counter for each document gives its
frequencies; none of the blanked bytes occurs inside a UTF-8 sequence, so no text is decoded. A task adds
the documents up by (lang, source) and sends one row per term and group, so a hot source or a word of
every document sends one row a task. A language keeps the terms that ``KEPT`` of its documents hold.

Each group (lang, source), and each language as a whole, gives each kept term the integer probability
p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), computed by long division in 64-bit integers,
exact for totals below 9 * 10^15. Rows of kept terms are compared in blocks of numpy columns: sums of
|p - q| for every two sources of a language, and each group's terms that it uses more than its language.

Nulls in text, lang or source are ''. Repeated rows count as often as they occur; doc_id is not read. Groups
without a term, and languages that keep none, have their pairs with value 0. Equal values are ranked by the
UTF-8 bytes of the item. A long text is cut in stretches between terms. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbook.llm import text as tx
from meterbook.llm.tables import written

KEPT = 30
SMOOTH = 5
SCALE_DIGITS = 3  # the scale is 1000 ** SCALE_DIGITS
TOP = 50
# Distinct terms that a task holds before it sends them on.
HELD_TERMS = 300_000
# Cells of a block of probabilities.
CELLS = 500_000

LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_lists(raw: bytes, stretch: int = tx.STRETCH) -> Iterator[list[bytes]]:
    """The lower-cased terms of a text in order, a stretch of it at a time."""
    blanked, at = raw.translate(LETTERS), 0
    while at < len(blanked):
        end = blanked.find(b" ", at + stretch)
        end = len(blanked) if end < 0 else end
        yield blanked[at:end].split()
        at = end


def term_counts(raw: bytes) -> Counter:
    found: Counter = Counter()
    for terms in term_lists(raw):
        found.update(terms)
    return found


COUNTED = "lang string, source string, term binary, n bigint, docs bigint"


def _counted(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (uses, docs) in groups.items():
                n = len(uses)
                columns = [pa.repeat(lang, n), pa.repeat(source, n), pa.array(uses.keys(), pa.binary(), size=n)]
                columns.append(pa.array(uses.values(), pa.int64(), size=n))
                columns.append(pa.array((docs[t] for t in uses), pa.int64(), size=n))
                yield pa.record_batch(columns, ["lang", "source", "term", "n", "docs"])
            groups.clear()

        size = 0
        for batch in batches:
            data, places = tx.texts(batch.column(2))
            for row, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                found = term_counts(data[places[row] : places[row + 1]].tobytes())
                uses, docs = groups.setdefault(group, (Counter(), Counter()))
                before = len(uses)
                uses.update(found)
                docs.update(found.keys())
                size += len(uses) - before
                if size >= held:
                    yield from sent()
                    size = 0
        yield from sent()

    return run


def kept_terms(docs: DataFrame, least: int = KEPT) -> DataFrame:
    """``lang, term, uses``: each kept term with its number of uses in every source that has it."""
    base = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    by_term = base.mapInArrow(_counted(HELD_TERMS), COUNTED).repartition("lang", "term")
    # One shuffle: both groupings find the rows of a term in one place.
    by_group = by_term.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = by_group.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("uses")
    )
    return whole.filter(F.col("docs") >= least).select("lang", "term", "uses")


def probabilities(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """p of each row of counts, by long division in base 1000."""
    below = totals[:, None] + SMOOTH * terms
    whole, rest = np.divmod(counts + SMOOTH, below)
    for _ in range(SCALE_DIGITS):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


Groups = dict[str, tuple[list[str], list[int], int]]  # of a language: its sources, their totals, its kept terms

DIFFERENCES = "lang string, source string, part string, item string, value bigint"


def _differences(groups: Groups, cells: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros((len(g[0]), len(g[0])), np.int64) for lang, g in groups.items()}
        best: dict[tuple[str, int], list[tuple[int, bytes]]] = {}

        def block(lang: str, terms: list[bytes], uses: list[list[dict]]) -> None:
            sources, totals, kept = groups[lang]
            place = {s: i for i, s in enumerate(sources)}
            counts = np.zeros((len(sources) + 1, len(terms)), np.int64)
            for j, pairs in enumerate(uses):
                for pair in pairs:
                    counts[place[pair["source"]], j] = pair["n"]
            counts[-1] = counts[:-1].sum(0)
            p = probabilities(counts, np.array([*totals, sum(totals)], np.int64), kept)
            for i in range(len(sources)):
                sums[lang][i] += np.abs(p[:-1] - p[i]).sum(1)
                more = np.where(counts[i] > 0, p[i] - p[-1], 0)
                at = np.flatnonzero(more > 0)
                if len(at) > top:
                    at = at[more[at] >= -np.partition(-more[at], top - 1)[top - 1]]
                found = best.get((lang, i), []) + [(int(more[j]), terms[j]) for j in at]
                best[lang, i] = sorted(found, key=lambda x: (-x[0], x[1]))[:top]

        for batch in batches:
            rows: dict[str, tuple[list, list]] = {}
            for lang, term, uses in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                terms, lists = rows.setdefault(lang, ([], []))
                terms.append(term)
                lists.append(uses)
            for lang, (terms, lists) in rows.items():
                step = max(1, cells // (len(groups[lang][0]) + 1))
                for low in range(0, len(terms), step):
                    block(lang, terms[low : low + step], lists[low : low + step])
        out = []
        for lang, (sources, _, _) in groups.items():
            for i, source in enumerate(sources):
                out += [(lang, source, "pair", o, int(v)) for o, v in zip(sources, sums[lang][i], strict=True) if v and o != source]
                out += [(lang, source, "term", t.decode("utf-8", "replace"), v) for v, t in best.get((lang, i), [])]
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "part", "item", "value"])

    return run


def divergence(docs: DataFrame, least: int = KEPT, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` and part ``term`` of every group."""
    kept = written(kept_terms(docs, least), "terms")
    blank = F.lit("")
    present = docs.select(
        F.coalesce(F.col("lang").cast("string"), blank).alias("lang"),
        F.coalesce(F.col("source").cast("string"), blank).alias("source"),
    ).distinct()
    uses = kept.select("lang", F.explode("uses").alias("u")).groupBy("lang", F.col("u.source").alias("source"))
    totals = present.join(uses.agg(F.sum("u.n").alias("n")), ["lang", "source"], "left").fillna(0, ["n"])
    totals = written(totals, "groups")
    terms = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    # One entry for each group; the result has a row for every two groups of a language.
    groups: Groups = {}
    for r in totals.orderBy("lang", "source").collect():
        sources, numbers, _ = groups.setdefault(r["lang"], ([], [], terms.get(r["lang"], 0)))
        sources.append(r["source"])
        numbers.append(r["n"])

    found = written(kept.mapInArrow(_differences(groups, CELLS, top), DIFFERENCES), "differences")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = totals.select("lang", F.col("source").alias("item"))
    pairs = totals.select("lang", "source").join(others, "lang").filter("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    more = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(more)


ORACLE_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents
),
used AS (
    SELECT n, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM texts, unnest(found) AS u(w)
),
kept AS (SELECT lang, term FROM used GROUP BY ALL HAVING count(DISTINCT n) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM texts),
cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
    FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM used GROUP BY ALL) c USING (lang, source, term)
),
p AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
    FROM cells JOIN size USING (lang)
),
q AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN size USING (lang)
),
distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 50
"""

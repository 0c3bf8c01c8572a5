"""Quality rules with thresholds that follow the corpus (operator 8).

For every document some counts are taken; those that fail a base rule go. The others are measured:
characters a word, signs a word, the shares of repeated lines and repeated words. Each measure is
summed up in KLL quantile sketches by language and source. Sketches merge, so map tasks build their own
and one huge source costs no more than its sketches, and the sketches of a language, or of all
documents, are those of its sources merged: they stand in for groups of fewer than 50 documents. A
group's threshold lies a multiple of the distance from its median to an outer quantile above the median,
and below it too for characters a word. Characters a word spread in every group, and the quartile is safe
from bad documents up to a quarter. The other measures are 0 in most documents, so their quantiles lie
further out: 0.9 for signs, which bad documents have, and 0.98 for repeats, which good documents have too.
Where the outer quantile equals the median there is no spread to go by, and a small distance stands in.
Documents are joined with their group's thresholds and filtered.

All of it is DataFrame functions. Null and empty texts have no words and fail the base rule. Nulls in
lang and source form groups of their own. Repeated rows are rows like others. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.llm.tables import written

SKETCH_K = 1024  # a sketch of fewer values is exact
LEAST_ROWS = 50
BROADCAST_GROUPS = 100_000
# Outer quantile, multiple of its distance from the median, and the threshold's distance without spread.
MEASURES = {"word_length": (0.75, 10, 0.25), "symbol_rate": (0.9, 2, 0.05), "dup_line_rate": (0.98, 4, 0.1), "repeat_rate": (0.98, 4, 0.05)}
TWO_SIDED = ("word_length",)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, whatever the optimizer inlines."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, size: int = 5) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more."""

    def covered(places: Column) -> Column:  # sorted first places of repeated windows
        steps = F.transform(places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def repeats(hashes: Column) -> Column:
        def neighbours(s: Column) -> Column:
            same = F.filter(
                s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            )
            return bind(F.array_sort(F.transform(same, lambda x: x["i"])), covered)

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(bind(F.sort_array(pairs), neighbours))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
        return F.when(F.size(w) >= size, bind(hashes, repeats)).otherwise(0)

    return bind(words, windows)


def counted(docs: DataFrame) -> DataFrame:
    """The counts of each document and ``base_failed``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
        )

    def repeated(x: Column) -> Column:
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))

    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        bind(words, counts).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        bind(lines, repeated).alias("l"),
    ).select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def measured(counts: DataFrame) -> DataFrame:
    some = counts.where("not base_failed")
    return some.select(
        "lang",
        "source",
        (F.col("word_chars") / F.col("n_words")).alias("word_length"),
        (F.col("n_symbols") / F.col("n_words")).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.col("n_lines")).alias("dup_line_rate"),
        (F.col("n_repeat_words") / F.col("n_words")).alias("repeat_rate"),
    )


def sketches(measures: DataFrame) -> DataFrame:
    """One mergeable sketch per measure by language and source, and the number of documents."""
    return measures.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES]
    )


def merged(parts: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES])


def thresholds(parts: DataFrame) -> DataFrame:
    """``lang, source`` with a lower and upper bound of each measure."""

    def packed(df: DataFrame, name: str, *keys: str) -> DataFrame:
        return df.select(*keys, F.struct("n", *MEASURES).alias(name))

    by_lang = packed(merged(parts, "lang"), "of_lang", "lang").withColumnRenamed("lang", "own_lang")
    # The one row of all documents, met by an equal key.
    every = packed(merged(parts).withColumn("key", F.col("n") * 0), "of_all", "key")
    chosen = packed(parts, "own", "lang", "source").join(by_lang, F.col("lang").eqNullSafe(F.col("own_lang")))
    chosen = chosen.join(F.broadcast(every), F.col("own.n") * 0 == F.col("key"))
    enough = lambda c: F.col(f"{c}.n") >= LEAST_ROWS
    sketch = F.when(enough("own"), F.col("own")).when(enough("of_lang"), F.col("of_lang")).otherwise(F.col("of_all"))
    ranks = {m: F.array(F.lit(1 - outer), F.lit(0.5), F.lit(outer)) for m, (outer, _, _) in MEASURES.items()}
    chosen = chosen.select("lang", "source", sketch.alias("s")).select(
        "lang", "source", *[F.kll_sketch_get_quantile_double(F.col(f"s.{m}"), ranks[m]).alias(m) for m in MEASURES]
    )
    bounds = []
    for m, (_, reach, least) in MEASURES.items():
        low, middle, high = (F.col(m)[i] for i in range(3))
        bounds.append((middle + F.when(high > middle, reach * (high - middle)).otherwise(least)).alias(f"{m}_max"))
        if m in TWO_SIDED:
            bounds.append((middle - F.when(middle > low, reach * (middle - low)).otherwise(least)).alias(f"{m}_min"))
    return chosen.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *bounds)


def apply_rules(docs: DataFrame) -> DataFrame:
    """The counts of each document with ``base_failed`` and ``kept``."""
    counts = written(counted(docs), "counts")
    bounds = written(thresholds(written(sketches(measured(counts)), "sketches")), "thresholds")
    few = bounds.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    joined = counts.join(F.broadcast(bounds) if few else bounds, same, "left")
    rates = {
        "word_length": F.col("word_chars") / F.col("n_words"),
        "symbol_rate": F.col("n_symbols") / F.col("n_words"),
        "dup_line_rate": F.col("n_dup_lines") / F.col("n_lines"),
        "repeat_rate": F.col("n_repeat_words") / F.col("n_words"),
    }
    fine = F.lit(True)
    for m, rate in rates.items():
        fine = fine & (rate <= F.col(f"{m}_max"))
        if m in TWO_SIDED:
            fine = fine & (rate >= F.col(f"{m}_min"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(F.coalesce(fine, F.lit(False))).alias("kept"),
    )


# Exact quantiles: those of the sketches while no group has more values than a sketch keeps.
ORACLE_SQL = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)
), repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows), (SELECT unnest(range(5)) AS j)
  WHERE n > 1 GROUP BY doc_id
), counts AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM base LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         word_chars / n_words AS word_length, n_symbols / n_words AS symbol_rate,
         n_dup_lines / n_lines AS dup_line_rate, n_repeat_words / n_words AS repeat_rate
  FROM counts
), quantiles AS (
  SELECT lang, source, GROUPING(lang, source) AS level, count(*) AS n,
         quantile_disc(word_length, [0.25, 0.5, 0.75]) AS wl, quantile_disc(symbol_rate, [0.5, 0.9]) AS sy,
         quantile_disc(dup_line_rate, [0.5, 0.98]) AS dl, quantile_disc(repeat_rate, [0.5, 0.98]) AS rp
  FROM judged WHERE NOT base_failed GROUP BY GROUPING SETS ((lang, source), (lang), ())
), chosen AS (
  SELECT j.*, q.* EXCLUDE (lang, source, n, level)
  FROM judged j JOIN quantiles q ON NOT base_failed AND (
       (q.level = 0 AND q.n >= 50 AND q.lang IS NOT DISTINCT FROM j.lang AND q.source IS NOT DISTINCT FROM j.source)
    OR (q.level = 1 AND q.n >= 50 AND q.lang IS NOT DISTINCT FROM j.lang)
    OR q.level = 3)
  QUALIFY row_number() OVER (PARTITION BY j.doc_id ORDER BY q.level) = 1
), verdicts AS (
  SELECT doc_id, word_length <= wl[2] + CASE WHEN wl[3] > wl[2] THEN 10 * (wl[3] - wl[2]) ELSE 0.25 END
     AND word_length >= wl[2] - CASE WHEN wl[2] > wl[1] THEN 10 * (wl[2] - wl[1]) ELSE 0.25 END
     AND symbol_rate <= sy[1] + CASE WHEN sy[2] > sy[1] THEN 2 * (sy[2] - sy[1]) ELSE 0.05 END
     AND dup_line_rate <= dl[1] + CASE WHEN dl[2] > dl[1] THEN 4 * (dl[2] - dl[1]) ELSE 0.1 END
     AND repeat_rate <= rp[1] + CASE WHEN rp[2] > rp[1] THEN 4 * (rp[2] - rp[1]) ELSE 0.05 END AS fine
  FROM chosen
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(fine, false) AS kept
FROM judged LEFT JOIN verdicts USING (doc_id)
"""

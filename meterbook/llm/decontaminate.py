"""Finding test items inside documents by size-partitioned MinHash containment search (operator 5).

Texts are lower-cased and cut into words at ``[\\x20\\x09-\\x0D]+``; a set holds the hashes of the 5-word
shingles. An item of one to four words has one shingle, all its words, which is looked for among the
document's windows of as many words, taken only for lengths that the items have. A document contains an
item when it holds at least 0.8 of the item's shingles. Items are
partitioned by size (1-2, 3-4, 5-8, ... shingles). In a partition of at most r shingles, a containing
document misses at most ``m = r - ceil(0.8 r)`` of an item's, so it holds one of the item's m + 1 smallest
hashes: this bottom-k MinHash sketch, whose k depends on the partition, is the item's signature, and
the search finds every containing document. On the side of the documents only hashes up to the largest
signature value can match, a MinHash sketch as well, and only those are looked up. Candidates are then
verified on the whole sets of shingles.

All of it is DataFrame functions. A frequent shingle is counted once a document, and signatures are few
beside the documents: they are sent around while there are at most 2 million, and joined by a shuffle
(whose skewed partitions Spark splits) beyond.

Null and empty texts hold no shingle: such items are in no document and such documents hold no item. A
document of fewer than five words can hold short items only. Null ids are left out. Rows that repeat an id are read as each other's
copies: the largest share counts. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.llm.tables import BROADCAST_IDS, join_ids, written

WORDS = 5
THRESHOLD = (4, 5)
_SPACE = " \t\n\x0b\x0c\r"


def word_array(text: str) -> Column:
    """Words of a text in lower case; null if there are none."""
    trimmed = F.btrim(F.lower(F.col(text)), F.lit(_SPACE))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_hashes(words: Column, sizes: Iterable[int] = (WORDS,)) -> Column:
    """Hashes of all windows of as many words as ``sizes`` say, with repeats; null without words.

    The words go through an array of one element, so that they are bound to a variable: if the optimizer
    puts their expression in here, the text is still cut into words once and not once a window.
    """

    def windows(w: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - n)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        return F.when(F.size(w) >= n, hashes).otherwise(F.array().cast("array<bigint>"))

    def every(w: Column) -> Column:
        return F.when(w.isNotNull(), F.concat(*[windows(w, n) for n in sorted(sizes)]))

    return F.transform(F.array(words), every)[0]


def item_hashes(words: Column) -> Column:
    """An item's shingles: windows of five words, or all of its words if they are fewer; null without words."""
    whole = F.when(F.size(words) == 1, F.xxhash64(F.get(words, F.lit(0))))
    for n in range(2, WORDS):
        whole = whole.when(F.size(words) == n, F.xxhash64(*[F.get(words, F.lit(j)) for j in range(n)]))
    return F.when(F.size(words) < WORDS, F.array(whole)).otherwise(F.array_distinct(shingle_hashes(words)))


def _hashed(df: DataFrame, text_column: str, sizes: Iterable[int]) -> DataFrame:
    return df.where(F.col("id").isNotNull()).select("id", shingle_hashes(word_array(text_column), sizes).alias("hashes"))


def signatures(items: DataFrame) -> DataFrame:
    """``item_id, hash``: the bottom-k sketch of each item, k by its size partition."""
    up, down = THRESHOLD
    size = F.size("hashes")
    highest = F.pow(F.lit(2), F.ceil(F.log2(size))).cast("int")  # of the partition: 1, 2, 4, 8, ...
    k = highest - F.ceil(highest * up / down).cast("int") + 1
    return items.select("item_id", F.explode(F.slice(F.sort_array("hashes"), F.lit(1), F.least(k, size))).alias("hash"))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared, containment`` for each item that a document contains."""
    up, down = THRESHOLD
    words = benchmark.where(F.col(item_column).isNotNull()).select(F.col(item_column).cast("bigint").alias("item_id"), word_array("text").alias("w"))
    cut = words.where("w is not null").select("item_id", F.least(F.size("w"), F.lit(WORDS)).alias("size"), item_hashes(F.col("w")).alias("hashes"))
    items = written(cut, "items")
    sizes = [r["size"] for r in items.select("size").distinct().collect()] or [WORDS]  # 1 to 5
    signed = written(signatures(items), "signatures")
    n, limit = signed.agg(F.count("*"), F.max("hash")).first()
    lookup = F.broadcast(signed) if n <= BROADCAST_IDS else signed
    base = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    hashed = _hashed(base, "text", sizes)
    low = hashed.select("id", F.explode_outer("hashes").alias("hash")).where(F.col("hash") <= F.lit(limit if limit is not None else -(2**63)))
    candidates = written(low.join(lookup, "hash").select(F.col("id").alias("doc_id"), "item_id").distinct(), "candidates")
    found = join_ids(base, written(candidates.select(F.col("doc_id").alias("id")).distinct(), "found"), "id", "left_semi")
    sets = _hashed(found, "text", sizes).select(F.col("id").alias("doc_id"), F.col("hashes").alias("own"))
    shared = F.size(F.array_intersect("hashes", "own"))
    return (
        candidates.join(sets, "doc_id")
        .join(items, "item_id")
        .select("doc_id", "item_id", F.size("hashes").cast("bigint").alias("item_shingles"), shared.cast("bigint").alias("shared"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("item_shingles").alias("item_shingles"), F.max("shared").alias("shared"))
        .where(F.col("shared") * down >= F.col("item_shingles") * up)
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that contain an item; all columns stay, and so do rows with a null id."""
    leaks = written(contained_items(docs, benchmark).select("doc_id").distinct(), "leaks")
    return join_ids(docs, leaks, "doc_id", "left_anti")


ORACLE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), lengths AS (
  SELECT DISTINCT least(len(w), 5) AS n FROM item_words WHERE len(w) > 0
), doc_shingles AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
  FROM doc_words JOIN lengths ON len(w) >= n
), item_shingles AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
  FROM (SELECT *, least(len(w), 5) AS n FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, item_shingles, count(*) AS shared, count(*) / item_shingles AS containment
FROM doc_shingles JOIN item_shingles USING (n, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, item_shingles
HAVING count(*) * 5 >= item_shingles * 4
"""

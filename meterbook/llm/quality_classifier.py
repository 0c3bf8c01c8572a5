"""Importance resampling of documents by hashed n-gram models (operator 7).

Tokens are runs of letters and digits, or of signs, in lower case. Two bag models over hashed single
tokens and pairs are estimated: the target from documents labelled good, the raw one from all
documents. A document's log weight is the sum of log(target / raw) over its n-grams. Documents are
drawn without replacement by Gumbel top-k: to each log weight a Gumbel variate is added, made from the
document's id, and the k largest sums are selected.

k is the number of documents whose log weight reaches a cut. A quarter of the labelled documents, by a
hash of their ids, is kept out of the target model, so that they weigh like unlabelled ones; the cut is
the one that tells the good from the bad among them best (the middle of the best range, from histograms
of fixed size). With no good or no bad label there everything is selected. A pair of equal tokens counts as one n-gram, whatever the
token.

A null or empty text has log weight 0. A null id takes part with one fixed variate. Repeated rows get
equal sums, and stay or go together; so do ties at the k-th sum. Labels that are null, or whose document
isn't there, count for nothing; a document with labels of both kinds counts as good. An empty table
gives an empty result. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbook.llm import text as tx
from meterbook.llm.tables import BROADCAST_IDS, free_name, written

BUCKETS = 16384
# Log weights are told apart in steps of 1/4 between -64 and 64 when the cut is chosen.
STEP, REACH = 0.25, 64
REFINED = 4096
SMOOTHING = 50.0  # counts added to either model's
GOOD, BAD = 1, 0
FOLDS = 4  # of labelled documents; fold 0 chooses the cut

_PAIR = np.uint64(0x9FB21C651E98DF25)
_TWICE = np.uint64(0x5851F42D4C957F2D)


def ngrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every n-gram, a group of rows at a time."""
    data, places = tx.texts(column)
    for low, high in tx.row_groups(places):
        h, at = tx.word_hashes(data[places[low] : places[high]], places[low : high + 1] - places[low], kinds=tx.RUNS)
        row = np.repeat(np.arange(low, high), np.diff(at))
        pair = np.where(h[1:] == h[:-1], _TWICE, tx.mix(h[:-1] * _PAIR + h[1:]))[row[1:] == row[:-1]]
        yield (
            np.concatenate([row, row[1:][row[1:] == row[:-1]]]),
            (np.concatenate([h, pair]) % np.uint64(BUCKETS)).astype(np.int64),
        )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task: bucket, in all documents, in the good ones."""
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        marked = batch.column(1).fill_null(BAD).to_numpy(zero_copy_only=False) == GOOD
        for row, bucket in ngrams(batch.column(0)):
            raw += np.bincount(bucket, minlength=BUCKETS)
            good += np.bincount(bucket[marked[row]], minlength=BUCKETS)
    held = np.flatnonzero(raw)
    yield pa.record_batch([pa.array(held), pa.array(raw[held]), pa.array(good[held])], ["bucket", "n_raw", "n_good"])


def _weights(log_ratio: np.ndarray, at: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(len(batch))
            for row, bucket in ngrams(batch.column(at)):
                if len(row):
                    low = row.min()
                    part = np.bincount(row - low, log_ratio[bucket])
                    total[low : low + len(part)] += part
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], [*batch.schema.names, name])

    return run


def log_weights(df: DataFrame, log_ratio: np.ndarray, name: str = "log_weight", text_column: str = "text") -> DataFrame:
    """``df`` with each text's log weight."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    return df.mapInArrow(_weights(log_ratio, df.columns.index(text_column), name), schema)


def gumbel(id_column: str) -> Column:
    """A Gumbel variate made from the id, the same in each run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), F.col(id_column)), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(2**53))
    return -F.log(-F.log(uniform))


def _cut(weighed: DataFrame) -> float:
    place = F.floor(F.greatest(F.least("log_weight", F.lit(REACH)), F.lit(-REACH)) / STEP).alias("place")
    rows = weighed.where("quality is not null and calibrates").groupBy(place, "quality").count().collect()  # a few rows per step
    shape = int(2 * REACH / STEP) + 1
    held = np.zeros((2, shape))
    for r in rows:
        if r["quality"] in (BAD, GOOD):
            held[r["quality"], r["place"] + int(REACH / STEP)] += r["count"]
    if not held[GOOD].sum() or not held[BAD].sum():
        return -np.inf
    # Share of the good at or above each step, less the share of the bad.
    over = held[:, ::-1].cumsum(axis=1)[:, ::-1] / held.sum(axis=1, keepdims=True)
    gain = over[GOOD] - over[BAD]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 * STEP - REACH)


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, found by histograms of bounded size over ever smaller ranges."""
    if k <= 0:
        return float("inf")
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        inside = df.where(F.col(column).between(low, high))
        step = (high - low) / REFINED
        if step == 0 or low + step == low:
            step = high - low
        place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(step)), F.lit(REFINED - 1)).alias("place")
        rows = inside.groupBy(place).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(rows, key=lambda r: -r["place"]):  # at most REFINED rows
            if k <= r["n"]:
                break
            k -= r["n"]
        if (r["low"], r["high"]) == (low, high):
            return low if k > 1 else high
        low, high = r["low"], r["high"]
    return low


class Resampler:
    """The fitted models: log ratio by bucket, and the smallest selected sum."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        marked = written(
            labels.select(F.col("doc_id").cast("bigint").alias("_marked"), F.col("quality").cast("int").alias("quality"))
            .where("_marked is not null and quality is not null")
            .groupBy("_marked")
            .agg(F.max("quality").alias("quality")),
            "marked",
        )
        marked = F.broadcast(marked) if marked.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else marked
        base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        tagged = base.join(marked, F.col("doc_id") == F.col("_marked"), "left")
        tagged = tagged.withColumn("calibrates", F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(FOLDS)) == 0)
        taught = F.when(~F.col("calibrates"), F.col("quality")).alias("quality")
        counts = tagged.select("text", taught).mapInArrow(_counts, "bucket bigint, n_raw bigint, n_good bigint")
        rows = counts.groupBy("bucket").agg(F.sum("n_raw"), F.sum("n_good")).collect()  # BUCKETS rows at most
        held = np.zeros((2, BUCKETS))
        for bucket, raw, good in rows:
            held[:, bucket] = raw, good
        # Counts the target would have if it were like the raw text; few counts say little.
        alike = held[0] * held[1].sum() / max(held[0].sum(), 1)
        self.log_ratio = np.log((held[1] + SMOOTHING) / (alike + SMOOTHING))
        if not any(r[2] for r in rows):
            self.log_ratio[:] = 0
        weighed = log_weights(tagged.select("doc_id", "text", "quality", "calibrates"), self.log_ratio).drop("text")
        self.scores = written(weighed.withColumn("key", F.col("log_weight") + gumbel("doc_id")), "weights")
        self.cut = _cut(self.scores)
        self.k = self.scores.where(F.col("log_weight") >= F.lit(self.cut)).count()
        self.least = kth_largest(self.scores, "key", self.k)

    def result(self) -> DataFrame:
        """``doc_id, log_weight, key, selected`` of every document."""
        return self.scores.select("doc_id", "log_weight", "key", (F.col("key") >= F.lit(self.least)).alias("selected"))

    def selected(self, docs: DataFrame) -> DataFrame:
        """The selected rows of ``docs``, with their columns."""
        number, weight = free_name(docs, "_id"), free_name(docs, "_log_weight")
        key = F.col(weight) + gumbel(number)
        weighed = log_weights(docs.withColumn(number, F.col("doc_id").cast("bigint")), self.log_ratio, weight)
        return weighed.where(key >= F.lit(self.least)).select(*docs.columns)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return Resampler(docs, labels).result()


def keep_selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return Resampler(docs, labels).selected(docs)

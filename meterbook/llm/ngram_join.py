"""Set-similarity self-join on word shingles by PartEnum signatures (operator 9).

Two documents link when the Jaccard similarity of their sets of 5-word shingles is at least 0.8. For
sets of at most r shingles that means at most ``k = (1 - t) / (1 + t) * 2r`` shingles in one set but
not the other. The domain of shingles is cut by a hash into ``parts > k`` partitions; k differing
shingles touch at most k of them, so two similar sets agree on all others, ``parts - k`` at least. A
signature is one partition's number with a hash of the set's shingles there. Sizes are cut into bands; a set makes
signatures for its own band and, when it can be similar to a set of the next band, for that one too,
so that each pair shares the band of its larger set.

The search is exact with k + 1 signatures for a set: order the partitions by their content, the same
way for all sets, and take the first k + 1. Of the partitions that two similar sets agree on, the first
in this order has at least ``parts - k - 1`` behind it in either set, so both sets take it. The order
prefers partitions with a rare shingle, by counts of all shingles in a table of fixed size, then those
with many shingles: signatures are then seldom shared by sets that have but a passage in common.

Large groups. Equal sets are one class, joined through two 64-bit hashes. Sets that share a signature
are not paired with each other: each map batch keeps one row for a signature and sends the rest to it
by star links, and so do the batches' rows after the shuffle. Verified star links make components. Only
where members of one signature are still in different components, the sets outside the signature's
largest component are paired first with few, then (those still outside) with all of its other members, after a parity sketch (a lower bound of the
number of differing shingles, with more bits for large sets) has removed pairs that can't link. Every pair that shares a signature
has then been compared, or lies in one component already.

Nulls, empty texts and texts of spaces have empty sets and link with nothing. Rows with a null id are
left out of the result. A repeated doc_id is one document: its rows' texts count as copies of one id.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.llm import text as tx
from meterbook.llm.components import (
    SKETCH_WORDS,
    components,
    group_members,
    merged,
    mixed_groups,
    open_pairs,
    parity_sketch,
    plausible,
    sketch_array,
    wide_sketch,
)
from meterbook.llm.tables import join_ids, partitions, written

WORDS = 5
THRESHOLD = (4, 5)  # similarity as a fraction
BAND_STEP = 1.6
PROBES = 2  # of a signature's largest component, for each set outside it
FREQUENCIES = 1 << 16  # counters of each of two tables of shingle frequencies


@dataclass(frozen=True)
class Band:
    low: int
    high: int
    k: int
    parts: int


def bands(largest: int, threshold: tuple[int, int] = THRESHOLD, step: float = BAND_STEP) -> list[Band]:
    """Size bands that cover 1 to ``largest`` and the band after it."""
    up, down = threshold
    found, low = [], 1
    while True:
        high = max(low, int(low * step))
        k = 2 * high * (down - up) // (down + up)
        found.append(Band(low, high, k, 3 * (k + 1) // 2 if k else 1))
        if low > largest:
            return found
        low = high + 1


def _batch_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingles of each row."""
    data, places = tx.texts(column)
    for low, high in tx.row_groups(places):
        part = data[places[low] : places[high]]
        hashes, at = tx.word_hashes(part, places[low : high + 1] - places[low])
        hashes, at = tx.shingles(hashes, at, words)
        for i in range(high - low):
            yield low + i, tx.distinct(hashes[at[i] : at[i + 1]])


def _digests(words: int):
    """Size, two hashes and the parity sketch of each set, and the wide one of a large set."""
    salt = np.uint64(0xD6E8FEB86659FD93)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h = np.zeros(len(batch), np.int64), np.zeros((2, len(batch)), np.uint64)
            sketches, wide = np.zeros((len(batch), SKETCH_WORDS), np.int64), [None] * len(batch)
            for i, s in _batch_sets(batch.column(1), words):
                sketches[i], wide[i] = parity_sketch(s), wide_sketch(s)
                n[i], h[0, i], h[1, i] = len(s), s.sum(dtype=np.uint64), tx.mix(s ^ salt).sum(dtype=np.uint64)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n),
                    pa.array(h[0].view(np.int64)),
                    pa.array(h[1].view(np.int64)),
                    sketch_array(sketches),
                    pa.array(wide, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "h1", "h2", "sketch", "wide"],
            )

    return run


def _frequencies(words: int):
    """Sets that hold a shingle, counted by two parts of its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * FREQUENCIES, np.int64)
        for batch in batches:
            waiting, size = [], 0
            for _, s in _batch_sets(batch.column(1), words):
                waiting.append(s)
                size += len(s)
                if size > FREQUENCIES:
                    counts += np.bincount(_counters(np.concatenate(waiting)).ravel(), minlength=2 * FREQUENCIES)
                    waiting, size = [], 0
            if waiting:
                counts += np.bincount(_counters(np.concatenate(waiting)).ravel(), minlength=2 * FREQUENCIES)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held), pa.array(counts[held])], ["counter", "n"])

    return run


def _counters(s: np.ndarray) -> np.ndarray:
    mask = np.uint64(FREQUENCIES - 1)
    return np.stack([s & mask, ((s >> np.uint64(16)) & mask) + np.uint64(FREQUENCIES)]).astype(np.int64)


def commonness(base: DataFrame, words: int) -> np.ndarray:
    """For each counter, how many times (as a power of 2) it exceeds twice the mean."""
    rows = base.mapInArrow(_frequencies(words), "counter bigint, n bigint").groupBy("counter").agg(F.sum("n")).collect()
    counts = np.zeros(2 * FREQUENCIES)  # as many rows at most
    for counter, n in rows:
        counts[counter] = n
    return np.log2(np.maximum(counts / max(counts.mean(), 8.0), 1)).astype(np.uint8)


def signatures(s: np.ndarray, all_bands: list[Band], common: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """The PartEnum signatures of one set of hashed shingles."""
    up, down = threshold
    place = tx.mix(s * np.uint64(0x8CB92BA72F3D8DD7)) >> np.uint64(32)
    value = tx.mix(s + np.uint64(0x2545F4914F6CDD1D))
    level = common[_counters(s)].min(axis=0)
    found = []
    for number, band in enumerate(all_bands):
        # The largest partner has len(s) / threshold shingles.
        if band.high < len(s) or band.low * up > len(s) * down:
            continue
        part = ((place * np.uint64(band.parts)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        held = tx.mix(np.add.reduceat(value[order], starts))
        rank = np.lexsort((held, starts - np.append(starts[1:], len(part)), np.minimum.reduceat(level[order], starts)))
        rank = rank[: band.k + 1]
        sums, parts = held[rank], part[starts][rank]
        if len(rank) <= band.k:  # empty partitions come last, by number
            empty = np.setdiff1d(np.arange(band.parts), part)[: band.k + 1 - len(rank)]
            sums, parts = np.append(sums, np.zeros(len(empty), np.uint64)), np.append(parts, empty)
        found.append(tx.mix(sums + parts.astype(np.uint64) * tx.LENGTH_VALUE + np.uint64(number * 2654435761)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _stars(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sort by signature; the least document of each, whether a row is the first of its signature."""
    order = np.lexsort((doc, sig))
    sig, doc = sig[order], doc[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, bool)
    centre = doc[first][np.cumsum(first) - 1] if len(sig) else doc
    return sig, doc, centre, first


_SIGNED = "bucket int, sig binary, centre binary, doc binary"


def _packed(bucket: np.ndarray, sig: np.ndarray, centre: np.ndarray | None, doc: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket."""
    order = np.argsort(bucket, kind="stable")
    ids, starts = np.unique(bucket[order], return_index=True)
    cut = [*starts.tolist(), len(order)]

    def pack(x: np.ndarray) -> pa.Array:
        x = x[order]
        return pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary())

    centres = pa.nulls(len(ids), pa.binary()) if centre is None else pack(centre)
    return pa.record_batch([pa.array(ids.astype(np.int32)), pack(sig), centres, pack(doc)], ["bucket", "sig", "centre", "doc"])


def _signed(words: int, all_bands: list[Band], common: np.ndarray, threshold: tuple[int, int], buckets: int):
    """Signatures by bucket, one row of a batch for each, and the star links found within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [(ids[i], signatures(s, all_bands, common, threshold)) for i, s in _batch_sets(batch.column(1), words) if len(s)]
            found = [(i, x) for i, x in found if len(x)]
            if not found:
                continue
            sig, doc, centre, first = _stars(
                np.concatenate([x for _, x in found]), np.repeat(np.array([i for i, _ in found], np.int64), [len(x) for _, x in found])
            )
            yield _packed((sig[first] % np.uint64(buckets)).astype(np.int64), sig[first], None, doc[first])
            rest = ~first & (doc != centre)
            if rest.any():  # these need not meet others: spread them
                yield _packed(doc[rest] % buckets, sig[rest], centre[rest], doc[rest])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links ``sig, a, b``; the rows come sorted by bucket."""

    def links(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(sig.view(np.int64)), pa.array(a), pa.array(b)], ["sig", "a", "b"])

    def close(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sig, doc, centre, first = _stars(np.concatenate([s for s, _ in held]), np.concatenate([d for _, d in held]))
        rest = ~first & (doc != centre)
        return links(sig[rest], centre[rest], doc[rest])

    bucket, held = None, []
    for batch in batches:
        for at, sig, centre, doc in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            sig, doc = np.frombuffer(sig, np.uint64), np.frombuffer(doc, np.int64)
            if centre is not None:
                yield links(sig, np.frombuffer(centre, np.int64), doc)
                continue
            if at != bucket and held:
                yield close(held)
                held = []
            bucket = at
            held.append((sig, doc))
    if held:
        yield close(held)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                sets = [s.view(np.int64) for _, s in _batch_sets(part.column(1), words)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc", "set"])

    return run


def _shingles_of(pairs: DataFrame, base: DataFrame, words: int) -> DataFrame:
    """``doc, set`` of the documents in the pairs."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct()
    found = join_ids(base, written(ends, "ends"), "doc_id", "left_semi")
    return written(found.mapInArrow(_sets(words), "doc bigint, set array<bigint>"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs ``a, b`` whose sets are similar enough."""
    up, down = threshold
    of_a = sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a"))
    of_b = sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(of_a, "a")
        .join(of_b, "b")
        .select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b") - both).alias("either"))
        .where(F.col("both") * down >= F.col("either") * up)
        .select("a", "b")
    )


def similar_documents(
    docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; component_id is the least id reachable by links."""
    base = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where(
        F.col("doc_id").isNotNull()
    )
    kind = "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sketch array<bigint>, wide array<bigint>"
    digests = written(base.mapInArrow(_digests(words), kind), "digests")
    some = digests.where("n_shingles > 0")
    heads = some.groupBy("h1", "h2").agg(F.min("doc_id").alias("head"))
    headed = some.join(heads, ["h1", "h2"]).select("doc_id", "head")
    spread = headed.groupBy("doc_id").agg(F.min("head").alias("head"), F.max("head").alias("last"))
    spread = written(spread.where("head <> doc_id"), "copies")
    # An id with several texts is left out only if all of them are copies, and is linked to all of its heads.
    copies, mixed = spread.where("head = last").select("doc_id", "head"), spread.where("head <> last").select("doc_id")
    alike = None
    if not mixed.isEmpty():
        alike = headed.where("doc_id <> head").join(mixed, "doc_id").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
        alike = written(alike.distinct(), "alike")
    all_bands = bands(digests.agg(F.max("n_shingles")).first()[0] or 0, threshold)
    width = partitions(docs)
    stars = written(
        join_ids(base, spread.where("last <> doc_id").select("doc_id"), "doc_id", "left_anti")
        .mapInArrow(_signed(words, all_bands, commonness(base, words), threshold, 8 * width), _SIGNED)
        .repartition(width, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_linked, "sig bigint, a bigint, b bigint"),
        "stars",
    )
    sketches = digests.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch")
    wide = digests.where("wide is not null").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "wide")
    pairs = written(plausible(stars.select("a", "b").distinct(), sketches, threshold, wide), "pairs")
    close = written(_verified(pairs, _shingles_of(pairs, base, words), threshold), "close")
    parts = written(components(close.unionAll(alike) if alike is not None else close), "parts")
    members = group_members(stars)
    for probes in (PROBES, 0):
        mixed = written(mixed_groups(members, parts), "mixed")
        if mixed.isEmpty():
            break
        more = written(open_pairs(mixed, sketches, pairs, probes, threshold, wide), "open")
        parts = merged(parts, written(_verified(more, _shingles_of(more, base, words), threshold), "close"))
        pairs, members = pairs.unionAll(more), mixed.select("sig", "doc")
    parts = parts.withColumnRenamed("node", "head")
    return (
        digests.join(copies, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("head", "doc_id").alias("head"))
        .join(parts, "head", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "head").alias("component_id"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose id is the least of their component; all columns are kept."""
    found = similar_documents(docs)
    gone = written(found.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    return join_ids(docs, gone, "doc_id", "left_anti")

"""Packing tokenized documents into training sequences (operator 6).

Each document becomes its token ids and a closing id. A longer one is cut into pieces of the sequence
length; the rest of it and every shorter document are whole pieces. Packing is bin packing over whole
lengths, so the instance is a histogram with one count per length: at most as many rows as a sequence
has tokens, however large the corpus. The histogram is reduced after Martello and Toth: taking the
largest open length, a small set of pieces that dominates every other set with that piece is fixed for
good, in bulk. What remains is packed best-fit in decreasing length. The plan says for each length which
ranks go to which sequences; pieces are ranked within their length and placed, all in parallel.

A null text is an empty text: one piece with the closing id only. Rows with a null or repeated doc_id
are packed like others. Equal lengths are ranked by (doc_id, piece). Long texts are cut, never dropped.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbook.llm.tables import partitions, written
from meterbook.llm.tokens import tokens_of, worker_memory

LENGTH = 2048
CLOSING_ID = 0
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(memory: Broadcast, path: str, length: int, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(memory, path)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for low, ids, places in tokens.closed_rows(batch.column(1), closing):
                raw = ids.astype("<u4")
                sizes = np.diff(places)
                n = -(-sizes // length)  # pieces of each row
                row = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = places[row] + piece * length
                end = np.minimum(begin + length, places[row + 1])
                sums = [zlib.crc32(raw[i:j]) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]
                columns = [pa.array([names[low + r] for r in row.tolist()], pa.int64()), pa.array(piece, pa.int32())]
                columns += [pa.array(piece * length, pa.int64()), pa.array(end - begin, pa.int64()), pa.array(sums, pa.int64())]
                yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


Group = tuple[tuple[int, ...], int]  # lengths in one sequence, number of such sequences


def dominating_sets(counts: dict[int, int], capacity: int) -> tuple[list[Group], Counter]:
    """Fix dominating sets (Martello and Toth) for as long as one is found; returns them and what is left.

    For the largest open length j with room r beside it: if nothing fits, j goes alone; if a piece of
    exactly r exists, it fills j up; if no two pieces fit beside j, the largest that fits dominates; if
    no three fit, and the largest that fits is at least as long as every pair that fits together, it
    dominates the pairs as well.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    fixed: list[Group] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        fixed.append((lengths, times))
        for x in lengths:
            left[x] -= times
            if not left[x]:
                del left[x]

    skipped: set[int] = set()
    while True:
        sizes = sorted(left)
        open_sizes = [x for x in sizes if x not in skipped]
        if not open_sizes:
            return fixed, left
        j = open_sizes[-1]
        room = capacity - j
        # The shortest other pieces, with repeats.
        short: list[int] = []
        for x in sizes:
            short += [x] * min(3, left[x] - (x == j))
            if len(short) >= 3:
                break
        short = short[:3]
        fits = [x for x in sizes if x <= room and (x != j or left[j] > 1)]
        if not fits:
            take((j,), left[j] if not short or short[0] > room else 1)
            continue
        best = fits[-1]
        times = left[j] // 2 if best == j else min(left[j], left[best])
        if best == room or len(short) < 2 or short[0] + short[1] > room:
            # The largest piece that fits stays so while it lasts.
            take((j, best), times)
        elif (len(short) < 3 or sum(short) > room) and best >= _largest_pair(fits, left, j, room):
            take((j, best), 1 if best == j else times)
        else:
            skipped.add(j)


def _largest_pair(fits: list[int], left: Counter, j: int, room: int) -> int:
    """The largest sum, within ``room``, of two pieces."""
    most, low, high = 0, 0, len(fits) - 1
    while low <= high:
        a, b = fits[low], fits[high]
        if a + b > room:
            high -= 1
        elif low == high and left[a] - (a == j) < 2:
            break
        else:
            most, low = max(most, a + b), low + 1
    return most


def best_fit(counts: Counter, capacity: int) -> list[Group]:
    """Best-fit decreasing over a histogram: equal sequences are filled together."""
    by_room: dict[int, list[list]] = defaultdict(list)  # room: [lengths, times]
    for size in sorted(counts, reverse=True):
        need = counts[size]
        for room in sorted(r for r in by_room if r >= size):
            if not need:
                break
            groups = by_room.pop(room)
            while groups:
                lengths, times = groups.pop()
                if not need:
                    by_room[room].append([lengths, times])
                    continue
                each = room // size
                full = min(times, need // each)
                if full:
                    by_room[room - each * size].append([lengths + (size,) * each, full])
                    need -= full * each
                if full < times:
                    some = need if full * each < need + full * each and need < each else 0
                    if some:
                        by_room[room - some * size].append([lengths + (size,) * some, 1])
                        need = 0
                        full += 1
                    if full < times:
                        by_room[room].append([lengths, times - full])
        each = capacity // size
        if need // each:
            by_room[capacity - each * size].append([(size,) * each, need // each])
        if need % each:
            by_room[capacity - need % each * size].append([(size,) * (need % each), 1])
    return [(lengths, times) for groups in by_room.values() for lengths, times in groups]


@dataclass(frozen=True)
class Slots:
    """Places of the pieces of one length: ranks from ``first`` go ``each`` to a sequence, side by side."""

    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(counts: dict[int, int], capacity: int = LENGTH) -> tuple[dict[int, Slots], int]:
    """Slots by length, and the number of sequences."""
    fixed, left = dominating_sets(counts, capacity)
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: Counter = Counter()
    sequence = 0
    for lengths, times in fixed + best_fit(left, capacity):
        offset = 0
        for size, each in sorted(Counter(lengths).items(), reverse=True):
            rows[size].append((used[size], each, sequence, offset))
            used[size] += each * times
            offset += each * size
        sequence += times
    return {k: Slots(*(np.array(c, np.int64) for c in zip(*v, strict=True))) for k, v in rows.items()}, sequence


def _placed(slots: dict[int, Slots]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            order = np.argsort(size, kind="stable")
            cut = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
            for i, j in zip(cut, cut[1:], strict=False):
                rows = order[i:j]
                s = slots[int(size[rows[0]])]
                at = np.searchsorted(s.first, rank[rows], "right") - 1
                beyond = rank[rows] - s.first[at]
                sequence[rows] = s.sequence[at] + beyond // s.each[at]
                offset[rows] = s.offset[at] + beyond % s.each[at] * size[rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    return run


def ranked(df: DataFrame, by: str, order: list[str], parts: int) -> DataFrame:
    """Adds ``rank``, from 0, within ``by``; a group of any size is ranked in ``parts`` pieces."""
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(by, "_part").agg(F.count("*").alias("_n"))
    before = sizes.select(
        by, "_part", (F.sum("_n").over(Window.partitionBy(by).orderBy("_part")) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(before, [by, "_part"])
        .select(*df.columns, (F.col("_before") + F.col("_inside")).alias("rank"))
    )


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, closing: int = CLOSING_ID) -> DataFrame:
    """One row per piece of at most ``length`` tokens; ``tokenizer`` is a file every executor has."""
    base = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return base.mapInArrow(_cut(worker_memory(docs.sparkSession), tokenizer, length, closing), PIECES)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    cut = written(pieces(docs, tokenizer, length), "pieces")
    # One row per length: at most ``length`` rows.
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots, _ = plan(counts, length)
    order = ["doc_id", "piece", "ids_crc32"]
    placed = ranked(cut, "length", order, 4 * partitions(docs))
    return placed.mapInArrow(_placed(slots), PIECES + ", sequence_id bigint, offset bigint")

"""Token ids of a corpus as binary files, in the order of doc_id (operator 11).

Documents are sorted over the whole corpus by range partitioning. Each partition is a shard and writes
segments of whole documents, about ``SEGMENT`` ids each: ids in Simple-8b words, an escape list, and the
number of ids before each block of words, so that a reader can decode any stretch of a segment with numpy.
Spark's text writer puts the segments into files of at most ``SEGMENTS`` of them, with its committer, so a
lost task leaves nothing behind; the separator it writes after each segment is checked on reading.

A segment is a row of little-endian 64-bit integers:

    MAGIC, shard, ids of the shard before it, ids, documents, blocks, words, escapes, CRC-32 of what follows
    doc_id of each document; 1 where it is null; ids before each document, and their end
    ids before each block of words, and their end; places and values of escapes; words

The place of a document among all ids is the ids of the shards before, those of the shard before its
segment, and those before it there. A null text has the closing id only. Null doc_ids come first; rows
with equal doc_ids are ordered by a hash of the text, then the text; equal rows are dealt over partitions
at random, with a fixed seed. A document of any length is whole in one segment. An empty table gives no files and
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterbook.llm import simple8b
from meterbook.llm.tables import drop_at_exit, written
from meterbook.llm.tokens import tokens_of, worker_memory
from meterbook.session import scratch_folder

CLOSING_ID = 2
SEGMENT = 1 << 18
SEGMENTS = 32
MAGIC = 0x314254_38532D53
SEPARATOR = "\nS8SEG1\n"
HEADER = 9


def segment_bytes(shard: int, before: int, docs: list, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """``docs`` may hold None; ``ends`` are the ids before each document, from 0, and their end."""
    packed = simple8b.pack(ids)
    numbers = [
        np.array([0 if d is None else d for d in docs], "<i8"),
        np.array([d is None for d in docs], "<i8"),
        ends.astype("<i8"),
        packed.blocks.astype("<i8"),
        packed.escapes.astype("<u8").ravel(),
        packed.words.astype("<u8"),
    ]
    body = b"".join(x.tobytes() for x in numbers)
    sizes = [len(ids), len(docs), len(packed.blocks) - 1, len(packed.words), len(packed.escapes)]
    return np.array([MAGIC, shard, before, *sizes, zlib.crc32(body)], "<i8").tobytes() + body


class Segment:
    """One segment read from ``data`` at ``at``; ``end`` is where the next one begins."""

    def __init__(self, data: memoryview, at: int = 0):
        head = np.frombuffer(data, "<i8", HEADER, at)
        if head[0] != MAGIC:
            raise ValueError(f"no segment of token ids at byte {at}")
        self.shard, self.before = int(head[1]), int(head[2])
        n, docs, blocks, words, escapes = (int(x) for x in head[3:8])
        at += 8 * HEADER
        self.end = at + 8 * (docs + docs + docs + 1 + blocks + 1 + 2 * escapes + words)
        if zlib.crc32(data[at : self.end]) != head[8] or bytes(data[self.end : self.end + len(SEPARATOR)]) != SEPARATOR.encode():
            raise ValueError("a segment of token ids is damaged")
        self.n = n

        def take(size: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, size, at)
            at += 8 * size
            return found

        ids, nulls = take(docs, "<i8"), take(docs, "<i8")
        self.docs = [None if null else d for d, null in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.ends = take(docs + 1, "<i8")
        self.blocks = take(blocks + 1, "<i8")
        self.escapes = take(2 * escapes, "<u8").reshape(-1, 2)
        self.words = take(words, "<u8")
        self.end += len(SEPARATOR)

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the segment; only the blocks that hold them are decoded."""
        end = self.n if end is None else end
        if begin >= end:
            return np.zeros(0, np.uint64)
        first = int(np.searchsorted(self.blocks, begin, "right")) - 1
        last = int(np.searchsorted(self.blocks, end, "left"))
        found = simple8b.unpack(self.words, self.blocks, self.escapes, first, last)
        return found[begin - int(self.blocks[first]) : end - int(self.blocks[first])]


def _segments(memory: Broadcast, path: str, closing: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard = tokens_of(memory, path), TaskContext.get().partitionId()
        docs: list = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        held = before = 0

        def sent() -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum(lengths)])
            return pa.record_batch([pa.array([segment_bytes(shard, before, docs, ends, np.concatenate(parts))], pa.binary())], ["segment"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for low, ids, places in tokens.closed_rows(batch.column(1), closing):
                for row, (i, j) in enumerate(zip(places.tolist(), places[1:].tolist(), strict=False)):
                    docs.append(names[low + row])
                    parts.append(ids[i:j])
                    lengths.append(j - i)
                    held += j - i
                    if held >= size:
                        yield sent()
                        docs, parts, lengths, before, held = [], [], [], before + held, 0
        if docs:
            yield sent()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, closing: int = CLOSING_ID, segment: int = SEGMENT) -> None:
    """Writes the ids of all texts to ``folder``; ``tokenizer`` is a file every executor has."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumns({"_h": F.xxhash64("text"), "_r": F.rand(11)})
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h")]
    dealt = base.repartitionByRange(*order, F.col("_r")).sortWithinPartitions(*order, "text")
    memory = worker_memory(docs.sparkSession)
    found = dealt.select("doc_id", "text").mapInArrow(_segments(memory, tokenizer, closing, segment), "segment binary")
    rows = found.select(F.col("segment").cast("string").alias("value"))
    rows.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", SEGMENTS).text(folder)


DOCUMENTS = "shard bigint, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, at = memoryview(content.as_buffer()), 0
                while at < len(data):
                    s = Segment(data, at)
                    at = s.end
                    ids = s.ids().astype("<u4")
                    ends = s.ends.tolist()
                    sums = [zlib.crc32(ids[i:j]) for i, j in zip(ends, ends[1:], strict=False)]
                    n = len(s.docs)
                    columns = [pa.array(np.full(n, s.shard)), pa.array(s.before + s.ends[:-1]), pa.array(s.docs, pa.int64())]
                    columns += [pa.array(np.diff(s.ends)), pa.array(sums, pa.int64())]
                    names = ["shard", "at", "doc_id", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(s.ends, pa.int32()), pa.array(ids.astype(np.int64))))
                        names.append("ids")
                    yield pa.record_batch(columns, names)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: its shard, place there, length, checksum and, if asked for, its ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(_read(with_ids), DOCUMENTS + (", ids array<bigint>" if with_ids else ""))


def with_starts(documents: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before. One row per shard is summed up in order."""
    shards = documents.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    offsets = shards.select("shard", before.alias("before"))
    return documents.join(offsets, "shard").withColumn("start", F.col("before") + F.col("at")).drop("before")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from files written and read again."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "tokens")
    write_tokens(docs, tokenizer, folder)
    drop_at_exit(spark, folder)
    # The index of documents: a few numbers for each.
    index = written(read_tokens(spark, folder), "token-index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")

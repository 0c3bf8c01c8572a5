"""Fuzzy deduplication of lines by MinHash (operator 3).

A line's content is its text, trimmed and in lower case, character by character; lines of spaces only are never compared and
always stay. Lines of equal content are one node. Two contents link when the Jaccard similarity of
their sets of 7-character shingles is at least 0.8 (a shorter content is one shingle). Candidates come
from MinHash signatures cut into 14 bands of 4 values, which find a pair of similarity 0.8 with
probability 0.9994 and more similar ones more surely; each candidate pair is verified on its whole
shingle sets. Linked contents form components by a distributed union-find, and the first line of each
component by (doc_id, line number) stays.

Contents in one band bucket are not paired with each other: they are compared with one of them, and
where components still differ, those outside the largest component first with few, then with all of
the others, unless parity sketches of the shingle sets (a lower bound of their difference) rule it out. A task works
on 4 MB of text at a time and sends a content once, so that a very frequent line costs one row per task.

Nulls and empty texts have no lines. A document with a null id is neither compared nor changed. Rows
that repeat a doc_id are one document: equal line numbers stay or go together. Ties in text are broken
by (doc_id, line number). An empty table gives empty results. Contents are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.llm import text as tx
from meterbook.llm.components import SKETCH_WORDS, components, group_members, merged, mixed_groups, open_pairs, parity_sketch, sketch_array
from meterbook.llm.tables import BROADCAST_IDS, free_name, join_ids, partitions, written

SIZE = 7
BANDS, ROWS = 14, 4
THRESHOLD = (4, 5)
PROBES = 2  # of a bucket's largest component, for each content outside it
STRETCH = 1 << 22  # bytes of text worked on at once; a longer text stands alone
CHARACTERS = 1 << 18  # hashed at once; a longer content stands alone
REMEMBERED = 1 << 20  # contents a task knows it has sent already

_MULTIPLIERS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def contents_of(lines: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.utf8_trim_whitespace(lines))


def content(line: str) -> str:
    return contents_of(pa.array([line]))[0].as_py()


def lines_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """For stretches of whole texts: row and number of each line with a content, its place among the stretch's
    distinct contents, these, and their signed 64-bit hashes."""
    _, places = tx.texts(column)
    for low, high in tx.row_groups(places, STRETCH):
        split = pc.split_pattern(column.slice(low, high - low), "\n")
        row = pc.list_parent_indices(split).to_numpy()
        number = np.arange(len(row)) - np.searchsorted(row, row)
        found = contents_of(split.flatten())
        full = pc.greater(pc.binary_length(found), 0)
        there = full.to_numpy(zero_copy_only=False)
        if not there.any():
            continue
        found = found.filter(full).dictionary_encode()
        raw = found.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)) ^ np.uint64(2**63)
        yield row[there] + low, number[there], found.indices.to_numpy(), found.dictionary, hashes.view(np.int64)


class Sent:
    """Hashes a task has dealt with; forgets them all where they become many."""

    def __init__(self):
        self.hashes = np.zeros(0, np.int64)

    def new(self, hashes: np.ndarray) -> np.ndarray:
        new = ~np.isin(hashes, self.hashes)
        self.hashes = hashes if len(self.hashes) > REMEMBERED else np.concatenate([self.hashes, hashes[new]])
        return new


def shingle_hashes(contents: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all contents, one content after the other, and how many each has."""
    contents = [c.ljust(SIZE, "\0") for c in contents]
    codes = np.frombuffer("".join(contents).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, contents), np.int64, len(contents))
    values = np.zeros(len(codes) - SIZE + 1, np.uint64)
    for j in range(SIZE):
        values += codes[j : len(codes) - SIZE + 1 + j] * tx.SHINGLE_VALUE[j]
    ends = np.cumsum(lengths)
    inside = np.ones(len(codes), bool)
    for j in range(1, SIZE):
        inside[ends - j] = False
    return tx.mix(values[inside[: len(values)]]), lengths - SIZE + 1


def stretches(contents: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of contents with about ``CHARACTERS`` code points."""
    ends = np.cumsum(np.fromiter(map(len, contents), np.int64, len(contents)))
    yield from tx.row_groups(np.concatenate([[0], ends]), CHARACTERS)


def band_keys(contents: list[str]) -> np.ndarray:
    """``BANDS`` 64-bit keys for each content."""
    hashes, windows = shingle_hashes(contents)
    hashes = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(windows) - windows
    keys, turned = np.empty((BANDS, len(contents)), np.uint64), np.empty_like(hashes)
    for band in range(BANDS):
        key = np.full(len(contents), band + 1, np.uint64)
        for row in range(ROWS):
            np.multiply(hashes, _MULTIPLIERS[band * ROWS + row], out=turned)
            key = tx.mix(key + np.minimum.reduceat(turned, starts).astype(np.uint64) * tx.LENGTH_VALUE)
        keys[band] = key
    return keys


PACKED = "kind int, bucket int, x binary, y binary, z binary"
KEYS, STARS, LINES = 0, 1, 2


def _packed(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket, its values side by side."""
    order = np.argsort(bucket, kind="stable")
    ids, starts = np.unique(bucket[order], return_index=True)
    cut = [*starts.tolist(), len(order)]
    cells = []
    for column in columns:
        column = column[order]
        cells.append(pa.array([column[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary()))
    cells += [pa.nulls(len(ids), pa.binary())] * (3 - len(cells))
    return pa.record_batch(
        [pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids.astype(np.int32)), *cells], ["kind", "bucket", "x", "y", "z"]
    )


def _first_of_key(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    return key, node, node[first][np.cumsum(first) - 1] if len(key) else node, first


def _read_lines(buckets: int):
    """All lines, the band keys of distinct contents, and the star links within a stretch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, turn = Sent(), 0
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for row, number, place, contents, hashes in lines_of(batch.column(1)):
                # Lines and links are only listed: one row for each stretch, dealt over the buckets.
                turn += 1
                anywhere = lambda n: np.full(n, (int(docs[row[0]]) + turn) % buckets)  # noqa: E731, B023
                yield _packed(LINES, anywhere(len(row)), hashes[place], docs[row], number)
                new = sent.new(hashes)
                if not new.any():
                    continue
                texts, nodes = contents.filter(pa.array(new)).to_pylist(), hashes[new]
                keys = np.concatenate([band_keys(texts[i:j]) for i, j in stretches(texts)], axis=1)
                key, node, centre, first = _first_of_key(keys.ravel(), np.tile(nodes, BANDS))
                at = (key % np.uint64(buckets)).astype(np.int64)
                key >>= np.uint64(32)
                yield _packed(KEYS, at[first], key[first].astype(np.uint32), node[first])
                rest = ~first
                if rest.any():
                    sig = (at[rest] << 32) | key[rest].astype(np.int64)
                    yield _packed(STARS, anywhere(len(sig)), sig, centre[rest], node[rest])

    return run


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines and star links one by one; the keys of a bucket meet here and make star links. Sorted by bucket."""

    def rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)], ["kind", "x", "y", "z"])

    def close(bucket: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, node, centre, first = _first_of_key(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
        rest = ~first & (node != centre)
        return rows(STARS, (np.int64(bucket) << 32) | key[rest].astype(np.int64), centre[rest], node[rest])

    bucket, held = None, []
    for batch in batches:
        for kind, at, *cells in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if kind != KEYS:
                yield rows(kind, *(np.frombuffer(c, np.int64) for c in cells))
                continue
            if at != bucket and held:
                yield close(bucket, held)
                held = []
            bucket = at
            held.append((np.frombuffer(cells[0], np.uint32), np.frombuffer(cells[1], np.int64)))
    if held:
        yield close(bucket, held)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, content`` of the distinct contents of each task, some of them more than once."""
    sent = Sent()
    for batch in batches:
        for _, _, _, contents, hashes in lines_of(batch.column(0)):
            new = sent.new(hashes)
            yield pa.record_batch([pa.array(hashes[new]), contents.filter(pa.array(new)).cast(pa.string())], ["node", "content"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, n, sketch``: number of shingles and parity sketch of each content."""
    for batch in batches:
        n, sketches = np.zeros(len(batch), np.int64), np.zeros((len(batch), SKETCH_WORDS), np.int64)
        for i, text in enumerate(batch.column(1).to_pylist()):
            values = np.unique(shingle_hashes([text])[0])
            n[i], sketches[i] = len(values), parity_sketch(values)
        yield pa.record_batch([batch.column(0), pa.array(n), sketch_array(sketches)], ["doc", "n", "sketch"])


def shingle_set(text: str) -> set[str]:
    return {text[i : i + SIZE] for i in range(max(1, len(text) - SIZE + 1))}


def _laid_out(sets: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The values of the sets ``which`` side by side, each with its place in ``which`` in front."""
    count = sizes[which]
    at = np.repeat(begins[which] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return sets[at] & _TAIL | np.repeat(np.arange(len(which)).astype(np.uint64) << _PLACE, count)


_PLACE, _TAIL = np.uint64(64 - 11), np.uint64(2 ** (64 - 11) - 1)
ABREAST = 1 << 10  # pairs verified at once, of at most twice as many contents: 11 bits, 53 are left for a shingle


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole shingle sets are similar enough; shingles are told apart by 53 bits."""
    up, down = THRESHOLD
    for batch in batches:
        size = np.add(*(pc.binary_length(batch.column(i)).to_numpy().astype(np.int64) for i in (2, 3)))
        for low, high in tx.row_groups(np.concatenate([[0], np.cumsum(size)]), STRETCH):
            for i in range(low, high, ABREAST):
                some = batch.slice(i, min(ABREAST, high - i))
                texts = pa.concat_arrays([some.column(2), some.column(3)]).dictionary_encode()
                hashes, windows = shingle_hashes(texts.dictionary.to_pylist())
                place = np.repeat(np.arange(len(windows)).astype(np.uint64) << _PLACE, windows)
                sets = tx.distinct(place | hashes >> np.uint64(11))
                begins = np.searchsorted(sets, np.arange(len(windows)).astype(np.uint64) << _PLACE)
                sizes = np.diff(begins, append=len(sets))
                a, b = np.split(texts.indices.to_numpy(), 2)
                both = np.concatenate([_laid_out(sets, begins, sizes, a), _laid_out(sets, begins, sizes, b)])
                both.sort()
                shared = np.bincount((both[1:][both[1:] == both[:-1]] >> _PLACE).astype(np.int64), minlength=len(a))
                keep = shared * down >= (sizes[a] + sizes[b] - shared) * up
                yield some.filter(pa.array(keep)).select([0, 1])


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    of_a = contents.select(F.col("node").alias("a"), F.col("content").alias("content_a"))
    of_b = contents.select(F.col("node").alias("b"), F.col("content").alias("content_b"))
    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "content_a", "content_b")
    return both.mapInArrow(_similar, "a bigint, b bigint")


def line_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, line_no, class_doc_id, class_line_no, kept`` for every line that isn't blank."""
    base = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where(
        "doc_id is not null and text is not null"
    )
    width = partitions(docs)
    found = written(
        base.mapInArrow(_read_lines(8 * width), PACKED)
        .repartition(width, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_open, "kind int, x bigint, y bigint, z bigint"),
        "lines",
    )
    lines = found.where(F.col("kind") == LINES).select(
        F.col("x").alias("node"), F.col("y").alias("doc_id"), F.col("z").cast("int").alias("line_no")
    )
    stars = found.where(F.col("kind") == STARS).select(F.col("x").alias("sig"), F.col("y").alias("a"), F.col("z").alias("b"))
    pairs = written(stars.select("a", "b").distinct(), "pairs")
    ends = written(pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct(), "ends")
    texts = base.select("text").mapInArrow(_contents, "node bigint, content string")
    contents = written(join_ids(texts, ends, "node", "left_semi").groupBy("node").agg(F.first("content").alias("content")), "contents")
    close = written(_verified(pairs, contents), "close")
    parts = written(components(close), "parts")
    members, sketches = group_members(stars), None
    for probes in (PROBES, 0):
        mixed = written(mixed_groups(members, parts), "mixed")
        if mixed.isEmpty():
            break
        if sketches is None:  # groups only close: later rounds need no others
            nodes = written(mixed.select(F.col("doc").alias("node")).distinct(), "members")
            slim = join_ids(contents, nodes, "node", "left_semi")
            sketches = written(slim.mapInArrow(_sketches, "doc bigint, n bigint, sketch array<bigint>"), "sketches")
        more = written(open_pairs(mixed, sketches, pairs, probes, THRESHOLD), "open")
        parts = merged(parts, written(_verified(more, contents), "close"))
        pairs, members = pairs.unionAll(more), mixed.select("sig", "doc")
    firsts = lines.groupBy("node").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"))
    named = firsts.join(parts, "node", "left").select("node", "first", "n", F.coalesce("component", "node").alias("component"))
    heads = named.groupBy("component").agg(F.min("first").alias("head"), F.sum("n").alias("lines"))
    repeated = named.join(heads.where("lines > 1"), "component").select("node", "head")
    return (
        lines.join(repeated, "node", "left")
        .select(
            "doc_id",
            "line_no",
            F.coalesce("head.doc_id", "doc_id").alias("class_doc_id"),
            F.coalesce("head.line_no", "line_no").alias("class_line_no"),
        )
        .withColumn("kept", F.expr("class_doc_id = doc_id and class_line_no = line_no"))
    )


def without_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the lines that aren't kept; a document none of whose lines stays goes.

    All columns stay; ``n_chars``, if there, counts the new text. Documents without lines stay as they are.
    Where an id is null or repeated, rows are told apart by a number of their own instead.
    """
    ids = docs.groupBy(F.col(id_column).alias("id")).agg(F.count("*").alias("n"))
    if not ids.where("id is null or n > 1").isEmpty():
        row = free_name(docs, "_row")
        numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        return _without(numbered, row, text_column).select(*docs.columns)
    return _without(docs, id_column, text_column)


def _without(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    found_id, gone_lines, stay, rest = (free_name(docs, n) for n in ("_gone_id", "_gone", "_stay", "_rest"))
    gone = written(
        line_classes(docs, id_column, text_column)
        .groupBy(F.col("doc_id").alias(found_id))
        .agg(F.collect_set(F.when(~F.col("kept"), F.col("line_no"))).alias(gone_lines), F.count_if("kept").alias(stay))
        .where(F.size(gone_lines) > 0),
        "gone",
    )
    small = (gone.agg(F.sum(F.size(gone_lines))).first()[0] or 0) <= BROADCAST_IDS
    joined = docs.join(F.broadcast(gone) if small else gone, docs[id_column].cast("bigint") == gone[found_id], "left")
    joined = joined.where(F.col(stay).isNull() | (F.col(stay) > 0))
    left = F.filter(F.split(text_column, "\n"), lambda x, i: ~F.array_contains(gone_lines, i))
    joined = joined.withColumn(rest, F.when(F.col(gone_lines).isNotNull(), left))
    text = F.when(F.col(rest).isNull(), F.col(text_column)).otherwise(F.array_join(rest, "\n"))
    out = joined.withColumn(text_column, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(rest).isNull(), F.col("n_chars")).otherwise(F.length(text_column).cast("bigint")))
    return out.select(*docs.columns)

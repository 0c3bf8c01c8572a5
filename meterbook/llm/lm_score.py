"""Language-model scores of documents by a log-bilinear model (operator 4).

Tokens are words in lower case (A-Z), and one end token for each document. Training documents are those
whose crc32(doc_id as text) mod 7 isn't 2. What is gathered from them, over all their tokens:

* the count of every token, which gives the base score: the add-one unigram probability;
* classes: each of the ``SHORTLIST`` most frequent tokens is one of its own, the others fall into classes
  by their last bytes (one for each of the ``ENDINGS`` most frequent endings, one for the rest);
* a log-bilinear model of a token's class given the classes of the two tokens before it: the two
  context vectors, each through a matrix of its place, are summed to a predicted vector, whose product
  with the vectors of all classes, plus biases, are the classes' log weights.

The model is trained in numpy by noise-contrastive estimation with classes drawn by their frequency as
noise. Every map task trains a replica over all its documents; replicas are averaged, weighted by their
tokens, and the second round, over the other half of the documents, goes on from there.

A token's probability is that of its class times its share, (count + 1) over the sum of these, within
the class; a token that training lacks has count 0 and counts as one more token of its class. Over the
known tokens and one unknown token a class these sum to 1. Classes have few contexts, so batched matrix
products give the normaliser of every pair of context classes once, and a token costs one dot product.

Counts of tokens that aren't on the shortlist meet the documents in a shuffle by token hash, in which
each document and token is one entry. Tokens are told apart by 64-bit hashes.

A null or empty text is one end token. A null id belongs to no fold: it is scored and not trained on.
Rows with the same id are added up where counts are joined, so each row gets its own number by its
text's hash. Equal rows get equal scores; they are returned once each. Without training documents every
class has the same probability. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbook.llm import text as tx
from meterbook.llm.tables import partitions, receive, send, written

SHORTLIST = 1024
ENDINGS = 255
FREQUENT = 1 << 16  # tokens whose counts every task has
WIDTH = 32
NOISE = 32
ROUNDS = 2
RATE = 0.1
BATCH = 2048
FOLDS, HELD_OUT = 7, 2
DOCUMENT_BUCKETS = 1024  # in which sums of rare tokens go back to their documents: rows for each task, whatever its documents

CLASSES = SHORTLIST + ENDINGS + 1
BEGIN = CLASSES  # context class before the first token
END_HASH = np.uint64(0x5DEECE66D1CE4E5B)


def fold(id_column: str, folds: int) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % folds


def tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, token hashes, endings and row bounds of each group of rows; every row closes with the end token."""
    data, places = tx.texts(column)
    for low, high in tx.row_groups(places):
        h, at, endings = tx.word_endings(data[places[low] : places[high]], places[low : high + 1] - places[low])
        where = at + np.arange(len(at))
        last = where[1:] - 1
        words = np.ones(where[-1], bool)
        words[last] = False
        hashes, ends = np.full(where[-1], END_HASH), np.zeros(where[-1], np.int64)
        hashes[words], ends[words] = h, endings
        yield low, hashes, ends, where


_PACKED = "kind int, bucket int, hashes binary, a binary, b binary"


def _pack(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    ids, starts = np.unique(bucket[order], return_index=True)
    cut = [*starts.tolist(), len(order)]
    cells = []
    for column in columns:
        column = column[order]
        cells.append(pa.array([column[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary()))
    kinds = pa.array(np.full(len(ids), kind, np.int32))
    return pa.record_batch([kinds, pa.array(ids.astype(np.int32)), *cells], ["kind", "bucket", "hashes", "a", "b"][: 2 + len(cells)])


def _counted(buckets: int):
    """Distinct tokens of each group of rows with their counts and endings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(h, return_index=True, return_counts=True) + (e,) for _, h, e, _ in tokens(batch.column(0))]
            if not found:
                continue
            h = np.concatenate([x[0] for x in found])
            n = np.concatenate([x[2] for x in found]).astype(np.int64)
            e = np.concatenate([x[3][x[1]] for x in found])
            h, first, where = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(where, n, len(h)).astype(np.int64)
            yield _pack(0, (h % np.uint64(buckets)).astype(np.int64), h, n, e[first].astype(np.uint16))

    return run


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket: sorted hashes with counts and endings. The rows come sorted by bucket."""

    def close(bucket: int, held: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        h, n, e = (np.concatenate([np.frombuffer(x[i], k) for x in held]) for i, k in enumerate((np.uint64, np.int64, np.uint16)))
        h, first, where = np.unique(h, return_index=True, return_inverse=True)
        return _pack(0, np.full(len(h), bucket), h, np.bincount(where, n, len(h)).astype(np.int64), e[first])

    bucket, held = None, []
    for batch in batches:
        for _, at, *cells in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if at != bucket and held:
                yield close(bucket, held)
                held = []
            bucket = at
            held.append(cells)
    if held:
        yield close(bucket, held)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for cells in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
        yield tuple(np.frombuffer(c, k) for c, k in zip(cells, (np.uint64, np.int64, np.uint16), strict=True))


def _most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``FREQUENT`` most frequent tokens of a task, of which all but few are never among those of all."""
    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16))]
    for batch in batches:
        held += _opened(batch)
        h, n, e = (np.concatenate([x[i] for x in held]) for i in range(3))
        top = np.lexsort((h, -n))[:FREQUENT]
        held = [(h[top], n[top], e[top])]
    h, n, e = held[0]
    yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n), pa.array(e.astype(np.int32))], ["hash", "n", "ending"])


def _ending_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count of each ending; at ending -1 the number of tokens, at -2 of distinct ones."""
    counts, totals = np.zeros(1 << 16, np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for _, n, e in _opened(batch):
            counts += np.bincount(e, n, 1 << 16).astype(np.int64)
            totals += n.sum(), len(n)
    held = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(np.append(held, [-1, -2])), pa.array(np.append(counts[held], totals))], ["ending", "n"])


@dataclass
class Lists:
    """What every task knows of the vocabulary; its size has fixed bounds."""

    frequent: np.ndarray  # sorted hashes
    counts: np.ndarray
    classes: np.ndarray  # of the frequent tokens
    by_ending: np.ndarray  # class of each ending
    total: int
    distinct: int

    def classes_of(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes, and places in ``frequent`` (-1: not there)."""
        out = self.by_ending[endings]
        at = np.minimum(np.searchsorted(self.frequent, hashes), max(len(self.frequent) - 1, 0))
        known = self.frequent[at] == hashes if len(self.frequent) else np.zeros(len(hashes), bool)
        out = np.where(known, self.classes[at] if len(self.frequent) else out, out)
        return out, np.where(known, at, -1)


def lists_of(vocabulary: DataFrame) -> Lists:
    tops = vocabulary.mapInArrow(_most_frequent, "hash bigint, n bigint, ending int")
    tops = tops.orderBy(F.desc("n"), "hash").limit(FREQUENT).collect()  # FREQUENT rows at most
    endings = vocabulary.mapInArrow(_ending_counts, "ending bigint, n bigint").groupBy("ending").agg(F.sum("n").alias("n")).collect()
    endings = {r["ending"]: r["n"] for r in endings}  # 65,538 rows at most
    total, distinct = endings.pop(-1, 0) or 0, endings.pop(-2, 0) or 0
    by_ending = np.full(1 << 16, CLASSES - 1)
    for i, e in enumerate(sorted(endings, key=lambda e: (-endings[e], e))[:ENDINGS]):
        by_ending[e] = SHORTLIST + i
    h = np.array([r["hash"] for r in tops], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in tops], np.int64)
    classes = by_ending[np.array([r["ending"] for r in tops], np.int64)]
    # The end token is always on the shortlist: class 0.
    short = [0 if x == END_HASH else None for x in h]
    free = iter(range(1, SHORTLIST))
    for i, x in enumerate(short):
        classes[i] = x if x is not None else next(free, classes[i])
    order = np.argsort(h)
    return Lists(h[order], n[order], classes[order], by_ending, int(total), int(distinct))


def _class_sums(lists):
    """By class: tokens, and the sum of (count + 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = receive(lists), np.zeros((2, CLASSES))
        for batch in batches:
            for h, n, e in _opened(batch):
                c, _ = own.classes_of(h, e.astype(np.int64))
                sums += np.bincount(c, n, CLASSES), np.bincount(c, n + 1, CLASSES)
        yield pa.record_batch([pa.array(np.arange(CLASSES)), pa.array(sums[0]), pa.array(sums[1])], ["class", "n", "share"])

    return run


def contexts(classes: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the token before each, and of the one before that."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    first = where[:-1]
    one[first] = two[first] = BEGIN
    second = first[np.diff(where) > 1] + 1
    two[second] = BEGIN
    return one, two


class LogBilinear:
    """Vectors of context classes and predicted classes, a diagonal matrix for each place, biases."""

    NAMES = ("context", "near", "far", "target", "bias")

    def __init__(self, frequencies: np.ndarray):
        rng = np.random.Generator(np.random.PCG64(11))
        self.noise = ((frequencies + 1) / (frequencies + 1).sum()).astype(np.float32)
        self.context = rng.normal(0, 0.1, (CLASSES + 1, WIDTH)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32)
        self.near, self.far = np.ones(WIDTH, np.float32), np.full(WIDTH, 0.5, np.float32)
        self.bias = np.log(self.noise)

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        for n in self.NAMES:
            size = getattr(self, n).size
            setattr(self, n, flat[:size].reshape(getattr(self, n).shape).astype(np.float32).copy())
            flat = flat[size:]

    def train(self, target: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator, state: dict) -> None:
        """Noise-contrastive estimation over the tokens, in batches that share their noise; AdaGrad steps."""
        log_noise = np.log(self.noise * NOISE)
        cumulated = np.cumsum(self.noise)
        for low in range(0, len(target), BATCH):
            w, a, b = target[low : low + BATCH], one[low : low + BATCH], two[low : low + BATCH]
            drawn = np.minimum(np.searchsorted(cumulated, rng.random(NOISE) * cumulated[-1]), CLASSES - 1)
            near, far, true = self.context[a], self.context[b], self.target[w]
            predicted = near * self.near + far * self.far
            score = np.einsum("ij,ij->i", predicted, true) + self.bias[w] - log_noise[w]
            up = 1 / (1 + np.exp(np.clip(score, -30, 30)))
            other = self.target[drawn]
            scores = predicted @ other.T + (self.bias[drawn] - log_noise[drawn])
            down = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            back = up[:, None] * true - down @ other
            self._step("target", np.append(w, drawn), np.concatenate([up[:, None] * predicted, -(down.T @ predicted)]), state)
            self._step("bias", np.append(w, drawn), np.append(up, -down.sum(axis=0))[:, None], state)
            self._step("context", np.append(a, b), np.concatenate([back * self.near, back * self.far]), state)
            for name, rows in (("near", near), ("far", far)):
                g = (back * rows).mean(axis=0)
                state[name] = state.get(name, 1e-6) + g * g
                getattr(self, name).__iadd__(RATE * 0.1 * g / np.sqrt(state[name]))

    def _step(self, name: str, rows: np.ndarray, gradient: np.ndarray, state: dict) -> None:
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        rows, g = rows[starts], np.add.reduceat(gradient[order], starts, axis=0)
        values = getattr(self, name)
        if values.ndim == 1:
            g = g[:, 0]
        if name not in state:
            state[name] = np.full_like(values, 1.0)
        state[name][rows] += g * g
        values[rows] += RATE * g / np.sqrt(state[name][rows])

    def normaliser(self, one: int) -> np.ndarray:
        """Log of the sum over all classes, for the nearer context class ``one`` and every farther one."""
        scores = (self.context[one] * self.near + self.context * self.far) @ self.target.T + self.bias
        most = scores.max(axis=1)
        return most + np.log(np.exp(scores - most[:, None]).sum(axis=1))


def _replica(lists, model):
    """A replica trained over one task's documents, and the number of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, replica, seen, state = receive(lists), LogBilinear(np.zeros(CLASSES)), 0, {}
        replica.load(model.value[0])
        replica.noise = model.value[1]
        rng = np.random.Generator(np.random.PCG64(5))
        for batch in batches:
            for _, h, e, where in tokens(batch.column(0)):
                c, _ = own.classes_of(h, e)
                replica.train(c, *contexts(c, where), rng, state)
                seen += len(c)
        if seen:
            yield pa.record_batch([pa.array([float(seen)]), pa.array([replica.parameters().tobytes()], pa.binary())], ["n", "flat"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0.0
    for batch in batches:
        for seen, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            flat = np.frombuffer(flat, np.float32) * np.float64(seen)
            total, n = flat if total is None else total + flat, n + seen
    if n:
        yield pa.record_batch([pa.array([n]), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], ["n", "flat"])


def fit(train: DataFrame, lists, frequencies: np.ndarray) -> LogBilinear:
    """Average replicas in a tree, so that no task gathers more than a share of them."""
    spark, model = train.sparkSession, LogBilinear(frequencies)
    kind = "n double, flat binary"
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model.parameters(), model.noise))
        part = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn).select("text")
        replicas = written(part.mapInArrow(_replica(lists, sent), kind), "replicas")
        n = replicas.count()
        middle = replicas.repartition(max(1, int(n**0.5))).mapInArrow(_averaged, kind)
        for row in middle.repartition(1).mapInArrow(_averaged, kind).collect():  # one row
            model.load(np.frombuffer(row["flat"], np.float32))
    return model


def _normalisers(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogBilinear(np.zeros(CLASSES))
        own.load(model.value[0])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [own.normaliser(i).astype(np.float32).tobytes() for i in ids]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["id", "row"])

    return run


ROWS = "kind int, bucket int, hashes binary, a binary, row_key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, model double"


def _scored(lists, model, buckets: int):
    """A row for each document with what its frequent tokens give, and packed entries for its other tokens."""
    names = [c.split()[0] for c in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = receive(lists)
        flat, noise, table, shares = model.value
        lm = LogBilinear(np.zeros(CLASSES))
        lm.load(flat)
        log_counts, log_shares = np.log10(np.append(own.counts, 0) + 1.0), np.log10(shares)
        # A shortlist class is its one token.
        single = np.arange(CLASSES) < SHORTLIST
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            total = np.zeros((4, len(batch)))
            for low, h, e, where in tokens(batch.column(3)):
                c, at = own.classes_of(h, e)
                one, two = contexts(c, where)
                score = np.empty(len(c))
                for i in range(0, len(c), 1 << 15):
                    s = slice(i, i + (1 << 15))
                    predicted = lm.context[one[s]] * lm.near + lm.context[two[s]] * lm.far
                    score[s] = np.einsum("ij,ij->i", predicted, lm.target[c[s]]) + lm.bias[c[s]] - table[one[s], two[s]]
                score /= np.log(10)
                counts = log_counts[at]  # 0 where not frequent
                score += np.where(single[c], 0.0, counts - log_shares[c])
                first = where[:-1]
                rows = slice(low, low + len(first))
                total[0, rows] = np.diff(where)
                for i, x in ((1, (at >= 0).astype(float)), (2, counts), (3, score)):
                    total[i, rows] = np.add.reduceat(x, first)
                rare = np.flatnonzero(at < 0)
                if len(rare):
                    row = np.searchsorted(where, rare, "right") - 1 + low
                    packed = _pack(1, (h[rare] % np.uint64(buckets)).astype(np.int64), h[rare], keys[row])
                    yield pa.RecordBatch.from_arrays(
                        [*packed.columns, *[pa.nulls(len(packed), k) for k in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]],
                        names,
                    )
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, 2, np.int32)), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                    *batch.columns[:3], pa.array(total[0].astype(np.int64)), pa.array(total[1].astype(np.int64)), pa.array(total[2]), pa.array(total[3]),
                ],
                names,
            )

    return run


def _rare_sums(buckets: int):
    """For documents: known tokens and the sum of log10(count + 1) of tokens that aren't frequent.

    The rows come sorted by bucket, the vocabulary (kind 0) before the entries (kind 1). What a task has of its
    documents leaves packed by a bucket of the document, a row for each and not one for each document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, bucket = 0, None

        def close() -> pa.RecordBatch:
            keys, known, logs = _added_up(held)
            return _pack(3, keys % buckets, keys, known, logs)

        for batch in batches:
            for kind, at, hashes, a in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != bucket:
                    h, n, bucket = np.zeros(0, np.uint64), np.zeros(0, np.int64), at
                hashes, a = np.frombuffer(hashes, np.uint64), np.frombuffer(a, np.int64)
                if kind == 0:
                    h, n = hashes, a
                    continue
                place = np.searchsorted(h, hashes)
                inside = np.flatnonzero(place < len(h))
                same = inside[h[place[inside]] == hashes[inside]]
                if not len(same):  # unknown tokens would add nothing
                    continue
                found = n[place[same]]
                held.append((a[same], (found > 0).astype(np.int64), np.log10(found + 1.0)))
                size += len(same)
                if size > 1 << 20:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return run


def _added_up(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with the sums of their two values."""
    keys, known, logs = (np.concatenate(x) for x in zip(*held, strict=True))
    keys, where = np.unique(keys, return_inverse=True)
    return keys, np.bincount(where, known, len(keys)).astype(np.int64), np.bincount(where, logs, len(keys))


def _sums_by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document out of the packed sums, which come sorted by bucket."""

    def close(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x) for x in _added_up(held)], ["row_key", "known", "logs"])

    bucket, held, size = None, [], 0
    for batch in batches:
        for _, at, *cells in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if at != bucket and held:
                yield close(held)
                held, size = [], 0
            bucket = at
            held.append(tuple(np.frombuffer(c, k) for c, k in zip(cells, (np.int64, np.int64, np.float64), strict=True)))
            size += len(held[-1][0])
            if size > 1 << 20:
                held = [_added_up(held)]
                size = 0
    if held:
        yield close(held)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    spark, width = docs.sparkSession, partitions(docs)
    buckets = 8 * width
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("held_out", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(True)))
    train = base.where("not held_out")
    counted = train.select("text").mapInArrow(_counted(buckets), _PACKED).repartition(width, "bucket").sortWithinPartitions("bucket")
    vocabulary = written(counted.mapInArrow(_vocabulary, _PACKED), "vocabulary")
    lists = lists_of(vocabulary)
    sent = send(spark, lists)
    sums = vocabulary.mapInArrow(_class_sums(sent), "class bigint, n double, share double").groupBy("class").agg(F.sum("n"), F.sum("share"))
    frequencies, shares = np.zeros(CLASSES), np.zeros(CLASSES)
    for c, n, share in sums.collect():  # CLASSES rows
        frequencies[c], shares[c] = n, share
    shares[SHORTLIST:] += 1  # one unknown token a class
    model = fit(train, sent, frequencies)
    fitted = spark.sparkContext.broadcast((model.parameters(), model.noise))
    table = np.zeros((CLASSES + 1, CLASSES + 1), np.float32)
    for r in spark.range(0, CLASSES + 1, 1, 24).mapInArrow(_normalisers(fitted), "id bigint, row binary").collect():  # CLASSES + 1 rows
        table[r["id"]] = np.frombuffer(r["row"], np.float32)
    full = spark.sparkContext.broadcast((model.parameters(), model.noise, table, np.maximum(shares, 1)))
    rows = base.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "held_out", "text")
    scored = written(rows.mapInArrow(_scored(sent, full, buckets), ROWS), "scored")
    entries = scored.where("kind = 1").select("kind", "bucket", "hashes", "a")
    met = vocabulary.select("kind", "bucket", "hashes", "a").unionAll(entries)
    packed = met.repartition(width, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_rare_sums(DOCUMENT_BUCKETS), _PACKED)
    packed = packed.repartition(width, "bucket").sortWithinPartitions("bucket")
    rare = packed.mapInArrow(_sums_by_document, "row_key bigint, known bigint, logs double")
    direct = scored.where("kind = 2").select("row_key", "doc_id", "held_out", "n_tokens", "n_known", "base", "model")
    # Equal rows share a key, and the sums are those of all of them.
    rare = rare.join(direct.groupBy("row_key").agg(F.count("*").alias("rows")), "row_key")
    logs = F.coalesce(F.col("logs") / F.col("rows"), F.lit(0.0))
    known = F.coalesce((F.col("known") / F.col("rows")).cast("bigint"), F.lit(0))
    return direct.join(rare, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(lists.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.log10(F.lit(float(lists.total + lists.distinct + 1)))).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )

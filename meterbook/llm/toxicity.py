"""Toxicity of documents by a subsequence-kernel support vector machine (operator 10).

Units are words in lower case without signs, and runs of three or more single letters joined. The
subsequence kernel compares two units by their common subsequences of three letters, each weighted by
0.75 to the power of the stretch it covers in both, and is normalised; gaps and inserted characters cost
similarity but don't break a match. A similarity counts from 0.3 on, and only if the unit has half of the
landmark's pairs of characters at most two places apart, which is part of the definition: on sf0.1 a reviewer
counted 104 of 3,492 similarities of 0.3 and more that fall to it, such as "iot" with "idiot". A unit with all characters of a landmark is also compared without the
characters that the landmark lacks; if what is left is similar enough, its kernel over the landmark's own
counts, so that any number of inserted characters costs nothing more. A sentence's similarity to a landmark is that of its most similar
unit. Landmarks are units far more frequent in toxic than in other training documents, no two of them
alike. By Nyström's method a sentence's similarities times the inverse square root of the landmarks'
kernel matrix are its features.

Labels are of documents, so sentences are learnt as in multiple-instance support vector machines: of a
toxic document the sentence that scores highest is a positive example, and so are those with a unit
that is almost a landmark; of others the sentences most
similar to landmarks are negative ones; fit, choose anew, fit again. The loss is the squared hinge. A
document scores by its highest sentence and by how much its sentences add up to, through a logistic
function fitted on training documents.

Only rows whose crc32(doc_id as text) mod 5 isn't 0 are learnt from, of them at most ``SAMPLE`` labelled
ones, those with the least hashes of their ids. All texts are scored whole. lang, source and doc_id are
no inputs.

A null or empty text, and a text without similar units, has the score of a sentence without similarity.
Rows with null ids are scored and not learnt from; repeated rows are scored each. Labels that are null or
have no document count for nothing. Without toxic and other labels every score is 0. Ties between
landmarks go by spelling. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.llm import text as tx
from meterbook.llm.tables import BROADCAST_IDS, receive, send, written

SAMPLE = 8000  # labelled training documents
LANDMARKS = 48
FOLDS = 5
LENGTH, DECAY = 3, 0.75
LEAST = 0.3  # smaller similarities count as none
# Units less foreign characters: similarity that counts, after this factor for each character left out. On sf0.1
# nine in ten insults with a letter put into every gap reach 0.47 to 0.60, 146 of 6,916 clean units with all letters of one reach 0.5.
LEAST_INSERTED, INSERTED = 0.5, 0.95
WIDEST = 24  # longer units are cut into stretches that overlap by half
ROUNDS = 3
SUREST = 20.0  # documents times log odds that a landmark needs
PENALTY = 10.0
SAME = 0.9
ALIKE = 0.7
RARE = 2.5

_SIGNS = re.compile(r"[\W_]+")
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def unit_of(word: bytes) -> str:
    return _SIGNS.sub("", word.decode("utf-8", "replace").lower())


def stretches(unit: str) -> list[str]:
    if len(unit) <= WIDEST:
        return [unit]
    return [unit[i : i + WIDEST] for i in range(0, len(unit) - WIDEST // 2, WIDEST // 2)]


def codes_of(units: list[str]) -> np.ndarray:
    """Code points of each unit, padded with 0."""
    width = max(map(len, units), default=1)
    joined = "".join(u.ljust(width, "\0") for u in units)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(units), width)


KERNEL_ROWS = 1 << 13  # units compared at once


def _decay(n: int) -> np.ndarray:
    """``DECAY`` to the power of the distance from each place to the places before it."""
    apart = np.arange(n)[:, None] - np.arange(n)
    return np.where(apart > 0, np.float32(DECAY) ** np.maximum(apart, 0), 0).astype(np.float32)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of ``s`` with the same row of ``t`` (or its only one).

    What a common subsequence weighs up to a pair of places is the sum over all pairs before it, decayed by the
    distance: a product with a triangular matrix from either side, the same for all rows.
    """
    if len(s) > KERNEL_ROWS:
        cuts = range(0, len(s), KERNEL_ROWS)
        return np.concatenate([kernel(s[i : i + KERNEL_ROWS], t if len(t) == 1 else t[i : i + KERNEL_ROWS]) for i in cuts])
    n, rows, columns = len(s), s.shape[1], t.shape[1]
    by_place = np.ascontiguousarray(s.T)[:, :, None]
    same = ((by_place == t[None]) & (by_place > 0)).astype(np.float32)
    down, across = _decay(rows), _decay(columns).T
    met = same
    for _ in range(1, LENGTH):
        before = (met.reshape(rows * n, columns) @ across).reshape(rows, n * columns)
        met = (down @ before).reshape(rows, n, columns) * same
    return met.sum(axis=(0, 2)) * np.float32(DECAY * DECAY)


PAIRS = 1 << 12


def _pairs(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the pairs of characters at most two places apart, a column at a time, and which are there."""
    wide = codes.astype(np.uint64)
    for gap in (1, 2):
        for j in range(codes.shape[1] - gap):
            a, b = wide[:, j], wide[:, j + gap]
            yield (tx.mix(a * np.uint64(1000003) + b) & np.uint64(PAIRS - 1)).astype(np.int64), (a > 0) & (b > 0)


def _letters(codes: np.ndarray) -> np.ndarray:
    """The characters of each unit as a set of 64 bits; some share a bit."""
    bits = np.where(codes > 0, np.uint64(1) << (codes.astype(np.uint64) & np.uint64(63)), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


class Landmarks:
    def __init__(self, units: list[str]):
        self.units = units
        self.codes = [codes_of([u]) for u in units]
        self.own = np.array([kernel(c, c)[0] for c in self.codes])
        # Landmarks that have a pair of near characters, by the pair's hash.
        self.having = np.zeros((PAIRS, len(units)), np.uint8)
        for m, c in enumerate(self.codes):
            for pair, there in _pairs(c):
                self.having[pair[there], m] = 1
        self.needed = np.ceil(self.having.sum(axis=0) / 2)
        self.letters = np.array([_letters(c)[0] for c in self.codes], np.uint64)

    def _without_others(self, codes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Units less the characters that landmark ``m`` lacks, and how many of these lay between others."""
        kept = np.isin(codes, self.codes[m])
        order = np.argsort(~kept, axis=1, kind="stable")
        n = kept.sum(axis=1)
        width = codes.shape[1]
        span = width - kept[:, ::-1].argmax(axis=1) - kept.argmax(axis=1)
        short = np.take_along_axis(np.where(kept, codes, 0), order, axis=1)[:, : max(int(n.max()), 1)]
        return short, np.where(n > 0, span - n, 0)

    def _inserted(self, codes: np.ndarray, m: int) -> np.ndarray:
        """Similarity to landmark ``m`` of units that have all its characters, with others put between them."""
        out = np.zeros(len(codes), np.float32)
        short, others = self._without_others(codes, m)
        shared = np.zeros(len(codes), np.int64)
        for pair, there in _pairs(short):
            shared += self.having[pair, m] * there
        whole = np.all([(short == x).any(axis=1) for x in np.unique(self.codes[m])], axis=0)
        at = np.flatnonzero(whole & (shared >= self.needed[m]))
        if len(at):
            with_it, own = kernel(short[at], self.codes[m]), kernel(short[at], short[at])
            damp = np.float32(INSERTED) ** others[at]
            sure = with_it / np.sqrt(own * self.own[m]) * damp >= LEAST_INSERTED
            out[at] = np.where(sure, np.minimum(with_it / self.own[m], 1), 0)
        return out

    def similarities(self, units: list[str]) -> np.ndarray:
        """Normalised kernel of each unit with each landmark, 0 where it is small."""
        out = np.zeros((len(units), len(self.units)), np.float32)
        parts = [(i, p) for i, u in enumerate(units) for p in stretches(u) if len(p) >= LENGTH]
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i, p in parts:
            by_length.setdefault(len(p), []).append((i, p))
        for some in by_length.values():
            rows, codes = np.array([i for i, _ in some]), codes_of([p for _, p in some])
            # A similarity counts only with half a landmark's pairs of near characters.
            shared = np.zeros((len(some), len(self.units)), np.uint8)
            for pair, _ in _pairs(codes):
                shared += self.having[pair]
            likely = shared >= self.needed
            whole = (_letters(codes)[:, None] & self.letters) == self.letters
            for m in np.flatnonzero(whole.any(axis=0)):
                at = np.flatnonzero(whole[:, m])
                np.maximum.at(out[:, m], rows[at], self._inserted(codes[at], m))
            own = np.zeros(len(some), np.float32)
            needed = np.flatnonzero(likely.any(axis=1))
            if not len(needed):
                continue
            own[needed] = kernel(codes[needed], codes[needed])
            for m in range(len(self.units)):
                at = np.flatnonzero(likely[:, m])
                if len(at):
                    k = kernel(codes[at], self.codes[m]) / np.sqrt(own[at] * self.own[m])
                    np.maximum.at(out[:, m], rows[at], np.where(k >= LEAST, k, 0))
        return out


class Reader:
    """Sentences with a unit similar to a landmark, for groups of texts; remembers the words it has seen."""

    REMEMBERED = 600_000

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.forget()

    def forget(self) -> None:
        self.seen = np.zeros(0, np.uint64)  # sorted hashes
        self.place = np.zeros(0, np.int64)  # row in similar, -1: none
        self.similar = np.zeros((0, len(self.landmarks.units)), np.float32)

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = self.landmarks.similarities([unit_of(w) for w in words])
        good = np.flatnonzero(found.any(axis=1))
        place = np.full(len(words), -1)
        place[good] = np.arange(len(good)) + len(self.similar)
        self.similar = np.concatenate([self.similar, found[good]])
        order = np.argsort(np.concatenate([self.seen, hashes]), kind="stable")
        self.place = np.concatenate([self.place, place])[order]
        self.seen = np.concatenate([self.seen, hashes])[order]

    def sentences(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows, and similarities to the landmarks, of the sentences that have any."""
        data, places = tx.texts(column)
        for low, high in tx.row_groups(places):
            part = tx.LOWER[data[places[low] : places[high]]]
            at = places[low : high + 1] - places[low]
            begins, ends = tx.word_bounds(part, at, tx.WORDS)
            if not len(begins):
                continue
            hashes = np.concatenate([tx._stretch_hashes(part, begins[i : i + 200_000], ends[i : i + 200_000]) for i in range(0, len(begins), 200_000)])
            if len(self.seen) > self.REMEMBERED:
                self.forget()
            own, first, where = np.unique(hashes, return_index=True, return_inverse=True)
            at_seen = np.minimum(np.searchsorted(self.seen, own), max(len(self.seen) - 1, 0))
            known = self.seen[at_seen] == own if len(self.seen) else np.zeros(len(own), bool)
            if not known.all():
                new = first[~known]
                raw = part.tobytes()
                self.learn(own[~known], [raw[i:j] for i, j in zip(begins[new].tolist(), ends[new].tolist(), strict=True)])
            place = self.place[np.searchsorted(self.seen, own)][where]
            # A sentence ends after a closing sign, at a line break and at the end of a text.
            lines = np.searchsorted(np.flatnonzero(part == 10), begins)
            row = np.searchsorted(at, begins, "right") - 1
            turn = np.zeros(len(begins), bool)
            turn[1:] = _ENDS[part[ends[:-1] - 1]] | (lines[1:] != lines[:-1]) | (row[1:] != row[:-1])
            sentence = np.cumsum(turn)
            hit = np.flatnonzero(place >= 0)
            values, of, rows = self.similar[place[hit]], sentence[hit], row[hit]
            spelled = self.spelled(part, begins, ends, turn)
            if spelled:
                more = self.landmarks.similarities([u for _, u in spelled])
                values = np.concatenate([values, more])
                of = np.concatenate([of, sentence[[i for i, _ in spelled]]])
                rows = np.concatenate([rows, row[[i for i, _ in spelled]]])
            if len(of):
                order = np.argsort(of, kind="stable")
                starts = np.flatnonzero(np.diff(of[order], prepend=-1))
                yield rows[order][starts] + low, np.maximum.reduceat(values[order], starts, axis=0)

    @staticmethod
    def spelled(part: np.ndarray, begins: np.ndarray, ends: np.ndarray, turn: np.ndarray) -> list[tuple[int, str]]:
        """First word and joined letters of each run of at least three words of one letter."""
        single = (ends - begins == 1) & (part[begins] >= 97) & (part[begins] <= 122)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
        out = []
        for i, j in zip(edge[::2], edge[1::2], strict=True):
            if j - i >= 3:
                out.append((int(i), part[begins[i:j]].tobytes().decode()))
        return out


def choose_landmarks(toxic: list[set[str]], other: list[set[str]]) -> tuple[list[str], np.ndarray]:
    """Units whose share of toxic documents exceeds that of others most surely, no two of them alike; their log odds."""
    bad, fine = Counter(u for d in toxic for u in d), Counter(u for d in other for u in d)
    gains = []
    for u, n in bad.items():
        p, q = (n + 0.1) / (len(toxic) + 1), (fine[u] + 0.1) / (len(other) + 1)
        if LENGTH <= len(u) <= WIDEST and n * math.log(p / q) > SUREST:
            gains.append((n * math.log(p / q), u, math.log(p / q)))
    gains = sorted(gains, key=lambda x: (-x[0], x[1]))[: 8 * LANDMARKS]
    units = [u for _, u, _ in gains]
    alike = Landmarks(units).similarities(units) >= ALIKE if units else np.zeros((0, 0), bool)
    chosen: list[int] = []
    for i in range(len(units)):
        if len(chosen) < LANDMARKS and not alike[i, chosen].any():
            chosen.append(i)
    return [units[i] for i in chosen], np.array([gains[i][2] for i in chosen])


def svm(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 30) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xa = x[on] * weight[on, None] * penalty
        new = np.linalg.solve(ridge + xa.T @ x[on], xa.T @ y[on])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset of a logistic regression for labels 0 and 1; the rarer 1 weighs ``RARE`` times."""
    weight = np.where(y > 0, RARE, 1.0)
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(rows: np.ndarray, margin: np.ndarray, n: int, offset: float) -> np.ndarray:
    """Of each of ``n`` texts: the highest margin of a sentence, the same between 0 and 1, and how much the sentences add up to."""
    top, weight = np.full(n, offset), np.zeros(n)
    np.maximum.at(top, rows, margin)
    np.add.at(weight, rows, np.exp(np.clip(2 * margin, -20, 20)))
    return np.stack([top, np.clip(top, 0, 1), np.log1p(weight)], axis=1)


class Machine:
    """The fitted landmarks, weights by landmark, offset and logistic curve; None where nothing can be learnt."""

    def __init__(self, texts: list[str], labels: np.ndarray):
        self.landmarks = None
        if len(set(labels.tolist())) < 2:
            return
        words = [{unit_of(w) for w in t.encode("utf-8", "replace").lower().split()} for t in texts]
        units, odds = choose_landmarks([w for w, y in zip(words, labels, strict=True) if y], [w for w, y in zip(words, labels, strict=True) if not y])
        if not units:
            return
        self.landmarks = Landmarks(units)
        gram = np.array([[kernel(a, b)[0] / np.sqrt(x * y) for b, y in zip(self.landmarks.codes, self.landmarks.own, strict=True)] for a, x in zip(self.landmarks.codes, self.landmarks.own, strict=True)])
        values, vectors = np.linalg.eigh(gram)
        root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        found = list(Reader(self.landmarks).sentences(pa.array(texts, pa.string())))
        rows = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        similar = np.concatenate([s for _, s in found]) if found else np.zeros((0, len(units)), np.float32)
        features, toxic = similar @ root, labels[rows] == 1
        score = (similar * odds).max(axis=1) if len(similar) else np.zeros(0)
        plain = np.zeros((1, len(units)))  # a sentence without similarity is an example of other text
        w = np.zeros(len(units) + 1)
        for _ in range(ROUNDS):
            best = np.lexsort((-score, rows))
            best = best[np.concatenate([[True], rows[best][1:] != rows[best][:-1]])] if len(best) else best
            # The highest sentence of a toxic document, and those that have a landmark almost as it is.
            positive = np.union1d(best[toxic[best]], np.flatnonzero(toxic & (similar.max(axis=1) > SAME)))
            negative = np.flatnonzero(~toxic)
            x = np.concatenate([features[positive], features[negative], plain])
            y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative) + 1)])
            w = svm(x, y)
            score = features @ w[:-1] + w[-1]
        self.weights, self.offset = root @ w[:-1], float(w[-1])
        self.curve = logistic(evidence(rows, score, len(texts), self.offset), labels.astype(float))

    def scores(self, reader: Reader, column: pa.Array) -> np.ndarray:
        found = list(reader.sentences(column))
        rows = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        margin = np.concatenate([x @ self.weights + self.offset for _, x in found]) if found else np.zeros(0)
        z = evidence(rows, margin, len(column), self.offset) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scored(machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = receive(machine)
        reader = Reader(own.landmarks) if own.landmarks else None
        for batch in batches:
            score = own.scores(reader, batch.column(2)) if reader else np.zeros(len(batch))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from a bounded sample of labelled training rows."""
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
    chosen = written(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "labelled")
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    assert SAMPLE <= BROADCAST_IDS
    rows = base.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").limit(SAMPLE).collect()
    return Machine([r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    machine = send(docs.sparkSession, fit(docs, labels))
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(True)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return base.mapInArrow(_scored(machine), "doc_id bigint, held_out boolean, score double, predicted int")

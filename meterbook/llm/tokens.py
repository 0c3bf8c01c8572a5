"""Token ids of whole texts by a tokenizers file, for Arrow batches.

The tokenizer this package uses drops white space, cuts a text into runs of letters, single digits and runs
of signs, and merges only inside a run. Runs are found on bytes, made distinct by Arrow's dictionary
encoding, and only those that a task has not met go to the tokenizer's model; the ids of all texts are
then one gather. A word with an apostrophe, a special token, a control byte or a character beyond Latin-1
is not cut but goes through the whole tokenizer. Any other tokenizer file gets each text whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

from meterbook.llm import text as tx

# Runs whose ids a task keeps; then it begins anew.
KEPT_RUNS = 400_000
# Bytes worked on at once.
STRETCH = 4 << 20

# Fixed value: how a tokenizer must cut texts to be taken run by run.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_BYTES = [chr(b) for b in range(128)]
DIGIT = np.array([c.isdigit() for c in _BYTES] + [False] * 128)
# 0 white space, 1 letters and all beyond ASCII, 2 signs; a whole word that is not cut is 3.
KIND = np.where(tx.SPACE, 0, [1 if c.isalnum() else 2 for c in _BYTES] + [1] * 128).astype(np.uint8)
# Bytes whose word is not cut: control bytes, the apostrophe, and all that begin a character beyond U+00FF or none.
WHOLE = np.array([(b < 32 and not tx.SPACE[b]) or b in (0x27, 0x7F, 0xC2) or b >= 0xC4 for b in range(256)])
SIMPLE = re.compile(r"[a-zà-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


def stretches(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end before white space."""
    low, n = 0, len(data)
    while low < n:
        high = min(low + size, n)
        while high < n:
            gap = np.flatnonzero(tx.SPACE[data[high : high + size]])
            if len(gap):
                high += int(gap[0])
                break
            high = min(high + size, n)
        yield low, high
        low = high


def runs(part: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of some rows."""
    kind = KIND[part]
    whole = WHOLE[part]
    whole[1:] |= ((part[1:] == 0x97) | (part[1:] == 0xB7)) & (part[:-1] == 0xC3)  # signs of Latin-1
    whole[:-1] |= (part[:-1] == ord("<")) & (part[1:] == ord("|"))
    if whole.any():
        begins, ends = tx.word_bounds(part, places, tx.WORDS)
        before = np.concatenate([[0], np.cumsum(whole)])
        odd = before[ends] > before[begins]
        edge = np.zeros(len(part) + 1, np.int8)
        edge[begins[odd]] += 1
        edge[ends[odd]] -= 1  # words are apart or rows meet, so an edge is -1, 0 or 1
        kind[np.cumsum(edge[:-1], dtype=np.int8) > 0] = 3
    digit = DIGIT[part] & (kind == 1)
    turn = np.ones(len(part) + 1, bool)
    turn[1:-1] = (kind[1:] != kind[:-1]) | digit[1:] | digit[:-1]
    turn[places[(places > 0) & (places < len(part))]] = True
    return np.flatnonzero(turn[:-1] & (kind > 0)), np.flatnonzero(turn[1:] & (kind > 0)) + 1


class Tokens:
    def __init__(self, path: str, kept: int = KEPT_RUNS, stretch: int = STRETCH):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # How the model sees letters beyond ASCII.
        self.shown = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xE0, 0x100) if c != 0xF7}
        self.kept, self.stretch = kept, stretch
        self.by_run = CUT in json.dumps(json.loads(self.tokenizer.to_str())["pre_tokenizer"]).replace("\\\\", "\\")
        self._begin_anew()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _begin_anew(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.flat, self.begins, self.lengths = (np.zeros(0, np.int64) for _ in range(3))

    def _run_ids(self, run: bytes) -> list[int]:
        if run.isalpha() and run.islower():
            return [t.id for t in self.model.tokenize(run.decode())]
        text = run.decode("utf-8", "replace")
        low = text.lower()
        if not SIMPLE.fullmatch(low) or len(low) != len(text):
            return self._ids(text)
        return [t.id for t in self.model.tokenize(low.translate(self.shown))]

    def _learn(self, new: list[bytes]) -> None:
        flat: list[int] = []
        ends = [0]
        for run in new:
            self.codes[run] = len(self.codes)
            flat += self._run_ids(run)
            ends.append(len(flat))
        self.begins = np.concatenate([self.begins, np.array(ends[:-1], np.int64) + len(self.flat)])
        self.lengths = np.concatenate([self.lengths, np.diff(ends)])
        self.flat = np.concatenate([self.flat, np.array(flat, np.int64)])

    def _of_runs(self, found: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in order, and where each run's ids begin, with the end."""
        distinct = found.dictionary.to_pylist()
        new = [r for r in distinct if r not in self.codes]
        if len(self.codes) + len(new) > self.kept:
            self._begin_anew()
            new = distinct
        if new:
            self._learn(new)
        codes = np.fromiter(map(self.codes.__getitem__, distinct), np.int64, len(distinct))[found.indices.to_numpy()]
        lengths = self.lengths[codes]
        first = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.begins[codes] - first[:-1], lengths)
        at += np.arange(len(at))
        return self.flat[at], first

    def of_rows(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some rows, given as by ``text.texts``, and where each row's ids begin, with the end."""
        if not self.by_run:
            rows = [np.array(self._ids(data[i:j].tobytes().decode("utf-8", "replace")), np.int64) for i, j in zip(places, places[1:], strict=False)]
            return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
        ids, ends, before = [np.zeros(0, np.int64)], np.zeros(len(places), np.int64), 0
        for low, high in stretches(data, self.stretch):
            part = data[low:high]
            begins, stops = runs(part, places - low)
            offsets = np.concatenate([[0], np.cumsum(stops - begins)]).astype(np.int64)
            letters = part[tx.WORDS[part] > 0]
            # Case is folded here where that can't touch a special token, so that fewer runs are distinct.
            if not ((letters[:-1] == ord("<")) & (letters[1:] == ord("|"))).any():
                letters = tx.LOWER[letters]
            found = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
            found, first = self._of_runs(found.dictionary_encode())
            # Rows that begin beyond the start of this stretch have so many ids before them.
            beyond = places > low
            ends[beyond] = before + first[np.searchsorted(begins, places[beyond] - low)]
            ids.append(found)
            before += len(found)
        return np.concatenate(ids), ends

    def closed_rows(self, column: pa.Array, closing: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of some rows at a time: the first row's number, and ids and places, with a closing id after each row."""
        data, places = tx.texts(column)
        for low, high in tx.row_groups(places, self.stretch):
            ids, ends = self.of_rows(data[places[low] : places[high]], places[low : high + 1] - places[low])
            yield low, np.insert(ids, ends[1:], closing), ends + np.arange(len(ends))


def worker_memory(spark: SparkSession) -> Broadcast:
    """A dictionary of each Python worker, which keeps what one of its tasks puts there for the next."""
    return spark.sparkContext.broadcast({})


def tokens_of(memory: Broadcast, path: str) -> Tokens:
    """The tokenizer of this worker with all runs it has met."""
    kept = memory.value
    if path not in kept:
        kept[path] = Tokens(path)
    return kept[path]

"""How five quality filters interact in every order (operator 13).

All counts follow from one table of counters: how many documents of a part (source) fail exactly which
filters, by label. Four filters look at the text alone. The fifth fails a text that a smaller doc_id has
too, which any later file can change, so the counters are kept by a stream: all files pass as
available-now micro-batches, and state keyed by text holds the smallest id seen and the documents that have
it. A smaller id takes over: the state retracts the earlier documents from their counters and counts them
again as repeated. The sink receives signed counters, and their sum over all batches is right after each.

State lies in key-hash buckets of about ``BUCKET_TEXTS`` texts, one Arrow table each, since Python state for
each single text costs milliseconds. Documents that a task already knows to be repeated leave as counters
before the shuffle, so a text that a third of all rows hold sends one row a task. Labels are joined to
ids and masks, not to texts; null ids are spread over the join. Texts are compared by 128-bit BLAKE2b. The
session chooses the state store: Spark's default holds the state (60 bytes a text or so) in executor memory,
RocksDB on their disks.

A null text is empty; a null source is part ''. A row with a null doc_id has no smaller id and is nobody's
smaller id. Repeated rows count each; rows that repeat id and text are not each other's smaller id. Repeated
labels of an id count as set if any row sets them; ids without labels have none. A text of any length is
measured whole; beyond ``LONG_TEXT`` bytes its distinct words are told apart by 64-bit hashes. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterbook.llm import text as tx
from meterbook.llm.tables import BROADCAST_IDS, drop_at_exit, partitions, written
from meterbook.session import scratch_folder

# Filters in the order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SIGNS = b"#$%&*|"

REPEATED = 1 << FILTERS.index("E")
GOOD, TOXIC = 1, 2
CAPITALS = bytes(range(65, 91))
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of a UTF-8 sequence after its first

LONG_TEXT = 8 << 20
BUCKET_TEXTS = 8192
# Micro-batches of one run over files that were there already. Each batch writes the whole state of its buckets.
BATCHES = 8
# Rows that a task holds while it looks for repeated texts.
HELD_ROWS = 100_000


def mask_of(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    if len(raw) <= LONG_TEXT:
        words = raw.split()
        n, distinct = len(words), len(set(words))
    else:
        data = np.frombuffer(raw, np.uint8)
        hashes, _ = tx.word_hashes(data, np.array([0, len(data)]), lower=False)
        n, distinct = len(hashes), len(tx.distinct(hashes))
    points = len(raw.translate(None, FOLLOWING))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    signs = len(raw) - len(raw.translate(None, SIGNS))
    failed = (n < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * points, signs > 0)
    return sum(bit << i for i, bit in enumerate(failed))


MEASURED = "doc_id bigint, part string, h1 bigint, h2 bigint, mask int"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, places = tx.texts(batch.column(2))
        masks, digests = np.zeros(len(batch), np.int32), []
        for row in range(len(batch)):
            raw = data[places[row] : places[row + 1]].tobytes()
            masks[row] = mask_of(raw)
            digests.append(hashlib.blake2b(raw, digest_size=16).digest())
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        columns = [batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)), pa.array(masks)]
        yield pa.record_batch(columns, ["doc_id", "part", "h1", "h2", "mask"])


ROWS = "bucket bigint, h1 bigint, h2 bigint, doc_id bigint, part string, mask int, label int, n bigint"
KEY, COUNTER = ["h1", "h2"], ["part", "mask", "label"]


def settle(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Splits documents of any texts into those with the least id of their text, and the others."""
    least = rows.groupby(KEY, sort=False)["doc_id"].transform("min")
    first = (rows["doc_id"] == least).to_numpy()
    return rows[first], rows[~first]


def _as_repeated(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.assign(mask=rows["mask"] | REPEATED)


def _summed(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, sort=False, as_index=False)["n"].sum()


def _gathered(buckets: int, held: int):
    """Rows of a task by text; what is repeated already leaves as counters, which have no doc_id."""

    def sent(rows: pd.DataFrame) -> pa.RecordBatch:
        rows = rows.assign(n=np.int64(1))
        known = rows["doc_id"].notna()
        first, others = settle(rows[known].astype({"doc_id": "int64"}))
        texts = _summed(first, [*KEY, "doc_id", *COUNTER])
        texts["bucket"] = texts["h1"] % buckets
        counters = _summed(pd.concat([rows.loc[~known, [*COUNTER, "n"]], _as_repeated(others)[[*COUNTER, "n"]]]), COUNTER)
        # Any bucket passes counters on; they are dealt out by what they count.
        counters["bucket"] = (pd.util.hash_pandas_object(counters[COUNTER], index=False) % np.uint64(buckets)).astype("int64")
        both = pd.concat([texts.astype({"doc_id": "Int64"}), counters])
        schema = pa.schema([(c, pa.int64()) for c in ("bucket", "h1", "h2", "doc_id")] + [("part", pa.string()), ("mask", pa.int32()), ("label", pa.int32()), ("n", pa.int64())])
        both = both.astype({"h1": "Int64", "h2": "Int64"})
        return pa.RecordBatch.from_pandas(both[schema.names], schema, preserve_index=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= held:
                yield sent(_frame(waiting))
                waiting, n = [], 0
        if n:
            yield sent(_frame(waiting))

    return run


def _frame(batches: list[pa.RecordBatch]) -> pd.DataFrame:
    table = pa.Table.from_batches(batches)
    return pd.DataFrame({name: _column(table[name]) for name in table.schema.names})


def _column(values: pa.ChunkedArray):
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        return values.to_pandas()
    return pd.array(values.to_pandas(types_mapper=pd.ArrowDtype), dtype="Int64") if values.null_count else values.to_numpy()


STATE = [*KEY, "doc_id", *COUNTER, "n"]
DELTAS = "part string, mask int, label int, n bigint"


def update_bucket(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One bucket's rows of a micro-batch: signed counters, and the least id of each text as the new state."""
    rows = pd.concat(list(frames), ignore_index=True)
    passed = rows["doc_id"].isna()
    deltas = [rows.loc[passed, [*COUNTER, "n"]]]
    new = rows.loc[~passed, STATE].astype({c: "int64" for c in (*KEY, "doc_id")})
    if len(new):
        if state.exists:
            with pa.ipc.open_stream(state.get[0]) as stored:
                old = stored.read_pandas()
        else:
            old = new.iloc[:0]
        # Counted so far as if they came first: the old rows were, the new ones are about to be.
        first, others = settle(pd.concat([old, new], ignore_index=True))
        deltas += [new[[*COUNTER, "n"]], others[[*COUNTER, "n"]].assign(n=-others["n"]), _as_repeated(others)[[*COUNTER, "n"]]]
        table = pa.Table.from_pandas(_summed(first, [*KEY, "doc_id", *COUNTER])[STATE], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
    found = _summed(pd.concat(deltas), COUNTER)
    yield found[found["n"] != 0].astype({"mask": "int32", "label": "int32", "n": "int64"})


def positive_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, label`` of ids with a label that counts."""

    def bit(column: str, value: int):
        return F.max(F.when(F.col(column) == 1, value).otherwise(0))

    found = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    found = found.agg((bit("quality", GOOD) + bit("toxic", TOXIC)).cast("int").alias("label"))
    return found.filter("label > 0 and doc_id is not null")


def _glob(path: str) -> str:
    """A stream takes a single file only by a pattern."""
    return f"{path[:-1]}[{path[-1]}]"


def stream_counters(
    spark: SparkSession, path: str, labels: DataFrame, folder: str, buckets: int | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Runs all files at ``path`` that ``folder`` has not seen, and returns the counters of all seen so far.

    ``folder`` keeps progress, state and signed counters; a run that broke off goes on from there.
    """
    table = spark.read.parquet(path)
    if buckets is None:
        buckets = max(partitions(table), -(-table.count() // BUCKET_TEXTS))
    if files_per_batch is None:
        files_per_batch = max(1, -(-len(table.inputFiles()) // BATCHES))
    arrivals = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).parquet(_glob(path))
    texts = arrivals.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    found = written(positive_labels(labels), "labels")
    small = found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    # A null id meets no label; spread, such rows do not meet in one task.
    spread = F.when(F.col("doc_id").isNull(), F.col("h1")).otherwise(F.lit(0).cast("bigint"))
    found = found.withColumn("spread", F.lit(0).cast("bigint"))
    measured = texts.mapInArrow(_measured, MEASURED).withColumn("spread", spread)
    labelled = measured.join(F.broadcast(found) if small else found, ["doc_id", "spread"], "left")
    labelled = labelled.select("h1", "h2", "doc_id", "part", "mask", F.coalesce("label", F.lit(0)).cast("int").alias("label"))
    gathered = labelled.mapInArrow(_gathered(buckets, HELD_ROWS), ROWS)
    deltas = gathered.groupBy("bucket").applyInPandasWithState(
        update_bucket, DELTAS, "texts binary", "append", GroupStateTimeout.NoTimeout
    )
    query = (
        deltas.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start(f"{folder}/deltas")
    )
    query.awaitTermination()
    signed = spark.read.schema(DELTAS).parquet(f"{folder}/deltas")
    return signed.groupBy(*COUNTER).agg(F.sum("n").alias("n")).filter("n <> 0")


def order_matrices() -> tuple[list[str], dict[str, np.ndarray]]:
    """For each order and step, which of the failure masks it keeps, removes and finds removed already."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    masks = np.arange(1 << len(FILTERS))
    out: dict[str, list] = {name: [] for name in ("kept", "removed", "redundant", "unique_fails")}
    for order in orders:
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            out["kept"].append(masks & (before | bit) == 0)
            out["removed"].append((masks & bit > 0) & (masks & before == 0))
            out["redundant"].append((masks & bit > 0) & (masks & before > 0))
            out["unique_fails"].append(masks == bit)
            before |= bit
    found = {name: np.array(rows).astype(np.int64) for name, rows in out.items()}
    letters = np.array([FILTERS.index(x) for order in orders for x in order])
    by_filter = np.array([found["removed"][letters == i].sum(0) for i in range(len(FILTERS))])
    return orders, found | {"shapley": by_filter[letters]}


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, of = order_matrices()
    steps = len(FILTERS)
    names = [order for order in orders for _ in range(steps)]
    for batch in batches:
        for part, every, good, toxic in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
            every, good, toxic = (np.array(x, np.int64) for x in (every, good, toxic))
            counts = [of[c] @ every for c in COUNTS[:4]] + [of["removed"] @ good, of["removed"] @ toxic, of["shapley"] @ every]
            columns = [pa.repeat(part, len(names)), pa.array(names), pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders)))]
            yield pa.record_batch([*columns, *map(pa.array, counts)], ["part", "filter_order", "step", *COUNTS])


def report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step. Each part has at most 128 counters."""

    def per_mask(label: int):
        n = F.col("n") if not label else F.when(F.col("label").bitwiseAND(label) > 0, F.col("n")).otherwise(0)
        return F.array(*[F.sum(F.when(F.col("mask") == m, n).otherwise(0)) for m in range(1 << len(FILTERS))])

    wide = counters.groupBy("part").agg(per_mask(0).alias("every"), per_mask(GOOD).alias("good"), per_mask(TOXIC).alias("toxic"))
    return wide.mapInArrow(_reported, REPORT)


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None) -> DataFrame:
    """The report of a run over all files; without a ``folder`` its state goes when the application ends."""
    own = folder or scratch_folder(spark, "filter-audit")
    counters = stream_counters(spark, path, labels, own)
    if not folder:
        drop_at_exit(spark, own)
    return report(counters)


ORACLE_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
judged AS (
    SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
           [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
    FROM texts LEFT JOIN (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
    ) l USING (doc_id)
),
counters AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
f(i) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
steps AS (
    SELECT array_to_string([substr('ABCDE', x, 1) for x in o], '') AS filter_order,
           s.i AS step, o[s.i] AS filter, o[1:s.i - 1] AS before
    FROM orders, f s
),
seen AS (
    SELECT *, fails[filter] AS fails_here, len([x for x in before if fails[x]]) > 0 AS gone
    FROM steps, counters
),
counted AS (
    SELECT part, filter_order, step, filter,
           coalesce(sum(n) FILTER (NOT gone AND NOT fails_here), 0) AS kept,
           coalesce(sum(n) FILTER (NOT gone AND fails_here), 0) AS removed,
           coalesce(sum(n) FILTER (gone AND fails_here), 0) AS redundant,
           coalesce(sum(n) FILTER (fails_here AND len([x for x in fails if x]) = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND fails_here), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND fails_here), 0) AS toxic_lost
    FROM seen GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counted
"""

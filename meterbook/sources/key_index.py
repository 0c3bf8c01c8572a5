"""Where the rows of a key lie in a table that is partitioned by something else.

The index is a stored table (key, partition value) in key-hash buckets: a refresh reads the buckets of its
keys, two narrow columns, instead of the key column of every partition. It follows the table it indexes:
while the table changes, a mark stands beside it, and an index with a mark, left by a run that died, is made
again from the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbook.session import durable_parts
from meterbook.sources.merge import BUCKET, BUCKETS, Parts, bucket_of, merge_partitions, within
from meterbook.sources.store import Store, is_large


class KeyIndex:
    def __init__(self, store: Store, layer: str, table: str, key: str, place: str):
        self.store, self.layer, self.table = store, layer, table
        self.key, self.place = key, place
        self.name = f"{table}_by_{key}"

    @property
    def _mark(self) -> str:
        return f"{self.store.folder(self.layer, self.name)}.changing"

    def rebuild(self) -> None:
        rows = self._entries(self.store.read(self.layer, self.table))
        large = is_large(rows)
        # Entries are small: few tasks make few files.
        self.store.replace(rows.coalesce(8 * BUCKETS) if large else rows, self.layer, self.name, [BUCKET], in_place=large)
        self.store.remove_note(self._mark)

    def _entries(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.key, self.place).withColumn(BUCKET, bucket_of(self.key))

    def _buckets(self, rows: DataFrame) -> list:
        return [r[0] for r in rows.select(bucket_of(self.key)).distinct().collect()]

    def find(self, rows: DataFrame) -> DataFrame:
        """``key, place`` of those keys of ``rows`` that the table holds."""
        if not self.store.exists(self.layer, self.name) or self.store.path_exists(self._mark):
            self.rebuild()
        index = self.store.read(self.layer, self.name).filter(within(BUCKET, self._buckets(rows)))
        return index.join(rows.select(self.key), self.key, "left_semi").select(self.key, self.place)

    @contextmanager
    def following(self, rows: DataFrame) -> Iterator[tuple[list, Parts]]:
        """Around a change of the table that merges ``rows`` by key: gives the partitions to rewrite and how to
        read the keys of ``rows`` that some of them hold; brings the index up to date when they are."""
        with durable_parts(self.find(rows), self.place) as (held, held_in):
            touched = held.select(self.place).union(rows.select(self.place))
            places = [r[0] for r in touched.distinct().collect()]
            fresh = self._entries(rows.select(self.key, self.place).exceptAll(held.select(self.key, self.place)))
            with durable_parts(fresh, BUCKET) as (changed, changed_in):
                self.store.put_note(self._mark)
                yield places, held_in
                buckets = self._buckets(changed)
                merge_partitions(self.store, self.layer, self.name, changed_in, changed_in, self.key, BUCKET, buckets)
                self.store.remove_note(self._mark)

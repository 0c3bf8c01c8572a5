"""Stored tables: one folder per layer and table, one subfolder per version.

A replacement is written to the next version's folder and counts once Spark has marked it complete,
so a job that dies halfway leaves readers on the previous version, and no plan overwrites what it
reads. Partitions are replaced inside a version, through a complete copy beside it. Readers never
write; a table has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterbook.session import NO_VALUE, partition_name


# Bytes of a row group before compression: the least a task can read.
ROW_GROUP = 32 * 1024 * 1024
# Bytes of partitions that one job rewrites, where one alone has not more, and such jobs at a time.
REWRITTEN = 128 * 1024 * 1024
CONCURRENT_REWRITES = 4


# Stored bytes that one task reads, and more of which are many tasks' work. What is not stored has no known size:
# Spark takes it for the largest there is.
LARGE, UNKNOWN = 24 * 1024 * 1024, 2**60


class MissingTable(LookupError):
    pass


def is_large(stored: DataFrame) -> bool:
    """Whether rows read from stored tables are more than one task reads, going by the size of the files."""
    return LARGE < int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < UNKNOWN


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def path_exists(self, path: str) -> bool:
        files, where = self._files(path)
        return files.exists(where)

    def version(self, layer: str, table: str) -> int:
        """The newest complete version, 0 if there is none."""
        files, where = self._files(self.folder(layer, table))
        if not files.exists(where):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(where)]
        done = [
            int(name[1:])
            for name in names
            if name[1:].isdigit() and self.path_exists(f"{self.folder(layer, table)}/{name}/_SUCCESS")
        ]
        return max(done, default=0)

    def exists(self, layer: str, table: str) -> bool:
        return self.version(layer, table) > 0

    def path(self, layer: str, table: str, version: int) -> str:
        return f"{self.folder(layer, table)}/v{version}"

    def read(self, layer: str, table: str) -> DataFrame:
        """The newest complete version. A reader changes nothing: where a replacement of partitions is
        complete but not moved in yet, its partitions are read from where they are."""
        version = self.version(layer, table)
        if not version:
            raise MissingTable(f"{layer}.{table}")
        path = self.path(layer, table, version)
        redo = self._redo(path)
        if redo is None:
            return self._read(path)
        settled = self._read(path)
        replaced = [name.partition("=")[2] for name in (*self._partitions(f"{path}.redo"), *redo["emptied"])]
        if not replaced:
            return settled
        rest = settled.filter(~_within(redo["partition"], replaced))
        return rest.unionByName(self._read(f"{path}.redo").select(*settled.columns))

    def _read(self, path: str) -> DataFrame:
        note = self._note(f"{path}.schema")
        reader = self.spark.read if note is None else self.spark.read.schema(T.StructType.fromJson(note["schema"]))
        return reader.parquet(path)

    def _note(self, path: str) -> dict | None:
        files, where = self._files(path)
        if not files.exists(where):
            return None
        stream = files.open(where)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def _keep_schema(self, df: DataFrame, path: str, **more) -> None:
        """A partitioned table without rows has no file to tell its columns."""
        files, where = self._files(f"{path}.schema")
        stream = files.create(where, True)
        stream.write(bytearray(json.dumps({"schema": df.schema.jsonValue(), **more}), "utf-8"))
        stream.close()

    def replace(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        finish: Callable[[DataFrame], DataFrame] = _as_it_is,
        in_place: bool = False,
    ) -> DataFrame:
        """SNK-04: write a whole table as its next version. ``finish`` completes rows that have moved to
        their partition: columns that follow from others need not move.

        ``in_place`` spares the move: every task writes a file of its own for each partition. That suits large
        tables of few partitions; rows that move take several times the room of these files."""
        version = self.version(layer, table) + 1
        path = self.path(layer, table, version)
        content = finish(df if in_place else _balanced(df, partition_by))
        if partition_by:
            self._keep_schema(content, path)
        _writer(content, "overwrite").partitionBy(*partition_by).parquet(path)
        # The version before stays for readers that still use it; the one before that goes.
        self._delete(self.path(layer, table, version - 2))
        return self._read(path)

    def append(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()) -> None:
        """Add rows to the current version."""
        path = self.path(layer, table, max(self.recover(layer, table), 1))
        _writer(_balanced(df, partition_by), "append").partitionBy(*partition_by).parquet(path)

    def replace_partitions(
        self, df: DataFrame, layer: str, table: str, partition: str, replaced: Sequence | None = None
    ) -> None:
        """Replace the partitions ``df`` has rows for, and empty those of ``replaced`` it has none for.

        ``df`` may read the table itself. The new content is written completely beside the version
        first, then its folders are moved in; if that breaks off, readers find the content where it is
        and the next writer moves the rest. A table has one writer at a time.
        """
        path = self.path(layer, table, self.recover(layer, table))
        _writer(_balanced(df, [partition]), "overwrite").partitionBy(partition).parquet(f"{path}.redo")
        written = set(self._partitions(f"{path}.redo"))
        emptied = [name for v in replaced or () if (name := partition_name(partition, v)) not in written]
        self._keep_schema(df, f"{path}.redo", partition=partition, emptied=emptied)
        self._move_in(path)

    def rewrite_partitions(
        self, layer: str, table: str, partition: str, replaced: Sequence, content: Callable[[Sequence], DataFrame]
    ) -> None:
        """Replace partitions like ``replace_partitions``, a few at a time: ``content`` gives the new rows of some
        of them, and may read the table. No rows move to come together; a partition gets a file of each task
        that has rows of it."""
        path = self.path(layer, table, self.recover(layer, table))
        if not replaced:
            return
        sizes = {v: self._bytes(f"{path}/{partition_name(partition, v)}") for v in replaced}
        settled = self._read(path)

        def write(part: tuple[int, Sequence]) -> None:
            folder = f"{path}.redo/_part-{part[0]}"
            rows = content(part[1]).select(*settled.columns)
            _writer(rows, "overwrite").partitionBy(partition).parquet(folder)
            for name in self._partitions(folder):
                self._rename(f"{folder}/{name}", f"{path}.redo/{name}")

        with ThreadPoolExecutor(max_workers=CONCURRENT_REWRITES) as pool:
            list(pool.map(write, enumerate(_grouped(sizes, REWRITTEN))))
        written = set(self._partitions(f"{path}.redo"))
        emptied = [name for v in replaced if (name := partition_name(partition, v)) not in written]
        self._keep_schema(settled, f"{path}.redo", partition=partition, emptied=emptied)
        self._move_in(path)

    def _bytes(self, path: str) -> int:
        files, where = self._files(path)
        return files.getContentSummary(where).getLength() if files.exists(where) else 0

    def _rename(self, path: str, to: str) -> None:
        files, where = self._files(path)
        if not files.rename(where, self._files(to)[1]):
            raise OSError(f"cannot move {where}")

    def recover(self, layer: str, table: str) -> int:
        """Finish a replacement of partitions that broke off; returns the newest complete version."""
        version = self.version(layer, table)
        path = self.path(layer, table, version)
        if self._redo(path) is not None:
            self._move_in(path)
        elif version and self.path_exists(f"{path}.redo"):
            self._delete(f"{path}.redo")  # never completed
        return version

    def _redo(self, path: str) -> dict | None:
        return self._note(f"{path}.redo.schema")

    def partitions(self, layer: str, table: str) -> list[str]:
        """The partition folders of the newest complete version."""
        return self._partitions(self.path(layer, table, self.version(layer, table)))

    def _partitions(self, path: str) -> list[str]:
        files, where = self._files(path)
        return [n for s in files.listStatus(where) if "=" in (n := s.getPath().getName())]

    def _move_in(self, path: str) -> None:
        """Folders are renamed one by one; what is still beside the version is what is left to do."""
        redo = self._redo(path)
        for name in self._partitions(f"{path}.redo"):
            self._delete(f"{path}/{name}")
            self._rename(f"{path}.redo/{name}", f"{path}/{name}")
        for name in redo["emptied"]:
            self._delete(f"{path}/{name}")
        self._delete(f"{path}.redo.schema")
        self._delete(f"{path}.redo")

    def put_note(self, path: str) -> None:
        files, where = self._files(path)
        files.create(where, True).close()

    def remove_note(self, path: str) -> None:
        self._delete(path)

    def _delete(self, path: str) -> None:
        files, where = self._files(path)
        files.delete(where, True)

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where


def _grouped(sizes: Mapping, most: int) -> list[list]:
    """What has a size, in groups of ``most`` together or of one that has more."""
    groups: list[list] = []
    held = most
    for one, size in sizes.items():
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(one)
        held += size
    return groups


def _within(partition: str, shown: Sequence[str]) -> Column:
    """Membership in partitions given by how their folders show them."""
    found = F.coalesce(F.col(partition).cast("string").isin([v for v in shown if v != NO_VALUE]), F.lit(False))
    return found | F.col(partition).isNull() if NO_VALUE in shown else found


def _writer(df: DataFrame, mode: str) -> DataFrameWriter:
    # Pages of the second kind keep ids and times by their differences.
    return df.write.mode(mode).options(**{"parquet.block.size": ROW_GROUP, "parquet.writer.version": "PARQUET_2_0"})


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather the rows of a partition into few files; a partition that is too big is split again."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df

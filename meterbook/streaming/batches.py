"""Rows of a stream by micro-batch, gathered into one folder every few batches.

A batch that is processed again overwrites its own folder. Gathering writes a complete folder of all
batches before; older folders count no more once it is complete, and go. So what a batch has to read is in
a bounded number of folders, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, GATHERED = "batch", "gathered"
GATHER_AFTER = 8


class BatchTable:
    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, partition: str):
        self.spark, self.folder = spark, folder
        self.schema, self.partition = schema, partition

    def write(self, rows: DataFrame, batch_id: int, mode: str = "overwrite") -> None:
        self._write(rows, f"{self.folder}/{BATCH}={batch_id}", mode)

    def _write(self, rows: DataFrame, path: str, mode: str) -> None:
        (
            rows.select(*self.schema.names)
            .hint("rebalance", F.col(self.partition))
            .write.mode(mode)
            .option("partitionOverwriteMode", "static")
            .partitionBy(self.partition)
            .parquet(path)
        )

    def of_batch(self, batch_id: int) -> DataFrame:
        return self._read([f"{self.folder}/{BATCH}={batch_id}"])

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before one."""
        base, batches = self._folders()
        paths = [f"{self.folder}/{GATHERED}={base}"] if base is not None else []
        wanted = [i for i in batches if before is None or i < before]
        return self._read([*paths, *(f"{self.folder}/{BATCH}={i}" for i in wanted)])

    def gather(self, before: int, after: int, keep: Callable[[DataFrame], DataFrame]) -> None:
        """Gathers the batches before this one, once there are ``after`` of them; ``keep`` drops what is not needed."""
        base, batches = self._folders()
        done = [i for i in batches if i < before]
        if len(done) < after:
            return
        folders = [*([f"{GATHERED}={base}"] if base is not None else []), *(f"{BATCH}={i}" for i in done)]
        rows = self._read([f"{self.folder}/{name}" for name in folders])
        self._write(keep(rows), f"{self.folder}/{GATHERED}={done[-1]}", "overwrite")
        for name in folders:
            files, where = self._files(f"{self.folder}/{name}")
            files.delete(where, True)

    def _read(self, paths: list[str]) -> DataFrame:
        found = [self.spark.read.schema(self.schema).parquet(path) for path in paths]
        if found:
            return reduce(DataFrame.unionByName, found)
        # Known to be empty when the plan is made, so joins with it go and no Python worker starts.
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]).where("false")

    def _folders(self) -> tuple[int | None, list[int]]:
        """The last gathered batch and the batches after it; a folder counts once it is complete."""
        files, where = self._files(self.folder)
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []

        def numbers(kind: str) -> list[int]:
            found = [n.partition("=")[2] for n in names if n.startswith(f"{kind}=")]
            done = [i for i in found if self._complete(f"{self.folder}/{kind}={i}")]
            return sorted(map(int, done))

        base = max(numbers(GATHERED), default=None)
        return base, [i for i in numbers(BATCH) if base is None or i > base]

    def _complete(self, path: str) -> bool:
        files, where = self._files(f"{path}/_SUCCESS")
        return files.exists(where)

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

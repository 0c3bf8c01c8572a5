"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects. AQE coalesces small shuffle partitions and splits
# skewed join partitions, which is what protects the row-grain lookups from a hot key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    # Stored tables are written once and read often. Their rows unfold to many times their size on disk, and
    # tasks sort them in memory before a shuffle, so a task reads few and a row group holds few.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "24m",
    # A partition has a file for each task that wrote it: a task reads many, so that it combines many rows.
    "spark.sql.files.openCostInBytes": "256k",
    # The JVM interprets methods of more than 8,000 bytes of code: staging of wide tables made such ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Joins whose partitions are this small after the shuffle (compressed) hash them instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# Settings that count only when the session is made: building a plan from Python is several times
# faster without recording the source line of every expression.
START_SETTINGS = {"spark.ui.enabled": "false", "spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "meterbook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_SETTINGS, **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach. Only a local master may fall back to a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="meterbook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back, so several consumers share one computation.

    A written file survives the loss of executors, unlike a cached block.
    """
    path = scratch_folder(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def durable_copy(df: DataFrame) -> Iterator[DataFrame]:
    """A durable copy that goes away when the work that shares it is done."""
    with _written(df, ()) as path:
        yield df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def durable_parts(df: DataFrame, partition: str) -> Iterator[tuple[DataFrame, Callable[[Sequence], DataFrame]]]:
    """A durable copy by partition, and how to read some partitions. Read from their own folders, they have
    their own size, by which Spark plans joins with them."""
    spark = df.sparkSession
    with _written(df, [partition]) as path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        held = {s.getPath().getName() for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)}

        def parts(values: Sequence) -> DataFrame:
            folders = [f"{path}/{name}" for v in values if (name := partition_name(partition, v)) in held]
            if not folders:
                return spark.createDataFrame([], df.schema)
            return spark.read.schema(df.schema).option("basePath", path).parquet(*folders)

        yield spark.read.schema(df.schema).parquet(path), parts


@contextmanager
def _written(df: DataFrame, partition_by: Sequence[str]) -> Iterator[str]:
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, "durable")
    df.write.partitionBy(*partition_by).parquet(path)
    try:
        yield path
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_name(partition: str, value) -> str:
    """The folder of a partition."""
    return f"{partition}={NO_VALUE if value is None else value}"

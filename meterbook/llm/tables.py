"""Intermediate tables in the shared folder, and joins with lists of ids."""

from __future__ import annotations

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbook.session import scratch_folder

# Ids sent to every executor at most: 2 million 64-bit ids are 16 MB. Longer lists are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """A lazy result may read an intermediate table until the application ends; then it goes."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder until the application ends: it cuts lineage and survives lost executors."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join with a written table of ids, whose size decides whether it is sent around."""
    ids = ids.select(key)
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, how)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def send(spark: SparkSession, value) -> Broadcast:
    """A broadcast of an object whose class travels with it: executors need not have this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def receive(sent: Broadcast):
    return pickle.loads(sent.value)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores in front, so that no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

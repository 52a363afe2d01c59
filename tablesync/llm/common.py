"""What the operators of this subpackage share: shared tables, packed rows and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, a temporary one on one machine, an error on a cluster."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it again, so that lineage ends there.

    A lost executor costs nothing that was written; every later read sees the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns as c0, c1, and so on: an operator's own names cannot clash with them."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def place(df: DataFrame, name: str) -> str:
    """The name that ``numbered`` gives to a column."""
    return f"c{[c.lower() for c in df.columns].index(name.lower())}"


def named(df: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``numbered(df)`` by their names in ``df``, less those named in ``but``."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in but]


def bucket_count(df: DataFrame, text: str = "text", bytes_each: int = 8 << 20) -> int:
    """Buckets for packed shuffles: two a shuffle partition, more where ``bytes_each`` of text would be passed."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_each))


def group_count(df: DataFrame, text: str = "text", bytes_each: int = 8 << 20) -> int:
    """Groups of a packed shuffle: one for each ``bytes_each`` of text, two a core at least."""
    total = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-total // bytes_each))


def added(df: DataFrame, keys: list[str], add, tasks: int = 256) -> DataFrame:
    """Packed counters of ``df``, one row a map task and key, summed by ``add`` (a group's table to its one row).

    First those of ``tasks`` neighbouring map tasks are summed, then these sums: with 100,000 map tasks no group
    holds more than 400 rows.
    """
    lane = F.floor(F.spark_partition_id() / tasks)
    near = df.withColumn("lane", lane).groupBy(*keys, "lane").applyInArrow(add, df.schema)
    return near.groupBy(*keys).applyInArrow(add, df.schema)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 2) -> Iterator[None]:
    """Inside, Arrow batches hold few rows: for tables whose rows are packed and take megabytes each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the value as text, modulo ``m``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of (id, text): rows that repeat both share it, and share their result."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def pack(a: np.ndarray) -> bytes:
    """An array's bytes by place value, so that small values leave runs of zeros to the codec."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()


def unpack(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    if not len(key):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b long); component: the least node reachable.

    Labels fall to the least among neighbours, then jump to their label's label, until none changes. Each
    round is a written table. A node with very many links only takes part in sums that are combined before
    the shuffle and in joins whose hot partitions Spark splits.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("low"))
        top = labels.select(F.col("node").alias("low"), F.col("component").alias("top"))
        new = materialise(low.join(top, "low", "left").select("node", "old", F.least("low", "top").alias("component")), "labels")
        labels = new.select("node", "component")
        if not new.filter("old <> component").limit(1).count():
            return labels

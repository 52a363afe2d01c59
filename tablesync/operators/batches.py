"""Batches of a table by key or by page, without a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.sources.shared import written


def global_rank(df: DataFrame, keys: list[str], to: str = "rn") -> DataFrame:
    """``df`` with its 0-based rank by ``keys``. Ranges are sorted apart; only their counts meet.

    Ties are broken in no order, and a key with very many rows takes several ranges: add columns that make the
    key unique where that matters.
    """
    ranged = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "__tie")
    ranged = written(ranged.withColumn("__part", F.spark_partition_id()), "ranged")
    # one row a range
    counts = ranged.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    local = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*keys, "__tie")))
    return local.join(offsets, "__part").withColumn(to, (F.col("__n") + F.col("__before") - 1).cast("long")).drop("__part", "__n", "__before", "__tie")


def assign_batches(df: DataFrame, order_by: list[str], size: int) -> DataFrame:
    """All pages at once: ``batch_id`` is the page's number."""
    return global_rank(df, order_by).withColumn("batch_id", F.floor(F.col("rn") / size)).drop("rn")


def key_ranks(df: DataFrame, key: str) -> DataFrame:
    """(key, n, rn): rows of each key, and how many rows come before its first.

    Keys are counted first, so a key with very many rows is one row from there on, and only keys and counts are sorted.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    ranged = written(counts.repartitionByRange(key).withColumn("__part", F.spark_partition_id()), "keys")
    # one row a range
    totals = ranged.groupBy("__part").agg(F.sum("n").alias("__total"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__total").over(earlier(Window.orderBy("__part"))), F.lit(0)).alias("__before")
    inside = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("__part").orderBy(key))), F.lit(0)).alias("__n")
    return ranged.select("__part", key, "n", inside).join(totals.select("__part", before), "__part").select(key, "n", (F.col("__n") + F.col("__before")).alias("rn"))


def batch_markers(df: DataFrame, key: str, size: int) -> DataFrame:
    """(rn, key): the first key of each batch of ``size`` rows."""
    first = F.ceil(F.col("rn") / size) * size
    last = F.col("rn") + F.col("n") - 1
    return key_ranks(df, key).filter(first <= last).select(F.explode(F.sequence(first, last, F.lit(size).cast("long"))).alias("rn"), key)


def batch_plan(markers: DataFrame, key: str, size: int) -> DataFrame:
    """(batch_id, lower_boundary, upper_boundary); the last one is open. Each marker meets the next one."""
    low = markers.select(F.floor(F.col("rn") / size).alias("batch_id"), F.col(key).alias("lower_boundary"))
    high = markers.select((F.floor(F.col("rn") / size) - 1).alias("batch_id"), F.col(key).alias("upper_boundary"))
    return low.join(high, "batch_id", "left")


def key_range_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` with ``batch_id``, as the ranges between markers give it: of rows with one key all lie in the
    batch of the last, so a key is never split. Rows without a key are left out."""
    ranks = key_ranks(df.filter(F.col(key).isNotNull()), key)
    last = ranks.select(key, F.floor((F.col("rn") + F.col("n") - 1) / size).alias("batch_id"))
    return df.join(last, key)


def read_page(df: DataFrame, order_by: list[str], offset: int, n: int) -> DataFrame:
    """One page; for all pages use ``assign_batches``, for deep ones key ranges."""
    return df.orderBy(*order_by).offset(offset).limit(n)

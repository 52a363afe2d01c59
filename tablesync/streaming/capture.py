"""Deletion markers from a stream of changes, and an incremental run that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def capture_deletions(events: DataFrame, type_map: DataFrame, within: str | None = None) -> DataFrame:
    """(p_itempk, p_table, changetype, modifiedts): one marker for each item and table; batch or stream.

    ``events``: item_pk, typecode, change, ts; ``type_map`` (few rows): typecode, table_name. A stream keeps a state row
    for each marker. With ``within`` (an interval, ``1 hour``) it forgets a marker once the watermark has passed it by
    that time, so state holds what is that recent: a repeat that comes while it is kept is dropped, one that comes after
    it was forgotten is a marker again (deleting again changes nothing), and one older than the watermark is dropped as
    late. Without ``within`` state grows with the markers.
    """
    own = events.filter("change = 'REMOVE'").join(type_map, "typecode")
    rows = own.select(F.col("item_pk").alias("p_itempk"), F.col("table_name").alias("p_table"), F.lit("DELETED").alias("changetype"), F.col("ts").alias("modifiedts"))
    if events.isStreaming and within:
        return rows.withColumn("modifiedts", F.col("modifiedts").cast("timestamp")).withWatermark("modifiedts", within).dropDuplicatesWithinWatermark(["p_itempk", "p_table"])
    if events.isStreaming:
        return rows.dropDuplicates(["p_itempk", "p_table"])
    return rows.groupBy("p_itempk", "p_table", "changetype").agg(F.min("modifiedts").alias("modifiedts"))


def run_available(changes: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All changes since the checkpoint, in batches, then stops; the checkpoint is the high-water mark.

    A batch may come twice after a crash; ``jobs.apply_changes`` makes functions that apply it once.
    """
    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a random but fixed order, form blocks of equal size. Block j (from 1) of a source
with weight w of a sum W may take a slot from its release time floor((j-1)W/w) up to its deadline
ceil(jW/w); the slot goes to the released block with the earliest deadline. In each prefix, each source is
within one block of its exact share, at any number of slots.

Stretches of slots are scheduled apart, in tasks. Where one ends for each source follows from where it began
without a walk over its slots (``ahead``): all blocks due by the end are done, and of the others released before
it, by deadline, those for which slots from their release on are left. One task hands on these ends.

The mix runs until every document has its slot. Sources that run out before begin again (``epoch``), so
target weights hold to the end and no document is lost.

Nulls and empties: rows with a null source are one source; null ids and texts are values like others;
repeated rows are documents of their own; empty input gives an empty mix. Other columns pass through;
those named like the three new ones are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import materialise, named, numbered, place

MOST_SOURCES = 10_000
STRETCH = 4096
FINE = 1 << 44


def ahead(at: list[int], start: int, end: int, weights: list[int]) -> list[int]:
    """Blocks of each source in slots before ``end``, if ``at`` are those before ``start``."""
    total = sum(weights)
    free, out, later = np.arange(end - start, 0, -1), list(at), []
    taken = np.zeros(end - start, np.int64)
    for i, w in enumerate(weights):
        due = end * w // total
        if due > at[i]:
            first = (at[i] * total - start * w + np.arange(due - at[i]) * total) // w
            taken += np.bincount(np.maximum(first, 0), minlength=end - start)
            out[i] = due
        if out[i] * total < end * w:
            later.append((-(-(out[i] + 1) * total // w), i, max(out[i] * total // w - start, 0)))
    # slots left for blocks released at a slot or after it
    free -= np.cumsum(taken[::-1])[::-1]
    for _, i, release in sorted(later):
        if free[: release + 1].min() > 0:
            free[: release + 1] -= 1
            out[i] += 1
    return out


def stretch_slots(at: list[int], start: int, end: int, weights: list[int]) -> Iterator[tuple[int, int, int]]:
    """(slot, source, block from 0) of the slots from ``start`` up to ``end``; earliest deadline first."""
    total, at = sum(weights), list(at)
    waiting = [(at[i] * total // w, i) for i, w in enumerate(weights)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    for t in range(start, end):
        while waiting and waiting[0][0] <= t:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(at[i] + 1) * total // weights[i]), i))
        _, i = heapq.heappop(ready)
        yield t, i, at[i]
        at[i] += 1
        heapq.heappush(waiting, (at[i] * total // weights[i], i))


def _starts(weights: list[int], stretch: int, upto: int):
    """For each stretch before slot ``upto``, its first slot and the blocks of each source before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [0] * len(weights)
            for start in range(0, upto if b.num_rows else 0, stretch):
                yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([at], pa.list_(pa.int64()))], names=["start", "at"])
                at = ahead(at, start, start + stretch, weights)

    return run


def _schedule(weights: list[int], blocks: list[int], stretch: int):
    """For each stretch, its slots with their source's number, epoch and block in the epoch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = [(t, i, k // blocks[i], k % blocks[i]) for t, i, k in stretch_slots(at, start, start + stretch, weights)]
                cols = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["mix_slot", "__i", "mix_epoch", "__k"])

    return run


def whole_weights(shares: list[float], period: int) -> list[int]:
    """Integers of at least 1 with the sum ``period``, in proportion to ``shares`` by largest remainders."""
    spare, total = period - len(shares), sum(shares)
    exact = [spare * s / total for s in shares]
    out = [int(x) for x in exact]
    for i in sorted(range(len(shares)), key=lambda i: (out[i] - exact[i], i))[: spare - sum(out)]:
        out[i] += 1
    return [x + 1 for x in out]


def mix(docs: DataFrame, weights: dict | None = None, temperature: float = 0.85, block: int = 16, period: int | None = None, source: str = "source", doc_id: str = "doc_id", rank_by: list[str] | None = None, in_order: bool = False) -> DataFrame:
    """``docs`` with mix_epoch long, mix_slot long and mix_order long: a row for each placement.

    ``weights``: a share for each source (null key: null source); None: row counts to the power
    ``temperature``; with ``period``, shares are first rounded to parts of it. Sources without a share raise. Sorted by mix_order, the rows are the mix;
    ``in_order`` deals and sorts them so that the partitions, one after the other, are. Up to
    ``MOST_SOURCES`` sources, more raise; only their counts come to the driver.
    """
    spark, given = docs.sparkSession, docs
    docs, source, keys = numbered(given), place(given, source), [place(given, c) for c in rank_by or [c for c in (doc_id, "text") if c in given.columns]]
    counts = docs.groupBy(F.col(source).alias("s")).count().limit(MOST_SOURCES + 1).collect()
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    counts = sorted(((r["s"], r["count"]) for r in counts), key=lambda x: (x[0] is None, str(x[0])))
    if weights is not None and (lost := [s for s, _ in counts if not weights.get(s)]):
        raise ValueError(f"no weight for sources {lost[:5]}")
    shares = [weights[s] if weights is not None else n**temperature for s, n in counts]
    if period is not None:
        w = whole_weights(shares, max(period, 16 * len(counts))) if counts else []
    else:
        w = [max(1, int(FINE * (x / sum(shares)))) for x in shares]
    total = sum(w)
    blocks = [-(-n // block) for _, n in counts]
    upto = max((-(-b * total // x) for b, x in zip(blocks, w)), default=0)
    stretch = max(STRETCH, 16 * len(w))
    pieces = max(1, min(-(-upto // stretch), max(int(spark.conf.get("spark.sql.shuffle.partitions")), upto // stretch // 64)))
    starts = spark.range(0, 1, 1, 1).mapInArrow(_starts(w, stretch, upto), "start long, at array<long>").repartition(pieces, "start")
    schedule = materialise(starts.mapInArrow(_schedule(w, blocks, stretch), "mix_slot long, __i int, mix_epoch long, __k long"), "schedule")
    kind = docs.schema[source].dataType
    table = spark.createDataFrame([(s, i, b - 1) for i, ((s, _), b) in enumerate(zip(counts, blocks))], f"__s {kind.simpleString()}, __i int, __last long")
    last = schedule.filter("mix_epoch = 0").join(F.broadcast(table), "__i").filter("__k = __last")
    end = last.agg(F.coalesce(F.max("mix_slot"), F.lit(-1))).first()[0]

    parts = max(sum(n for _, n in counts) // 20_000, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = docs.join(F.broadcast(table.select("__s", "__i")), F.col(source).eqNullSafe(F.col("__s"))).drop("__s").withColumn("__h", F.xxhash64(*keys)).withColumn("__part", F.pmod("__h", F.lit(parts)).cast("int"))
    earlier = Window.partitionBy("__i").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hashed.groupBy("__i", "__part").count().select("__i", "__part", "count", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    # of each part of a source and epoch, the slots of its blocks in order; those after the end are the last
    spans = offsets.withColumn("__k", F.explode(F.sequence(F.floor(F.col("__before") / block), F.floor((F.col("__before") + F.col("count") - 1) / block))))
    slots = spans.join(schedule.filter(F.col("mix_slot") <= end), ["__i", "__k"]).groupBy("__i", "__part", "__before", "mix_epoch").agg(F.sort_array(F.collect_list("mix_slot")).alias("__slots"))
    inner = Window.partitionBy("__i", "__part").orderBy("__h", *keys)
    ranked = hashed.withColumn("__n", F.row_number().over(inner))
    placed = ranked.join(slots, ["__i", "__part"]).withColumn("__n", F.col("__n") + F.col("__before") - 1)
    at = F.floor(F.col("__n") / block) - F.floor(F.col("__before") / block)
    new = ("mix_epoch", "mix_slot", "mix_order")
    out = placed.withColumn("mix_slot", F.get("__slots", at.cast("int"))).filter("mix_slot IS NOT NULL")
    out = out.withColumn("mix_order", F.col("mix_slot") * block + F.col("__n") % block)
    if in_order:
        deals = max((end + 1) * block // 20_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
        out = out.repartitionById(deals, F.floor(F.col("mix_slot") * deals / (end + 1)).cast("int")).sortWithinPartitions("mix_order")
    return out.select(*named(given, new), *new)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "source"))


QUERIES = {"op7_mix_sources": op7_mix_sources}
ORACLES: dict[str, str] = {}

"""The ledger: tasks, batches, status, throughput and reports."""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.plans.schema import write_schema_changes
from tablesync.sources.files import Folder


def rollup_status(tasks: DataFrame, key: str = "migrationid", total: int | None = None) -> DataFrame:
    """(key, last_update, total, completed, failed) of each run; ``total`` fixed for schema differences."""
    n = F.count("*") if total is None else F.lit(total).cast("long")
    return tasks.groupBy(key).agg(F.max("lastupdate").alias("last_update"), n.alias("total"), F.count_if(F.col("duration").isNotNull()).alias("completed"), F.count_if(F.col("failure") == 1).alias("failed"))


def run_status(runs: DataFrame, tasks: DataFrame, key: str = "migrationid") -> DataFrame:
    """``runs`` with the roll-up of their tasks; a run without tasks has none of 0."""
    zero = ("total", "completed", "failed")
    return runs.join(rollup_status(tasks, key), key, "left").fillna(0, list(zero))


def migration_status(rollup: DataFrame, done: str = "PROCESSED", stalled: Column | None = None) -> DataFrame:
    """Adds end_at, status, is_completed and is_failed."""
    over = F.col("completed") >= F.col("total")
    stuck = F.lit(False) if stalled is None else F.coalesce(stalled, F.lit(False)) & ~over
    return rollup.withColumns({"end_at": F.when(over, F.col("last_update")), "status": F.when(stuck, "STALLED").when(over, done).otherwise("RUNNING"), "is_completed": over | stuck, "is_failed": (F.col("failed") > 0) | stuck})


def stalled(tasks: DataFrame, now: Column, seconds: int = 7200, key: str = "migrationid") -> DataFrame:
    """Runs whose last update is more than ``seconds`` before ``now``."""
    last = tasks.groupBy(key).agg(F.max("lastupdate").alias("last_update"))
    return last.filter(F.col("last_update") < now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds)))


def throughput(batches: DataFrame, key: str) -> DataFrame:
    """Rows a second: over all, and the slowest and the fastest batch."""
    rate = F.col("rows") / F.col("seconds")
    return batches.groupBy(key).agg((F.sum("rows") / F.sum("seconds")).alias("average"), F.min(rate).alias("slowest"), F.max(rate).alias("fastest"))


def throughput_by_category(batches: DataFrame, recorder: str, category: str) -> DataFrame:
    each = batches.groupBy(category, recorder).agg((F.sum("rows") / F.sum("seconds")).alias("average"))
    return each.groupBy(category).agg(F.coalesce(F.avg("average"), F.lit(0.0)).alias("mean_throughput"))


def pending_batches(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Planned batches that are not written; their bounds stay as planned."""
    return plan.join(done.select(*keys), keys, "left_anti")


def pending_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.filter("duration IS NULL").orderBy("sourcerowcount", "pipelinename")


def failed_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.filter("failure = 1").orderBy("sourcerowcount", "pipelinename")


def updated_tasks(tasks: DataFrame, since: Column) -> DataFrame:
    return tasks.filter(F.col("lastupdate") >= since)


def latest_run(runs: DataFrame, run_id: str, start: str) -> DataFrame:
    """The id with the latest start; of several, the greatest."""
    return runs.agg(F.max_by(run_id, F.struct(start, run_id)).alias(run_id))


def write_report(report: DataFrame, path: str) -> None:
    """One row as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


TASKS = (
    "migrationid string, pipelinename string, sourcetablename string, targettablename string, sourcerowcount long, targetrowcount long, failure int, error string, "
    "truncated boolean, duration string, durationinseconds double, avgreaderrowthroughput double, avgwriterrowthroughput double, lastupdate timestamp"
)
BATCHES = "migrationid string, pipelinename string, batchid long, lowerboundary string, upperboundary string"
CHANGES = "migrationid string, table_name string, column_name string, type string, change string"
WRITTEN = "migrationid string, pipelinename string, batchid long, rows_read long, rows_written long, seconds double, lastupdate timestamp"


@dataclass(frozen=True)
class Ledger:
    """Tasks, batches and written batches of all runs, each a folder of Parquet rows that are only added.

    A task's newest row holds. Rows are a few numbers a table or batch, taken while it is written, so no table is read
    again to count it. What is visible in a target is told by the target itself (its manifest, or its table of
    applied batches); the ledger follows, and a batch that is there already is noted when the run is resumed.
    """

    spark: SparkSession
    path: str

    def _rows(self, name: str, schema: str) -> DataFrame:
        at = f"{self.path}/{name}"
        if not Folder(self.spark, at).exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(at)

    def _add(self, name: str, schema: str, rows: list[tuple]) -> None:
        # a folder each, as tables that are copied at the same time may add rows at the same time
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.path}/{name}/{uuid.uuid4().hex}")

    def tasks(self, run: str | None = None) -> DataFrame:
        own = self._rows("tasks", TASKS)
        newest = own.groupBy("migrationid", "pipelinename").agg(F.max_by(F.struct(*own.columns), "lastupdate").alias("r")).select("r.*")
        return newest if run is None else newest.filter(F.col("migrationid") == run)

    def batches(self, run: str) -> DataFrame:
        return self._rows("batches", BATCHES).filter(F.col("migrationid") == run)

    def written(self, run: str) -> DataFrame:
        """One row a batch, also where a resumed run has noted it again."""
        return self._rows("written", WRITTEN).filter(F.col("migrationid") == run).dropDuplicates(["pipelinename", "batchid"])

    def pending(self, run: str) -> DataFrame:
        return pending_batches(self.batches(run), self.written(run), ["pipelinename", "batchid"])

    def register(self, run: str, table: str, bounds: list[tuple[str | None, str | None]]) -> None:
        self._add("batches", BATCHES, [(run, table, i, low, high) for i, (low, high) in enumerate(bounds)])

    def note(self, run: str, table: str, batches: list[int], read: int, wrote: int, seconds: float) -> None:
        """A group of batches was written together; its first one has the group's numbers."""
        now = datetime.datetime.now(datetime.timezone.utc)
        self._add("written", WRITTEN, [(run, table, b, *((read, wrote, seconds) if i == 0 else (0, 0, 0.0)), now) for i, b in enumerate(batches)])

    def finish(self, run: str, table: str, target: str, read: int | None, wrote: int | None, seconds: float, error: str | None = None, truncated: bool = False) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        rate = lambda n: None if n is None or not seconds else n / seconds
        took = None if error else str(datetime.timedelta(seconds=seconds))
        self._add("tasks", TASKS, [(run, table, table, target, read, wrote, int(error is not None), error, truncated, took, seconds, rate(read), rate(wrote), now)])

    def reconcile(self, run: str) -> DataFrame:
        """(pipelinename, source_rows, target_rows, difference) as counted while the run wrote."""
        return self.tasks(run).select("pipelinename", F.col("sourcerowcount").alias("source_rows"), F.col("targetrowcount").alias("target_rows"), (F.col("sourcerowcount") - F.col("targetrowcount")).alias("difference"))

    def note_changes(self, run: str, table: str, changes: list[tuple[str, str, str]]) -> None:
        """Changes of a table's schema: (column, type, added or removed)."""
        made = self.spark.createDataFrame([(run, table, *c) for c in changes], CHANGES)
        write_schema_changes(made, f"{self.path}/schema_changes/{uuid.uuid4().hex}")

    def schema_changes(self) -> DataFrame:
        at = f"{self.path}/schema_changes"
        if not Folder(self.spark, at).exists():
            return self.spark.createDataFrame([], CHANGES)
        return self.spark.read.schema(CHANGES).option("recursiveFileLookup", True).json(at)

"""Full and incremental runs, as DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.functions.names import is_localized
from tablesync.operators.batches import batch_markers
from tablesync.operators.delta import delta, deletion_markers, localized_delta
from tablesync.operators.merge import alter_jdbc, append, applied, apply_jdbc, delete_by_key, drop_table, merge_files, overwrite, tables_to_clear, unique_by, upsert
from tablesync.plans.ledger import Ledger
from tablesync.plans.schema import Switches, evolved, fitted
from tablesync.sources.files import Folder
from tablesync.sources.profile import (
    Profile, default_conditions, drop_views, list_tables, markers_jdbc, read_between, read_by_key_bounds, read_catalogue, read_table, source_files, table_exists,
)
from tablesync.sources.shared import written

Rules = Callable[[DataFrame], DataFrame]


def full_sync(source: DataFrame, target: DataFrame, truncate: bool = True, excluded: bool = False, rules: Rules = lambda df: df) -> DataFrame:
    """The target after a full copy: replaced with ``truncate``, else with the rows appended.

    A table that is ``excluded`` from truncation is appended to, but an empty source empties it all the same.
    """
    new = rules(source)
    if truncate and not excluded:
        return new
    kept = target
    if truncate:
        kept = target.filter(source.select(F.lit(1).alias("one")).limit(1).agg(F.count("*")).scalar() > 0)
    return kept.unionByName(new, allowMissingColumns=True)


def incremental_sync(target: DataFrame, changed: DataFrame, markers: DataFrame, key: str, checked: bool = True) -> DataFrame:
    """Deletions first, then the delta's upsert: a key that was deleted and made again survives."""
    return upsert(delete_by_key(target, markers, key), changed, [key], checked=checked)


def run_tables(tables: list[str], copy: Callable[[str], None], fail_on_error: bool = False, tables_at_once: int = 1) -> list[tuple[str, str | None]]:
    """(table, error) of each table; the first failure ends the run only if asked to.

    Of many small tables several can be copied at a time, so that the cluster is not idle while one ends: each is
    Spark jobs of its own, submitted from a thread of its own.
    """

    def one(table: str) -> tuple[str, str | None]:
        try:
            copy(table)
        except Exception as e:
            if fail_on_error:
                raise
            return table, str(e)
        return table, None

    if tables_at_once == 1:
        return [one(t) for t in tables]
    with ThreadPoolExecutor(tables_at_once) as pool:
        return list(pool.map(inheritable_thread_target(one), tables))


class Counted:
    """Rows that pass two places of a plan, and seconds, taken while it is written."""

    def __init__(self) -> None:
        self.began = time.monotonic()
        self._read, self._written = Observation(), Observation()

    def source(self, df: DataFrame) -> DataFrame:
        return df.observe(self._read, F.count(F.lit(1)).alias("n"))

    def target(self, df: DataFrame) -> DataFrame:
        return df.observe(self._written, F.count(F.lit(1)).alias("n"))

    @property
    def read(self) -> int:
        return self._read.get["n"]

    @property
    def written(self) -> int:
        return self._written.get["n"]

    @property
    def seconds(self) -> float:
        return time.monotonic() - self.began


def _stored(spark: SparkSession, profile: Profile, name: str) -> StructType | None:
    return read_table(spark, profile, name).schema if table_exists(spark, profile, name) else None


def _recorded(ledger: Ledger | None, run: str, target: Profile, name: str, count: Counted, work: Callable[[], bool]) -> None:
    """Does a table's work, which tells whether the table was emptied, and puts its outcome into the ledger."""
    at = f"{target.prefix}{name}"
    try:
        truncated = work()
        if ledger:
            ledger.finish(run, name, at, count.read, count.written, count.seconds, truncated=truncated)
    except Exception as e:
        if ledger:
            ledger.finish(run, name, at, None, None, count.seconds, str(e)[:1000])
        raise


def run_full(
    spark: SparkSession, source: Profile, target: Profile, tables: list[str], truncate: bool = True, excluded: tuple[str, ...] = (),
    done: tuple[str, ...] = (), rules: dict[str, Rules] | None = None, ledger: Ledger | None = None, run: str = "full",
    switches: Switches | None = None, tables_at_once: int = 1,
) -> list[tuple[str, str | None]]:
    """Copies tables from profile to profile and returns (table, error) of each.

    ``excluded``: tables that truncation spares; ``done``: those that an earlier, interrupted run has copied.
    With a ``ledger``, rows read and written and seconds of each table go there as ``run``. With ``switches``, rows are
    fitted to the target's stored schema, which changes as they allow; the changes go to the ledger. Views of the
    source take the place of its tables, and are dropped in the end.
    """
    lower = lambda names: {n.lower() for n in names}

    def copied(name: str, count: Counted) -> bool:
        read = read_table(spark, source, name, views=True)
        rows = (rules or {}).get(name, lambda df: df)(count.source(read))
        kind, changes = None, []
        if switches:
            stored = _stored(spark, target, name)
            if stored is None and not switches.add_tables:
                raise ValueError(f"the target has no table {name}, and none may be added")
            kind, changes = evolved(rows.schema, stored, switches)
            rows = fitted(rows, kind)
            if stored is not None and target.is_jdbc:
                alter_jdbc(spark, target, name, changes)
        cleared = truncate and (name.lower() not in lower(excluded) or not read.take(1))
        if cleared:
            overwrite(count.target(rows), target, name)
        else:
            append(count.target(rows), target, name, kind=kind)
        if changes and ledger:
            ledger.note_changes(run, name, changes)
        return cleared

    def copy(name: str) -> None:
        count = Counted()
        _recorded(ledger, run, target, name, count, lambda: copied(name, count))

    outcomes = run_tables([t for t in tables if t.lower() not in lower(done)], copy, tables_at_once=tables_at_once)
    if switches and switches.remove_tables:
        superfluous = [r[0] for r in tables_to_clear(list_tables(read_catalogue(spark, target)), spark.createDataFrame([(f"{target.prefix}{t}",) for t in tables], "table_name string")).collect()]
        outcomes += run_tables([t.removeprefix(target.prefix.lower()) for t in superfluous], lambda name: drop_table(spark, target, name))
    drop_views(spark, tables)
    return outcomes


def plan_batches(spark: SparkSession, source: Profile, name: str, keys: list[str], rows: int, size: int) -> list[tuple[str | None, str | None]]:
    """Bounds of a table's batches: of a folder, names of neighbouring files of ``size`` bytes; of a database and of a
    view, keys ``rows`` apart, which the database and Spark find. One batch without bounds where a table cannot be
    parted. A bound a batch comes to the driver."""
    is_view = spark.catalog.tableExists(f"v_{name}")
    lows: list[str] = []
    if is_view and keys:
        marked = batch_markers(spark.table(f"v_{name}").filter(F.col(keys[0]).isNotNull()).select(keys[0]), keys[0], rows)
        lows = [r[0] for r in marked.select(F.col(keys[0])).distinct().orderBy(keys[0]).select(F.col(keys[0]).cast("string")).collect()]
    elif source.is_jdbc and not is_view and keys:
        lows = [str(r[0]) for r in markers_jdbc(spark, source, name, keys[0], rows).collect()]
    elif not is_view and not source.is_jdbc:
        left = 0
        for file, n in source_files(spark, source, name):
            if left <= 0:
                lows.append(file)
                left = size
            left -= n
    return list(zip(lows, [*lows[1:], None])) or [(None, None)]


def _batch_rows(spark: SparkSession, source: Profile, name: str, keys: list[str], bounds: list[tuple[str | None, str | None]], first: bool) -> DataFrame:
    if bounds[0][0] is None:
        return read_table(spark, source, name, views=True)
    if spark.catalog.tableExists(f"v_{name}"):
        return read_between(spark.table(f"v_{name}"), keys[0], bounds, first)
    if source.is_jdbc:
        return read_by_key_bounds(spark, source, name, keys[0], bounds, first)
    files = [f for f, _ in source_files(spark, source, name) if any(low <= f and (high is None or f < high) for low, high in bounds)]
    return default_conditions(Folder(spark, source.path(name)).read(only=files), name, source.type_system)


def run_resumable(
    spark: SparkSession, source: Profile, target: Profile, tables: dict[str, list[str]], ledger: Ledger, run: str,
    rows: int = 1_000_000, size: int = 1 << 30, at_once: int = 16, truncate: bool = True, excluded: tuple[str, ...] = (),
    rules: dict[str, Rules] | None = None, tables_at_once: int = 1,
) -> list[tuple[str, str | None]]:
    """A full copy in batches, which goes on where an earlier call of the same ``run`` ended.

    A table's batches are registered with their bounds before the first is written, and keep them. ``at_once`` of them
    are one Spark job, added to the target together with their marks, so each is there once, whenever a call ends. The
    target is emptied once, by the first of them. ``tables``: names and keys (needed to part a database's table).
    """
    spared = {t.lower() for t in excluded}

    def copy(name: str) -> None:
        keys = tables[name]
        if ledger.tasks(run).filter((F.col("pipelinename") == name) & (F.col("failure") == 0)).take(1):
            return
        if not ledger.batches(run).filter(F.col("pipelinename") == name).take(1):
            ledger.register(run, name, plan_batches(spark, source, name, keys, rows, size))
        # a number and two bounds a batch
        left = ledger.pending(run).filter(F.col("pipelinename") == name).orderBy("batchid").collect()
        here = applied(spark, target, name, f"run:{run}")
        if noted := [b["batchid"] for b in left if b["batchid"] in here]:
            ledger.note(run, name, noted, 0, 0, 0.0)
        left = [b for b in left if b["batchid"] not in here]
        cleared = bool(here) or not truncate or name.lower() in spared
        began = time.monotonic()
        for i in range(0, len(left), at_once):
            group = left[i : i + at_once]
            count = Counted()
            own = _batch_rows(spark, source, name, keys, [(b["lowerboundary"], b["upperboundary"]) for b in group], group[0]["batchid"] == 0)
            made = count.target((rules or {}).get(name, lambda df: df)(count.source(own)))
            mark = f"run:{run}", [b["batchid"] for b in group]
            if target.is_jdbc:
                apply_jdbc(target, name, made, [], mark=mark, clear=not cleared)
            elif cleared:
                append(made, target, name, mark)
            else:
                overwrite(made, target, name, mark)
            cleared = True
            ledger.note(run, name, mark[1], count.read, count.written, count.seconds)
        total = ledger.written(run).filter(F.col("pipelinename") == name).agg(F.sum("rows_read"), F.sum("rows_written"), F.sum("seconds")).first()
        ledger.finish(run, name, f"{target.prefix}{name}", total[0], total[1], total[2] or time.monotonic() - began, truncated=truncate)

    outcomes = run_tables(list(tables), copy, tables_at_once=tables_at_once)
    for name, error in outcomes:
        if error:
            ledger.finish(run, name, f"{target.prefix}{name}", None, None, 0.0, error[:1000])
    return outcomes


def apply_changes(target: Profile, name: str, keys: list[str], order_col: str, stream: str, removed: Column) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the last change of each key by ``order_col`` deletes its row where ``removed`` holds, else
    upserts it (of changes at one time, one that keeps the row). A batch is applied once, however often it comes: its
    number goes into the target with the rows. A null key changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        last = F.max_by(F.struct(*batch.columns), F.struct(F.col(order_col), ~F.coalesce(removed, F.lit(False))))
        newest = written(batch.dropna(subset=keys).groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(last.alias("r")).select("r.*"), "changes")
        kept = newest.filter(~F.coalesce(removed, F.lit(False)))
        gone = newest.filter(removed).select(*keys)
        write = apply_jdbc if target.is_jdbc else merge_files
        write(target, name, kept, keys, gone, mark=(f"stream:{stream}", [number]))

    return apply


def run_incremental(
    spark: SparkSession, source: Profile, target: Profile, tables: dict[str, list[str]], mark: str | None, started: str,
    markers: DataFrame | None = None, ts_col: str = "modifiedts", as_time: Callable[[str], Column] = F.lit,
    ledger: Ledger | None = None, tables_at_once: int = 1,
) -> tuple[str, list[tuple[str, str | None]]]:
    """An incremental run over tables with their keys: of each its deletions, then its changed rows, in one step;
    localised tables (``lp``) come last.

    Returns the new mark, which stays the old one if any table failed, and (table, error) of each. A localised
    table has the rows of its base table's items (``itempk``) that changed; keys of others are their own. Deletions are
    left out as a whole if the target lacks one of their tables. Views stand for the source's tables only, and are
    dropped in the end.

    In a folder, only files with a changed key are written anew, and a table changes by one manifest. In a database,
    a table changes in one transaction.
    """
    next_mark(mark, started, [])
    since = as_time(mark)
    base = lambda name: name[:-2]
    plain = [t for t in tables if not is_localized(t)]
    deleting = markers is not None and all(table_exists(spark, target, t) for t in plain)

    def merged(name: str, count: Counted) -> bool:
        if is_localized(name):
            changed = delta(read_table(spark, source, base(name), views=True), since, ts_col)
            rows = localized_delta(read_table(spark, source, name, views=True), changed, "itempk", tables.get(base(name), ["pk"])[0])
        else:
            rows = delta(read_table(spark, source, name, views=True), since, ts_col)
        gone = None
        if deleting and not is_localized(name):
            gone = deletion_markers(markers, name, since).select(F.col("p_itempk").alias(tables[name][0]))
        rows = written(count.target(count.source(rows)), "delta")
        if not table_exists(spark, target, name):
            append(unique_by(rows, tables[name]), target, name)
        else:
            (apply_jdbc if target.is_jdbc else merge_files)(target, name, rows, tables[name], gone)
        return False

    def merge(name: str) -> None:
        count = Counted()
        _recorded(ledger, started, target, name, count, lambda: merged(name, count))

    outcomes = run_tables(plain, merge, tables_at_once=tables_at_once)
    outcomes += run_tables([t for t in tables if is_localized(t)], merge, tables_at_once=tables_at_once)
    drop_views(spark, list(tables))
    return next_mark(mark, started, outcomes), outcomes


def next_mark(old: str | None, started: str, outcomes: list[tuple[str, str | None]]) -> str:
    """The new high-water mark: this run's start, if nothing failed. Without an old mark no run may begin."""
    if old is None:
        raise ValueError("an incremental run needs a high-water mark")
    return old if any(e for _, e in outcomes) else started

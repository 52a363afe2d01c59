"""Schema differences and alignment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tables of ``left`` (table_name) that ``right`` lacks, in lower case."""
    names = lambda df: df.select(F.lower("table_name").alias("table_name")).distinct()
    return names(left).join(names(right), "table_name", "left_anti")


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, common_name, full_name): candidates of each side that the other lacks, by their common names,
    that is after prefixes and type-system suffixes are taken off (``catalog.candidates``)."""
    less = lambda side, a, b: a.join(b, "common_name", "left_anti").select(F.lit(side).alias("side"), "common_name", "full_name")
    return less("source", left, right).union(less("target", right, left))


def missing_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns that ``right`` lacks in tables that both have; types are not compared."""
    names = lambda df: df.select(F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")).distinct()
    both = names(left).join(names(right).select("table_name").distinct(), "table_name", "left_semi")
    return both.join(names(right), ["table_name", "column_name"], "left_anti")


def summary(missing: DataFrame) -> DataFrame:
    return missing.groupBy("table_name").agg(F.array_join(F.sort_array(F.collect_list("column_name")), ";").alias("columns"))


def align_tables(left: DataFrame, right: DataFrame, add: bool = True, remove: bool = True) -> DataFrame:
    """Tables (common_name) of the target's schema after alignment: its own, with the source's missing ones if
    ``add``, without those that only it has if ``remove``."""
    own, other = right.select("common_name").distinct(), left.select("common_name").distinct()
    kept = own.join(other, "common_name", "left_semi") if remove else own
    return kept.union(other.join(own, "common_name", "left_anti")) if add else kept


def align_schema(df: DataFrame, target: T.StructType, add: bool = True, remove: bool = True) -> DataFrame:
    """The target's columns, missing ones as typed nulls; superfluous ones stay unless ``remove``."""
    own = {c.lower(): c for c in df.columns}
    cols = [F.col(own[f.name.lower()]).cast(f.dataType).alias(f.name) if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name) for f in target if add or f.name.lower() in own]
    rest = [] if remove else [c for c in df.columns if c.lower() not in {f.name.lower() for f in target}]
    return df.select(*cols, *rest)


@dataclass(frozen=True)
class Switches:
    """What a run may change in the target's schema."""

    add_tables: bool = True
    remove_tables: bool = False
    add_columns: bool = True
    remove_columns: bool = False


def evolved(source: T.StructType, target: T.StructType | None, switches: Switches) -> tuple[T.StructType, list[tuple[str, str, str]]]:
    """The target's schema after a run, and the changes to it: (column, type, added or removed).

    Without a target the source's schema is taken. Columns keep the target's types and places; new ones come last.
    """
    if target is None:
        return source, [(f.name, f.dataType.simpleString(), "added") for f in source]
    has = {f.name.lower() for f in source}
    own = {f.name.lower() for f in target}
    kept = [f for f in target if f.name.lower() in has or not switches.remove_columns]
    new = [T.StructField(f.name, f.dataType) for f in source if f.name.lower() not in own] if switches.add_columns else []
    if not kept + new:
        raise ValueError("no column of the target would be left")
    changes = [(f.name, f.dataType.simpleString(), "added") for f in new]
    return T.StructType(kept + new), changes + [(f.name, f.dataType.simpleString(), "removed") for f in target if f not in kept]


def fitted(df: DataFrame, kind: T.StructType) -> DataFrame:
    """``df`` with the columns of ``kind`` and no others; missing ones are null."""
    return align_schema(df, kind, add=True, remove=True)


def write_schema_changes(changes: DataFrame, path: str) -> None:
    """Adds a run's changes, rows of JSON, to those of earlier runs."""
    changes.coalesce(1).write.mode("append").json(path)

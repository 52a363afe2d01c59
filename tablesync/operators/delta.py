"""Restricting a table to what changed, and counting that."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delta(df: DataFrame, since: Column | None, ts_col: str) -> DataFrame:
    """Rows with a timestamp strictly after ``since``; none given is an error."""
    if since is None:
        raise ValueError("an incremental read needs a timestamp")
    return df.filter(F.col(ts_col) > since)


def deletion_markers(markers: DataFrame, table: str, since: Column | None = None) -> DataFrame:
    own = markers.filter(F.col("p_table") == table)
    return own if since is None else own.filter(F.col("modifiedts") > since)


def localized_delta(localized: DataFrame, changed: DataFrame, item_pk: str, pk: str) -> DataFrame:
    """Localised rows, which have no timestamp, of changed base rows."""
    return localized.join(changed.select(F.col(pk).alias(item_pk)), item_pk, "left_semi")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of all tables in one job."""
    each = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows by marker table or physical partition."""
    return df.groupBy(column).agg(F.count("*").alias("row_count"))


def duplicate_keys(df: DataFrame, keys: list[str], nulls_equal: bool = True) -> DataFrame:
    """Keys, text in lower case, that occur more than once; else null keys never match."""
    named = [(F.lower(c) if df.schema[c].dataType.simpleString() == "string" else F.col(c)).alias(c) for c in keys]
    rows = df.select(*named)
    if not nulls_equal:
        rows = rows.dropna(subset=keys)
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def reconcile(source: DataFrame, target: DataFrame, by: str) -> DataFrame:
    """Counts of both sides by a column, null being a value, and their difference."""
    sides = [x.select(by, F.lit(s).alias("s"), F.lit(1 - s).alias("t")) for x, s in ((source, 1), (target, 0))]
    both = sides[0].union(sides[1]).groupBy(by).agg(F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"))
    return both.withColumn("difference", F.col("source_rows") - F.col("target_rows"))

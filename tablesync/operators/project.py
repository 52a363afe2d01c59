"""Column rules and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _named(df: DataFrame, names: list[str]) -> set[str]:
    wanted = {n.lower() for n in names}
    return {c for c in df.columns if c.lower() in wanted}


def exclude_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the columns named, in any case; nothing left is an error."""
    gone = _named(df, names)
    if len(gone) == len(df.columns):
        raise ValueError("all columns are excluded")
    return df.drop(*gone)


def nullify(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in _named(df, names)})


def override(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Constants for columns, in the columns' types."""
    by_name = {k.lower(): v for k, v in values.items()}
    return df.withColumns({c: F.lit(by_name[c.lower()]).cast(df.schema[c].dataType) for c in _named(df, list(values))})


def apply_column_rules(df: DataFrame, nullified: list[str] = (), overrides: dict[str, object] | None = None, anonymized: dict[str, Column] | None = None) -> DataFrame:
    """Nullify before override before anonymised (where not null) before the source value."""
    made = {c.lower(): x for c, x in (anonymized or {}).items()}
    first = df.withColumns({c: F.coalesce(made[c.lower()].cast(df.schema[c].dataType), F.col(c)) for c in _named(df, list(made))})
    return nullify(override(first, overrides or {}), list(nullified))


def build_view(spark: SparkSession, table: str, columns: list[str], replacements: dict[str, str] | None = None, prefix: str = "", source: str = "") -> DataFrame:
    """View ``v_<table>``: its columns, some replaced by expressions, from a table or any FROM text."""
    given = {k.lower(): v for k, v in (replacements or {}).items()}
    parts = [f"{given[c.lower()]} AS {c}" if c.lower() in given else f"{prefix}{c}" for c in columns]
    df = spark.sql(f"SELECT {', '.join(parts)} FROM {source.strip() or table}")
    df.createOrReplaceTempView(f"v_{table}")
    return df

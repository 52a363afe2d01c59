"""Masking functions, as columns and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def mask_str(c: Column, masked: str) -> Column:
    return F.when(c.isNotNull(), F.lit(masked))


def mask_unique_str(pk: Column, suffix: str | None) -> Column:
    return F.concat(F.coalesce(pk.cast("string"), F.lit("")), F.lit(suffix or ""))


def mask_password(uid: Column) -> Column:
    return F.when(uid == "admin", F.lit("nimda"))


def mask_password_encoding(uid: Column) -> Column:
    return F.when(uid == "admin", F.lit("plain")).otherwise(F.lit("*"))


def mask_config(key: Column, value: Column, secret_keys: list[str]) -> Column:
    """Secrets of a configuration: listed keys wholly, elsewhere the first ``password=...;``."""
    return F.when(key.isin(secret_keys), F.lit("***")).otherwise(F.regexp_replace(value, r"^(.*?)password=.*?;", "$1password=***;"))


def register_masking(spark: SparkSession) -> None:
    """The same functions for SQL text; the optimizer inlines them."""
    for name, args, body in (
        ("mask_str", "orig STRING, masked STRING", "CASE WHEN orig IS NOT NULL THEN masked END"),
        ("mask_unique_str", "pk BIGINT, suffix STRING", "concat(coalesce(cast(pk AS STRING), ''), coalesce(suffix, ''))"),
        ("mask_password", "uid STRING", "CASE WHEN uid = 'admin' THEN 'nimda' END"),
        ("mask_passwordencoding", "uid STRING", "CASE WHEN uid = 'admin' THEN 'plain' ELSE '*' END"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS STRING RETURN {body}")

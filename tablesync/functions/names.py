"""Table names: prefix, localised suffix, type-system suffix, and back."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tables whose names carry the type-system suffix (fixed values).
SYSTEM_TABLES = ("atomictypes", "attributedescriptors", "collectiontypes", "composedtypes", "enumerationvalues", "maptypes", "props")


def without_prefix(name: Column, prefix: str) -> Column:
    return F.regexp_replace(name, f"(?i)^{re.escape(prefix)}", "") if prefix else name


def _system(name: Column, suffix: str) -> Column:
    return F.lower(name).rlike(f"^({'|'.join(SYSTEM_TABLES)}){re.escape(suffix.lower())}$")


def base_name(full: Column, prefix: str, suffix: str) -> Column:
    """Without prefix, without ``lp``, and for system tables without the type-system suffix."""
    bare = F.regexp_replace(without_prefix(full, prefix), "(?i)lp$", "")
    return F.when(_system(bare, suffix), F.substring(bare, F.lit(1), F.length(bare) - len(suffix))).otherwise(bare)


def additional_suffix(full: Column) -> Column:
    return F.regexp_extract(full, "(?i)(lp)$", 1)


def common_name(full: Column, prefix: str, suffix: str) -> Column:
    return F.lower(F.concat(base_name(full, prefix, suffix), additional_suffix(full)))


def translate_name(base: Column, more: Column, prefix: str, suffix: str) -> Column:
    """The name in another database."""
    system = F.lower(base).isin(list(SYSTEM_TABLES))
    return F.concat(F.lit(prefix), base, F.when(system, F.lit(suffix)).otherwise(F.lit("")), more)


def is_localized(name: str) -> bool:
    return name.lower().endswith("lp")


def view_name(table: Column) -> Column:
    return F.concat(F.lit("v_"), table)


def table_of_view(view: Column) -> Column:
    return F.regexp_replace(view, "^v_", "")

"""Choosing tables: candidates, filters, items, order; and the tables that describe a type system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.functions.names import SYSTEM_TABLES, additional_suffix, base_name, common_name, without_prefix

#: Tables that are not copied unless asked for (fixed values).
DEFAULT_EXCLUDED = ("SYSTEMINIT", "StoredHttpSessions", "itemdeletionmarkers", "tasks_aux_queue", "tasks_aux_scheduler", "tasks_aux_workers")
#: Tables that every copy has (fixed values).
META_TABLES = ("ydeployments", "aclentries", "configitems", "numberseries", "metainformations")


def _any_case(c: Column, names) -> Column:
    return F.lower(c).isin([n.lower() for n in names])


def filter_tables(tables: DataFrame, include: list[str] | DataFrame | None = None, exclude: list[str] = DEFAULT_EXCLUDED, incremental: list[str] | None = None) -> DataFrame:
    """Include (empty: all), exclude and, in incremental runs, the incremental list, which replaces include.

    ``include`` may be a table (table_name), where names are many.
    """
    name = F.col("table_name")
    if isinstance(include, DataFrame):
        wanted = include.select(F.lower("table_name").alias("__l"))
        tables, include = tables.join(wanted, F.lower("table_name") == F.col("__l"), "left_semi") if incremental is None else tables, None
    if incremental is not None:
        if not incremental:
            raise ValueError("an incremental run needs its list of tables")
        wanted = _any_case(name, incremental)
    else:
        wanted = _any_case(name, include) if include else F.lit(True)
    return tables.filter(wanted & ~_any_case(name, exclude))


def candidates(tables: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """(full_name, base_name, suffix, common_name) of the tables with the prefix."""
    own = tables.filter(F.lower("table_name").startswith(prefix.lower())).select("table_name").distinct()
    full = F.col("table_name")
    return own.select(full.alias("full_name"), base_name(full, prefix, suffix).alias("base_name"), additional_suffix(full).alias("additional_suffix"), common_name(full, prefix, suffix).alias("common_name"))


def source_candidates(deployments: DataFrame, existing: DataFrame, audit: bool = False, custom: list[str] = ()) -> DataFrame:
    """Meta tables, type tables, props, localised and audit tables that exist, and custom ones."""
    spark = deployments.sparkSession
    fixed = spark.createDataFrame([(n,) for n in (*META_TABLES, *custom)], "table_name string")
    types = deployments.select(F.col("TableName").alias("table_name")).union(deployments.select("PropsTableName")).filter("table_name IS NOT NULL")
    more = deployments.select(F.concat("TableName", F.lit("lp")).alias("table_name"))
    if audit:
        more = more.union(deployments.select("AuditTableName"))
    there = existing.select(F.lower("table_name").alias("__l"))
    more = more.join(there, F.lower(F.col("table_name")) == F.col("__l"), "left_semi")
    return fixed.union(types).union(more).select(F.lower("table_name").alias("table_name")).distinct()


def filter_candidates(cands: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """Without tables that begin like a system table and, less ``lp``, lack the suffix; those in ``sn`` stay."""
    name = F.lower(without_prefix(F.col("full_name"), prefix))
    system = name.rlike(f"^({'|'.join(SYSTEM_TABLES)})") & ~name.endswith("sn")
    return cands.filter(~system | F.regexp_replace(name, "lp$", "").endswith(suffix.lower()))


def plan_items(source: DataFrame, target: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(common_name, source_table, target_table) of tables on both sides.

    With ``wanted`` (table_name: common names), of those only, and one without a target fails the job.
    """
    t = target.select("common_name", F.col("full_name").alias("target_table"))
    s = source.select("common_name", F.col("full_name").alias("source_table"))
    if wanted is None:
        return s.join(t, "common_name")
    s = s.join(wanted.select(F.lower("table_name").alias("common_name")), "common_name", "left_semi")
    lost = F.raise_error(F.concat(F.lit("no target table for "), "source_table")).cast("string")
    return s.join(t, "common_name", "left").withColumn("target_table", F.coalesce("target_table", lost))


def order_items(items: DataFrame, first: list[str], last: list[str]) -> DataFrame:
    """``items`` with ``item_order``: listed first ones, then by rows, then listed last ones; names break ties."""
    group = F.when(_any_case(F.col("table_name"), first), 0).when(_any_case(F.col("table_name"), last), 2).otherwise(1)
    return items.withColumn("sort_group", group).orderBy("sort_group", "row_count", "table_name")


def smallest_unique_key(index_columns: DataFrame, indexes: DataFrame | None = None) -> DataFrame:
    """(table_name, index_name, column_name, position, key_order) of each table's unique index with the fewest
    columns; ``indexes`` (table_name, index_name, is_unique) tells the unique ones, without it all are."""
    own = index_columns
    if indexes is not None:
        own = own.join(indexes.filter("is_unique").select("table_name", "index_name"), ["table_name", "index_name"], "left_semi")
    n = own.groupBy("table_name", "index_name").agg(F.count("*").alias("n"))
    best = n.groupBy("table_name").agg(F.min_by("index_name", F.struct("n", "index_name")).alias("index_name"))
    order = F.row_number().over(Window.partitionBy("table_name", "index_name").orderBy("position", "column_name"))
    return own.join(best, ["table_name", "index_name"]).withColumn("key_order", order)


def prefix_summary(tables: DataFrame, prefixes: list[str]) -> DataFrame:
    """Tables by the first prefix that fits ('' if none)."""
    p = F.coalesce(*(F.when(F.lower("table_name").startswith(x.lower()), F.lit(x)) for x in prefixes), F.lit(""))
    return tables.select(p.alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n_tables"))


def migration_summary(source: DataFrame, target: DataFrame, staging: str) -> DataFrame:
    """(copied, n_source, n_target): tables on the source that the target has under the staging prefix
    (``staged``), under their own name (``direct``), or not at all (``missing``)."""
    name = F.lower("table_name")
    s = source.select(name.alias("n")).distinct()
    t = target.select(name.alias("m")).distinct()
    own = F.col("m").startswith(staging.lower())
    way = t.select(F.when(own, F.substring("m", len(staging) + 1, 1 << 30)).otherwise(F.col("m")).alias("n"), own.alias("staged"))
    both = s.join(way, "n", "left").groupBy("n").agg(F.count("staged").alias("n_target"), F.bool_or("staged").alias("staged"))
    copied = F.when(F.col("staged"), "staged").when(F.col("staged").isNull(), "missing").otherwise("direct")
    return both.groupBy(copied.alias("copied")).agg(F.count("*").alias("n_source"), F.sum("n_target").alias("n_target"))


def type_tables(deployments: DataFrame, type_system: str) -> DataFrame:
    return deployments.filter((F.col("TypeSystemName") == type_system) & F.col("Typecode").isNotNull() & F.col("TableName").isNotNull())


def is_audit(tables: DataFrame, deployments: DataFrame, prefix: str = "") -> DataFrame:
    """``tables`` with ``is_audit``: whether the name, with or without prefix, is some audit table's."""
    audit = deployments.select(F.lower("AuditTableName").alias("__a")).filter("__a IS NOT NULL").distinct().withColumn("__hit", F.lit(True))
    bare = F.lower(without_prefix(F.col("table_name"), prefix))
    return tables.join(audit, bare == F.col("__a"), "left").withColumn("is_audit", F.coalesce("__hit", F.lit(False))).drop("__a", "__hit")


def override_type_system(deployments: DataFrame, source_name: str, target_name: str) -> DataFrame:
    return deployments if source_name.lower() == target_name.lower() else deployments.withColumn("TypeSystemName", F.lit(target_name))


def rewrite_deployments(deployments: DataFrame, source_suffix: str, target_suffix: str, type_system: str) -> DataFrame:
    """System tables' names with the target's suffix, in one type system."""
    def renamed(c: str) -> Column:
        hit = F.lower(c).isin([t + source_suffix.lower() for t in SYSTEM_TABLES]) & (F.col("TypeSystemName") == type_system)
        return F.when(hit, F.concat(F.substring(F.col(c), F.lit(1), F.length(c) - len(source_suffix)), F.lit(target_suffix))).otherwise(F.col(c))

    return deployments.withColumns({c: renamed(c) for c in ("TableName", "PropsTableName")})


def set_active(systems: DataFrame, name: str, comment: str) -> DataFrame:
    on = F.col("name") == name
    return systems.withColumns({"state": F.when(on, "current").otherwise("retired"), "comment": F.when(on, comment).otherwise(F.col("comment"))})


def current_type_system(systems: DataFrame, deployments: DataFrame) -> DataFrame:
    """(name, suffix) of the current type system; the suffix comes from its composed-types table."""
    own = deployments.filter(F.lower("TableName").startswith("composedtypes")).select("TypeSystemName", F.substring("TableName", 14, 64).alias("suffix")).distinct()
    return systems.filter("state = 'current'").join(own, F.col("name") == F.col("TypeSystemName")).select("name", "suffix")


def check_type_system(deployments: DataFrame, type_system: str, suffix: str) -> DataFrame:
    """(suffix_found, ok) of a type system; no row: it is missing."""
    own = deployments.filter((F.col("TypeSystemName") == type_system) & F.lower("TableName").startswith("composedtypes"))
    return own.select(F.substring("TableName", 14, 64).alias("suffix_found")).distinct().withColumn("ok", F.col("suffix_found") == suffix)


def type_info(types: DataFrame, codes: list[str]) -> DataFrame:
    return types.filter(F.col("InternalCode").isin(codes)).select("InternalCode", "PK")


def staging_prefixes(tables: DataFrame, known: list[str]) -> DataFrame:
    """Prefixes of ``...ydeployments`` tables that are neither the running nor the migration prefix."""
    p = F.regexp_extract(F.lower("table_name"), "^(.*)ydeployments$", 1)
    return tables.filter(F.lower("table_name").endswith("ydeployments")).select(p.alias("prefix")).filter(~F.col("prefix").isin([k.lower() for k in known])).distinct()


def staged_tables(tables: DataFrame, prefixes: DataFrame, limit: int = 5) -> DataFrame:
    """Tables of all staging prefixes, once there are more than ``limit`` of those.

    A name meets the prefixes by its own beginnings, so the join is one of equal values.
    """
    many = prefixes.filter(prefixes.agg(F.count("*")).scalar() > limit).select("prefix")
    name = F.lower("table_name")
    begins = F.explode(F.transform(F.sequence(F.lit(0), F.length(name)), lambda n: F.substring(name, F.lit(1), n)))
    return tables.select("table_name", begins.alias("prefix")).join(many, "prefix", "left_semi").select("table_name").distinct()


def deletion_tables(type_map: DataFrame, items: DataFrame) -> DataFrame:
    """Tables of configured types that the job has."""
    return type_map.select(F.lower("table_name").alias("table_name")).join(items.select(F.lower("table_name").alias("table_name")), "table_name", "left_semi").distinct()

"""Writing into a target: append, overwrite, upsert, delete; files and JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tablesync.sources.files import Folder, Mark, has, marked
from tablesync.sources.profile import Profile, properties, read_table, table_exists


def unique_by(df: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """The latest row of each key by ``order_col``; without it, a repeated key fails the job that runs it.

    Null keys match nothing, so they stay as they are.
    """
    w = Window.partitionBy(*keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # null keys are set aside, so that they do not meet in one task
    lost, df = df.filter(~known), df.filter(known)
    if order_col:
        ranked = df.withColumn("__rn", F.row_number().over(w.orderBy(F.desc(order_col))))
        return ranked.filter(F.col("__rn") == 1).drop("__rn").union(lost)
    counted = df.withColumn("__n", F.count("*").over(w))
    fine = F.when(F.col("__n") > 1, F.raise_error(F.lit("repeated key in the source of an upsert"))).otherwise(F.lit(True))
    return counted.filter(fine.cast("boolean")).drop("__n").union(lost)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order_col: str | None = None, checked: bool = True) -> DataFrame:
    """The target after the merge: copied columns take the source's value, null too; columns that are not
    copied keep the target's; new rows have null there. ``checked``: whether source keys are made unique.

    One full outer join: each side is read and shuffled once.
    """
    if not keys:
        raise ValueError("an upsert needs a key")
    source = unique_by(source, keys, order_col) if checked else source
    copied = {c.lower(): f"__s{i}" for i, c in enumerate(source.columns)}
    own = {c.lower(): f"__t{i}" for i, c in enumerate(target.columns)}
    s = source.toDF(*copied.values()).withColumn("__comes", F.lit(True))
    t = target.toDF(*own.values())
    same = reduce(and_, (F.col(own[k.lower()]) == F.col(copied[k.lower()]) for k in keys))
    value = lambda c: F.when(F.col("__comes"), F.col(copied[c])).otherwise(F.col(own[c])) if c in copied else F.col(own[c])
    return t.join(s, same, "full").select(*(value(c.lower()).alias(c) for c in target.columns))


def delete_by_key(target: DataFrame, markers: DataFrame, key: str, marker_key: str = "p_itempk") -> DataFrame:
    return target.join(markers.select(F.col(marker_key).alias(key)), key, "left_anti")


def append(df: DataFrame, profile: Profile, name: str, mark: Mark | None = None, kind: StructType | None = None) -> None:
    """Adds rows to a table, which is made if it is missing. In folders, rows with a ``mark`` (a run's name, its batches'
    numbers) are added once, however often they come, and ``kind`` becomes the table's schema, old rows included."""
    if profile.is_jdbc:
        df.write.format("jdbc").options(**profile.jdbc_options(), dbtable=profile.prefix + name).mode("append").save()
        return
    folder = Folder(df.sparkSession, profile.path(name))
    state = folder.state()
    if has(state, mark):
        return
    if not state.version and mark is None and kind is None:
        folder.write(df)
        return
    kind = kind or (folder.read(state).schema if state.files else df.schema)
    new = folder.write(df)
    folder.commit(state, [*state.files, *new], kind, marked(state, mark))
    folder.drop([])


def reads_table(df: DataFrame, profile: Profile, name: str) -> bool:
    """Whether a plan reads the JDBC table ``name``."""
    table = f"{profile.prefix}{name}".lower()
    plan = df._jdf.queryExecution().analyzed().toString().lower()
    return f"jdbcrelation({table})" in plan or f'jdbcrelation("{table}")' in plan


def overwrite(df: DataFrame, profile: Profile, name: str, mark: Mark | None = None) -> None:
    """A table's rows become those of ``df``. A folder's table may be read by ``df``, which a database's may not:
    that is emptied before ``df`` runs.

    In a folder, new files come first, then the manifest that names them, then the old ones go. With a ``mark``, once.
    """
    if profile.is_jdbc:
        if reads_table(df, profile, name):
            raise ValueError(f"{name} would be emptied before it is read; use apply_jdbc or another table")
        df.write.format("jdbc").options(**profile.jdbc_options(), dbtable=profile.prefix + name, truncate="true").mode("overwrite").save()
        return
    folder = Folder(df.sparkSession, profile.path(name))
    state = folder.state()
    if has(state, mark):
        return
    old = [*state.files, *folder.listed()]
    new = folder.write(df)
    folder.commit(state, new, df.schema, marked(state, mark, alone=True))
    folder.drop(old)


def touched_files(target: DataFrame, keys: DataFrame) -> list[str]:
    """Names of the files of a table with a row whose key is in ``keys``. Only the key columns are read, and of
    these only row groups between the least and the greatest first key. A name a file comes to the driver."""
    first = keys.schema[0]
    own = target.select(*keys.columns, F.col("_metadata.file_name").alias("__file"))
    if not isinstance(first.dataType, (FloatType, DoubleType)):
        low, high = keys.agg(F.min(first.name), F.max(first.name)).first()
        if low is None:
            return []
        own = own.filter(F.col(first.name).between(*(F.lit(x).cast(first.dataType) for x in (low, high))))
    return [r[0] for r in own.join(keys, keys.columns, "left_semi").select("__file").distinct().collect()]


def merge_files(profile: Profile, name: str, changed: DataFrame, keys: list[str], gone: DataFrame | None = None, mark: Mark | None = None) -> list[str]:
    """Deletes rows with a key of ``gone`` (its columns), then upserts ``changed``, in one pass over the files that hold
    any of these keys; the others stay. Returns the names of the files that were replaced.

    The table is the old one until all is written. With a ``mark``, a change is applied once.
    """
    folder = Folder(changed.sparkSession, profile.path(name))
    state = folder.state()
    if has(state, mark):
        return []
    target = folder.read(state)
    touched = set(touched_files(target, renamed(changed.select(*keys), target).dropna().distinct()))
    if gone is not None:
        gone = renamed(gone, target).dropna().distinct()
        touched |= set(touched_files(target, gone))
    part = folder.read(state, sorted(touched))
    part = part if gone is None else part.join(gone, gone.columns, "left_anti")
    new = folder.write(upsert(part.select(*target.columns), changed, keys))
    folder.commit(state, [*(f for f in state.files if f not in touched), *new], target.schema, marked(state, mark))
    folder.drop(sorted(touched))
    return sorted(touched)


def renamed(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``df`` that ``like`` has, by its names and types, whatever their case."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*(F.col(own[c.lower()]).cast(like.schema[c].dataType).alias(c) for c in like.columns if c.lower() in own))


def drop_table(spark: SparkSession, profile: Profile, name: str) -> None:
    if not profile.is_jdbc:
        Folder(spark, profile.path(name)).delete()
        return
    with transaction(spark, profile) as link:
        run(link, f"DROP TABLE {profile.prefix}{name}")


def alter_jdbc(spark: SparkSession, profile: Profile, name: str, changes: list[tuple[str, str, str]]) -> None:
    """Adds and removes columns (column, Spark type, added or removed) of a JDBC table, in its dialect's words."""
    if not changes:
        return
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(profile.url)
    with transaction(spark, profile) as link:
        for column, kind, change in changes:
            if change == "added":
                as_type = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getJdbcType(jvm.org.apache.spark.sql.types.DataType.fromDDL(kind), dialect).databaseTypeDefinition()
                run(link, dialect.getAddColumnQuery(f"{profile.prefix}{name}", column, as_type))
            else:
                run(link, dialect.getDeleteColumnQuery(f"{profile.prefix}{name}", column))


def tables_to_clear(target_tables: DataFrame, included: DataFrame) -> DataFrame:
    """Target tables that are not migrated, in lower case."""
    names = lambda df: df.select(F.lower("table_name").alias("table_name")).distinct()
    return names(target_tables).join(names(included), "table_name", "left_anti")


def merge_statement(dialect: str, target: str, staging: str, keys: list[str], columns: list[str]) -> str:
    """One set-based statement: MERGE, ON CONFLICT (postgresql) or ON DUPLICATE KEY (mysql)."""
    quoted = Profile(f"jdbc:{dialect}:").quoted
    keys, columns = [quoted(c) for c in keys], [quoted(c) for c in columns]
    rest = [c for c in columns if c not in keys]
    names = ", ".join(columns)
    if dialect == "postgresql":
        sets = "UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "NOTHING"
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({', '.join(keys)}) DO {sets}"
    if dialect == "mysql":
        sets = ", ".join(f"{c} = VALUES({c})" for c in rest or keys)
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {sets}"
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    matched = f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)} " if rest else ""
    end = ";" if dialect == "sqlserver" else ""
    return f"MERGE INTO {target} t USING {staging} s ON {on} {matched}WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{c}' for c in columns)}){end}"


@contextmanager
def transaction(spark: SparkSession, profile: Profile) -> Iterator:
    """A connection whose statements take effect together, or not at all if one fails."""
    link = spark._jvm.java.sql.DriverManager.getConnection(profile.url, properties(spark, profile))
    try:
        link.setAutoCommit(False)
        try:
            yield link
            link.commit()
        except BaseException:
            link.rollback()
            raise
    finally:
        link.close()


def run(link, statement: str) -> int:
    """Runs one statement and returns the number of rows that it changed."""
    s = link.createStatement()
    try:
        return s.executeUpdate(statement)
    finally:
        s.close()


def rows_of(link, query: str) -> list[int]:
    """The first column, of whole numbers, of a small result."""
    s = link.createStatement()
    try:
        found, out = s.executeQuery(query), []
        while found.next():
            out.append(found.getLong(1))
        return out
    finally:
        s.close()


def staging_statement(profile: Profile, staging: str, target: str, columns: list[str]) -> str:
    """An empty table with the types of the target's columns."""
    names = ", ".join(profile.quoted(c) for c in columns)
    if profile.dialect == "sqlserver":
        return f"SELECT {names} INTO {staging} FROM {target} WHERE 1 = 0"
    if profile.dialect == "derby":
        return f"CREATE TABLE {staging} AS SELECT {names} FROM {target} WITH NO DATA"
    return f"CREATE TABLE {staging} AS (SELECT {names} FROM {target} WHERE 1 = 0)"


def delete_statement(profile: Profile, target: str, staging: str, keys: list[str]) -> str:
    same = " AND ".join(f"{staging}.{c} = {target}.{c}" for c in map(profile.quoted, keys))
    return f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})"


def insert_statement(profile: Profile, target: str, staging: str, columns: list[str]) -> str:
    names = ", ".join(profile.quoted(c) for c in columns)
    return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"


@contextmanager
def staged(df: DataFrame | None, profile: Profile, target: str) -> Iterator[str]:
    """A table of this run only, filled by the executors with ``df`` (columns named as the target's); dropped after use."""
    if df is None:
        yield ""
        return
    spark, name = df.sparkSession, f"s{uuid.uuid4().hex[:20]}"
    with transaction(spark, profile) as link:
        run(link, staging_statement(profile, name, target, df.columns))
    try:
        df.write.format("jdbc").options(**profile.jdbc_options(), dbtable=name).mode("append").save()
        yield name
    finally:
        with transaction(spark, profile) as link:
            run(link, f"DROP TABLE {name}")


#: The table, in a target database, of batches that have been applied.
APPLIED = "tablesync_applied"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def applied(spark: SparkSession, profile: Profile, name: str, mark: str) -> set[int]:
    """Numbers of a run's or stream's batches that a table has."""
    if not profile.is_jdbc:
        return set(Folder(spark, profile.path(name)).state().done.get(mark, []))
    if not table_exists(spark, replace(profile, prefix=""), APPLIED):
        return set()
    with transaction(spark, profile) as link:
        return set(rows_of(link, f"SELECT batch FROM {APPLIED} WHERE name = {_text(mark)} AND tab = {_text(profile.prefix + name)}"))


def apply_jdbc(profile: Profile, name: str, changed: DataFrame, keys: list[str], gone: DataFrame | None = None, mark: Mark | None = None, clear: bool = False) -> None:
    """Deletes rows with a key of ``gone`` (its columns), then upserts ``changed`` by ``keys`` (adds it, without keys), in
    one transaction; ``clear``: all rows go first, in the same one.

    Executors fill staging tables with names of their own; only the statements that move their rows are one
    transaction. Columns that the target lacks are left out, keys of ``changed`` must not repeat. With a ``mark``, a change is
    applied once: the mark is written by the same transaction.
    """
    spark, target = changed.sparkSession, f"{profile.prefix}{name}"
    if mark and set(mark[1]) <= applied(spark, profile, name, mark[0]):
        return
    if mark and not table_exists(spark, replace(profile, prefix=""), APPLIED):
        with transaction(spark, profile) as link:
            run(link, f"CREATE TABLE {APPLIED} (name VARCHAR(200) NOT NULL, tab VARCHAR(200) NOT NULL, batch BIGINT NOT NULL, PRIMARY KEY (name, tab, batch))")
    if not table_exists(spark, profile, name):
        spark.createDataFrame([], changed.schema).write.format("jdbc").options(**profile.jdbc_options(), dbtable=target).save()
    like = read_table(spark, profile, name)
    own = {c.lower(): c for c in like.columns}
    keys = [own[k.lower()] for k in keys]
    changed = renamed(changed, like)
    changed = unique_by(changed, keys) if keys else changed
    gone = None if gone is None else renamed(gone, like).distinct()
    with staged(changed, profile, target) as new, staged(gone, profile, target) as old, transaction(spark, profile) as link:
        if clear:
            run(link, f"DELETE FROM {target}")
        if gone is not None:
            run(link, delete_statement(profile, target, old, gone.columns))
        run(link, merge_statement(profile.dialect, target, new, keys, changed.columns) if keys else insert_statement(profile, target, new, changed.columns))
        for batch in mark[1] if mark else []:
            run(link, f"INSERT INTO {APPLIED} VALUES ({_text(mark[0])}, {_text(target)}, {int(batch)})")


def upsert_jdbc(df: DataFrame, profile: Profile, target: str, keys: list[str]) -> None:
    """Executors write a staging table; one statement merges it."""
    apply_jdbc(profile, target, df, keys)


def delete_jdbc(markers: DataFrame, profile: Profile, target: str, key: str, marker_key: str = "p_itempk") -> None:
    gone = markers.select(F.col(marker_key).alias(key))
    apply_jdbc(profile, target, read_table(markers.sparkSession, profile, target).limit(0), [], gone)

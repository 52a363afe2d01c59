"""Profiles and readers: whole tables, pages of key ranges, physical partitions and stored reports."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.sources.files import Folder

#: Tables of the tool itself are never listed (fixed value).
HIDDEN_PREFIX = "migrationtoolkit_"


@dataclass(frozen=True)
class Profile:
    """A folder of Parquet tables, or a JDBC database; ``prefix`` and ``suffix`` name its tables."""

    url: str
    driver: str | None = None
    prefix: str = ""
    type_system: str = "DEFAULT"
    suffix: str = ""
    fetch_size: int = 1000
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_jdbc(self) -> bool:
        return self.url.startswith("jdbc:")

    def path(self, name: str) -> str:
        return f"{self.url.rstrip('/')}/{self.prefix}{name}.parquet"

    def jdbc_options(self) -> dict[str, str]:
        own = {"url": self.url, "fetchsize": str(self.fetch_size), **self.options}
        return own | ({"driver": self.driver} if self.driver else {})


    @property
    def dialect(self) -> str:
        return self.url.split(":")[1]

    def quoted(self, name: str) -> str:
        """A column's name as Spark's writer makes it in a database."""
        return {"mysql": f"`{name}`", "sqlserver": f"[{name}]"}.get(self.dialect, f'"{name}"')


def default_conditions(df: DataFrame, name: str, type_system: str) -> DataFrame:
    """Rows of one type system, for any table whose name ends in ``ydeployments``."""
    return df.filter(F.col("TypeSystemName") == type_system) if name.lower().endswith("ydeployments") else df


def table_exists(spark: SparkSession, profile: Profile, name: str) -> bool:
    """Whether a profile has a table, whatever the case of its name in a database."""
    if not profile.is_jdbc:
        return Folder(spark, profile.path(name)).exists()
    link = spark._jvm.java.sql.DriverManager.getConnection(profile.url, properties(spark, profile))
    try:
        found = link.getMetaData().getTables(None, None, "%", None)
        while found.next():
            if found.getString("TABLE_NAME").lower() == f"{profile.prefix}{name}".lower():
                return True
        return False
    finally:
        link.close()


def properties(spark: SparkSession, profile: Profile):
    out = spark._jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in profile.options:
            out.setProperty(k, profile.options[k])
    return out


def read_table(spark: SparkSession, profile: Profile, name: str, views: bool = False) -> DataFrame:
    """The whole table; with ``views``, which is for sources only, a temp view ``v_<name>`` takes its place if there is
    one. Spark splits the files."""
    if views and spark.catalog.tableExists(f"v_{name}"):
        return spark.table(f"v_{name}")
    if profile.is_jdbc:
        df = spark.read.format("jdbc").options(**profile.jdbc_options(), dbtable=f"{profile.prefix}{name}").load()
    else:
        df = Folder(spark, profile.path(name)).read()
    return default_conditions(df, name, profile.type_system)


def drop_views(spark: SparkSession, tables: list[str]) -> None:
    """Views of a run's tables go when it has ended."""
    for name in tables:
        spark.catalog.dropTempView(f"v_{name}")


def key_range_predicates(key: str, markers: list, key_type: str = "bigint") -> list[str]:
    """One predicate a batch: key >= m_i and key < m_(i+1); the last has no upper bound, the first takes nulls."""
    cast = lambda x: f"CAST('{x}' AS {key_type})"
    ranges = [f"{key} >= {cast(a)} AND {key} < {cast(b)}" for a, b in zip(markers, markers[1:])]
    return [*ranges, f"{key} >= {cast(markers[-1])}"] if markers else []


def read_by_key_ranges(spark: SparkSession, profile: Profile, name: str, key: str, markers: list, key_type: str = "bigint") -> DataFrame:
    """A JDBC table with a Spark partition for each key range. No markers is an error."""
    if not markers:
        raise ValueError(f"no markers for {name}")
    props = {k: v for k, v in profile.jdbc_options().items() if k != "url"}
    return spark.read.jdbc(profile.url, f"{profile.prefix}{name}", predicates=key_range_predicates(key, markers, key_type), properties=props)


def _literal(value: str, kind: T.DataType) -> str:
    text = value.replace("'", "''")
    if isinstance(kind, T.NumericType):
        return value
    if isinstance(kind, T.StringType):
        return f"'{text}'"
    return f"CAST('{text}' AS {'DATE' if isinstance(kind, T.DateType) else 'TIMESTAMP'})"


def read_by_key_bounds(spark: SparkSession, profile: Profile, name: str, key: str, bounds: list[tuple[str, str | None]], first: bool = False) -> DataFrame:
    """A JDBC table's rows between stored bounds (text), a Spark partition for each pair; the ``first`` takes null keys."""
    whole = read_table(spark, profile, name)
    own = next(f for f in whole.schema if f.name.lower() == key.lower())
    at, tests = profile.quoted(own.name), []
    for i, (low, high) in enumerate(bounds):
        test = " AND ".join([f"{at} >= {_literal(low, own.dataType)}", *([f"{at} < {_literal(high, own.dataType)}"] if high is not None else [])])
        tests.append(f"({test}) OR {at} IS NULL" if first and i == 0 else test)
    props = {k: v for k, v in profile.jdbc_options().items() if k != "url"}
    return default_conditions(spark.read.jdbc(profile.url, f"{profile.prefix}{name}", predicates=tests, properties=props), name, profile.type_system)


def markers_query(profile: Profile, name: str, key: str, rows: int, where: str = "") -> str:
    """SQL for a database: the first key of each ``rows`` rows in the order of ``key``, of those that ``where`` keeps."""
    at, table = profile.quoted(key), f"{profile.prefix}{name}"
    own = f"SELECT {at} FROM {table} WHERE {at} IS NOT NULL" + (f" AND ({where})" if where else "")
    if profile.dialect == "derby":
        ranked = f"SELECT {at}, ROW_NUMBER() OVER () AS rn FROM ({own} ORDER BY {at}) y"
    else:
        ranked = f"SELECT {at}, ROW_NUMBER() OVER (ORDER BY {at}) AS rn FROM ({own}) y"
    nth = f"(rn - 1) % {rows} = 0" if profile.dialect == "sqlserver" else f"MOD(rn - 1, {rows}) = 0"
    return f"SELECT DISTINCT {at} FROM ({ranked}) x WHERE {nth}"


def markers_jdbc(spark: SparkSession, profile: Profile, name: str, key: str, rows: int, where: str = "") -> DataFrame:
    """The markers of a JDBC table, ranked by the database: only they leave it."""
    own = next(c for c in read_table(spark, profile, name).columns if c.lower() == key.lower())
    return spark.read.format("jdbc").options(**profile.jdbc_options(), query=markers_query(profile, name, own, rows, where)).load().orderBy(own)


def read_in_ranges(spark: SparkSession, profile: Profile, name: str, key: str, rows: int) -> DataFrame:
    """A whole JDBC table, read once in key ranges of about ``rows`` rows that the database has found."""
    # a key a range
    lows = [str(r[0]) for r in markers_jdbc(spark, profile, name, key, rows).collect()]
    return read_by_key_bounds(spark, profile, name, key, list(zip(lows, [*lows[1:], None])), first=True) if lows else read_table(spark, profile, name)


def source_files(spark: SparkSession, profile: Profile, name: str) -> list[tuple[str, int]]:
    """(name, bytes) of the data files of a table in a folder of its own, in the order of names."""
    folder = Folder(spark, profile.path(name))
    return folder.sizes() if folder.is_folder() else []


def list_partitions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The values (text) that a folder's layout has for a partition column; null for the default one. No file is read."""
    names = Folder(spark, path).folders()
    values = [(None if (v := unquote(n.split("=", 1)[1])) == "__HIVE_DEFAULT_PARTITION__" else v,) for n in names if n.split("=", 1)[0].lower() == column.lower() and "=" in n]
    return spark.createDataFrame(values, f"{column} string")


def read_partitions(df: DataFrame, column: str, chosen: DataFrame) -> DataFrame:
    """Rows of the physical partitions whose values ``chosen`` has; found at run time, the others' files are not read."""
    return df.join(chosen.select(F.col(column).cast(df.schema[column].dataType).alias(column)).filter(F.col(column).isNotNull()).distinct(), column, "left_semi").select(*df.columns)


def footer_reader(spark: SparkSession) -> SparkSession:
    """A session on the same cluster in which counts and extremes of Parquet tables come from file footers alone."""
    own = spark.newSession()
    for k, v in {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}.items():
        own.conf.set(k, v)
    return own


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Stored reports with file name and modification time."""
    meta = F.col("_metadata")
    return spark.read.option("multiLine", True).json(path).select("*", meta["file_name"].alias("file_name"), meta["file_modification_time"].alias("modified"))


def read_catalogue(spark: SparkSession, profile: Profile) -> DataFrame:
    """(table_name, column_name) of all tables with the profile's prefix; only names come to the driver."""
    found: list[tuple[str, str]] = []
    if profile.is_jdbc:
        link = spark._jvm.java.sql.DriverManager.getConnection(profile.url, properties(spark, profile))
        try:
            rows = link.getMetaData().getColumns(None, None, None, None)
            while rows.next():
                found.append((rows.getString("TABLE_NAME"), rows.getString("COLUMN_NAME")))
        finally:
            link.close()
    else:
        at = spark._jvm.org.apache.hadoop.fs.Path(profile.url)
        for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            name = f.getPath().getName()
            if name.endswith(".parquet"):
                found += [(name.removesuffix(".parquet"), c) for c in spark.read.parquet(f.getPath().toString()).columns]
    own = [(t, c) for t, c in found if t.lower().startswith(profile.prefix.lower())]
    return spark.createDataFrame(own, "table_name string, column_name string")


def list_tables(catalogue: DataFrame) -> DataFrame:
    """Distinct lower-case names of ``table_name``, without those of the tool."""
    return catalogue.select(F.lower("table_name").alias("table_name")).filter(~F.col("table_name").startswith(HIDDEN_PREFIX)).distinct()


def list_views(spark: SparkSession, profile: Profile) -> DataFrame:
    """(view_name) of a database's views with the profile's prefix; for folders, of the session's temp views."""
    if profile.is_jdbc:
        link = spark._jvm.java.sql.DriverManager.getConnection(profile.url, properties(spark, profile))
        try:
            kinds = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 1)
            kinds[0] = "VIEW"
            found, names = link.getMetaData().getTables(None, None, "%", kinds), []
            while found.next():
                names.append(found.getString("TABLE_NAME"))
        finally:
            link.close()
    else:
        names = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    own = [(n,) for n in names if n.lower().startswith(profile.prefix.lower()) and not n.lower().startswith(HIDDEN_PREFIX)]
    return spark.createDataFrame(own, "view_name string")


def list_columns(catalogue: DataFrame) -> DataFrame:
    """Distinct (table_name, column_name), both in lower case."""
    return catalogue.select(F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")).distinct()


def typed_bound(value: str, key_type: str) -> Column:
    """A stored boundary (text) as a value of the key's type."""
    return F.lit(value).cast(key_type)


def read_between(df: DataFrame, key: str, bounds: list[tuple[str, str | None]], first: bool = False) -> DataFrame:
    """Rows between stored bounds (text) of a key; the ``first`` bounds take null keys."""
    own = next(f for f in df.schema if f.name.lower() == key.lower())
    test = F.col(own.name).isNull() if first else F.lit(False)
    for low, high in bounds:
        inside = F.col(own.name) >= typed_bound(low, own.dataType)
        test = test | (inside if high is None else inside & (F.col(own.name) < typed_bound(high, own.dataType)))
    return df.filter(test)

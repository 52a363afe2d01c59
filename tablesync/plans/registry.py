"""Registered queries and their SQL.

Inputs that the driver's tables do not have (targets, markers, catalogues, ledgers) are derived from them by
the SQL in ``DERIVED``, the same text for Spark and for the oracle; all operators are written separately on
both sides.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import anonymize as an
from tablesync.functions import coerce, masking, names
from tablesync.operators import batches, delta, merge, project
from tablesync.plans import catalog, jobs, ledger, schema
from tablesync.sources.profile import Profile, footer_reader, list_partitions, read_partitions, read_table
from tablesync.sources.shared import new_folder
from tablesync.streaming.capture import capture_deletions, run_available

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
SINCE = "1998-01-01 00:00:00"

DERIVED = {
    "tgt": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS o_totalprice, "
        "o_orderpriority FROM orders WHERE o_orderkey % 10 <> 3"
    ),
    "mk": "SELECT event_id AS p_itempk, 'orders' AS p_table, ts AS modifiedts FROM events WHERE event_type = 'error'",
    "lp": "SELECT p_partkey AS itempk, lang AS langpk, p_name AS p_title, p_retailprice AS p_price FROM part, (SELECT DISTINCT lang FROM documents) l",
    "lptgt": "SELECT p_partkey AS itempk, lang AS langpk, 'old' AS p_title, p_size AS p_size FROM part, (SELECT DISTINCT lang FROM documents) l WHERE p_partkey % 3 <> 0",
    "tasks": (
        "SELECT user_id, user_id % 100 AS migrationid, concat('pipe', user_id) AS pipelinename, max(ts) AS lastupdate, max(CASE WHEN event_type = 'error' AND "
        "value > 80 THEN 1 ELSE 0 END) AS failure, count(*) AS sourcerowcount, CASE WHEN user_id % 9 = 0 THEN NULL ELSE count(*) END AS duration FROM events "
        "GROUP BY user_id"
    ),
    "runs": "SELECT user_id % 100 AS migrationid, min(ts) AS startat FROM events GROUP BY user_id % 100",
    "bat": "SELECT event_type, user_id, event_id % 1000 + 1 AS rows, event_id % 7 + 1 AS seconds FROM events",
    "cat": (
        "SELECT CASE WHEN p_partkey % 50 = 1 THEN 'src_composedtypes1' WHEN p_partkey % 50 = 2 THEN 'SRC_Props1' WHEN p_partkey % 50 = 3 THEN 'src_props7' "
        "WHEN p_partkey % 50 = 4 THEN 'src_mapTypessn' WHEN p_partkey % 50 = 6 THEN 'src_propsExtra' WHEN p_partkey % 4 = 0 THEN concat('src_tab', p_partkey, "
        "'lp') ELSE concat('src_Tab', p_partkey) END AS table_name, p_size AS row_count FROM part"
    ),
    "tcat": (
        "SELECT CASE WHEN p_partkey % 50 = 1 THEN 'tgt_composedtypes2' WHEN p_partkey % 50 = 2 THEN 'tgt_props2' WHEN p_partkey % 4 = 0 THEN concat('tgt_TAB', "
        "p_partkey, 'LP') ELSE concat('tgt_tab', p_partkey) END AS table_name FROM part WHERE p_partkey % 3 <> 0"
    ),
    "cols": "SELECT concat('Tab', p_partkey % 97) AS table_name, concat('c', p_size) AS column_name FROM part",
    "tcols": "SELECT concat('tab', p_partkey % 97) AS table_name, concat('C', p_size) AS column_name FROM part WHERE p_partkey % 97 <> 5 AND p_partkey % 3 <> 0",
    "idx": (
        "SELECT DISTINCT concat('tab', l_orderkey % 5000) AS table_name, concat('ix', l_linenumber) AS index_name, concat('c', l_partkey % 9) AS column_name, "
        "l_partkey % 9 AS position FROM lineitem"
    ),
    "dep": (
        "SELECT p_partkey AS Typecode, CASE WHEN p_partkey % 40 = 1 THEN 'composedtypes1' WHEN p_partkey % 40 = 2 THEN 'props1' ELSE concat('tab', p_partkey) "
        "END AS TableName, p_brand AS Name, CASE WHEN p_partkey % 2 = 0 THEN 'SYS2' ELSE 'SYS1' END AS TypeSystemName, CASE WHEN p_partkey % 5 = 0 THEN "
        "concat('aud', p_partkey) END AS AuditTableName, CASE WHEN p_partkey % 3 = 0 THEN 'Props1' ELSE concat('pr', p_partkey) END AS PropsTableName FROM part"
    ),
    "systems": "SELECT concat('SYS', s_suppkey) AS name, CASE WHEN s_suppkey = 1 THEN 'current' ELSE 'retired' END AS state, s_name AS comment FROM supplier",
    "conf": (
        "SELECT CASE WHEN c_custkey % 5 = 0 THEN 'db.secret' ELSE c_name END AS k, CASE WHEN c_custkey % 2 = 0 THEN concat('url=x;password=', c_custkey, "
        "';user=a;password=b;') ELSE c_mktsegment END AS v FROM customer"
    ),
    "dirty": (
        "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN CAST(c_custkey AS VARCHAR(20)) WHEN c_custkey % 4 = 2 THEN NULL "
        "ELSE c_mktsegment END AS x FROM customer"
    ),
    "staged": (
        "SELECT concat(CASE WHEN p_partkey % 3 = 0 THEN 'run_' WHEN p_partkey % 3 = 1 THEN concat('stg', p_partkey % 7, '_') ELSE 'mig_' END, CASE WHEN "
        "p_partkey % 4 = 1 THEN 'YDeployments' ELSE concat('tab', p_partkey) END) AS table_name FROM part"
    ),
    "chg": "SELECT event_id AS item_pk, user_id % 20 AS typecode, CASE WHEN event_type = 'error' THEN 'REMOVE' ELSE 'SAVE' END AS change, ts FROM events",
    "tmap": "SELECT n_nationkey AS typecode, lower(n_name) AS table_name FROM nation WHERE n_nationkey % 2 = 0",
    "plan": "SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS batchid, min(o_orderkey) AS lowerboundary FROM orders GROUP BY CAST(floor(o_orderkey / 100) AS BIGINT)",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a folder and what is derived from them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DERIVED:
            sql = DERIVED[name]
            used = [t for t in TABLES if re.search(rf"\b{t}\b", sql.replace("'orders'", ""))]
            for t in used:
                sql = re.sub(rf"\b{t}\b(?!')", f"{{{t}}}", sql)
            return self.spark.sql(sql, **{t: getattr(self, t) for t in used})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str, name: str | None = None):
    """Registers a function of ``Tables`` with its SQL, which may name derived inputs."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        need = [d for d in DERIVED if re.search(rf"\b{d}\b", sql)]
        head = ", ".join(f"{d} AS ({DERIVED[d]})" for d in need)
        body = sql.strip()
        ORACLES[key] = (f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}") if need else body
        return f

    return add


def ntz(text: str):
    return F.expr(f"timestamp_ntz'{text}'")


# scans, deltas and counts


@query("SELECT * FROM nation")
def scan_table(t):
    return t.nation


@query(f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}'")
def delta_scan(t):
    return delta.delta(t.orders, ntz(SINCE), "o_orderdate")


@query(f"SELECT * FROM mk WHERE modifiedts > (SELECT min(ts) FROM events) + INTERVAL 1 DAY")
def deletion_markers(t):
    return delta.deletion_markers(t.mk, "orders", t.events.agg(F.min("ts")).scalar() + F.expr("INTERVAL 1 DAY"))


@query("SELECT * FROM lp WHERE itempk IN (SELECT p_partkey FROM part WHERE p_partkey % 7 = 0)")
def localized_delta(t):
    return delta.localized_delta(t.lp, t.part.filter("p_partkey % 7 = 0"), "itempk", "p_partkey")


@query(
    "SELECT CAST(floor(rn / 1000) AS BIGINT) AS batch_id, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, "
    "row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders) GROUP BY 1"
)
def key_range_batches(t):
    own = batches.key_range_batches(t.orders.select("o_orderkey"), "o_orderkey", 1000)
    return own.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query(
    "SELECT CAST(floor((rn - 1) / 500) AS BIGINT) AS batch_id, count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM (SELECT l_orderkey, "
    "count(*) OVER (ORDER BY l_orderkey) AS rn FROM lineitem) GROUP BY 1"
)
def key_range_batches_ties(t):
    own = batches.key_range_batches(t.lineitem.select("l_orderkey"), "l_orderkey", 500)
    return own.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))


@query(
    "SELECT CAST(rn / 1000 AS BIGINT) AS batch_id, o_orderkey AS lower_boundary, lead(o_orderkey) OVER (ORDER BY rn) AS upper_boundary "
    "FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders) WHERE rn % 1000 = 0"
)
def batch_boundaries(t):
    return batches.batch_plan(batches.batch_markers(t.orders, "o_orderkey", 1000), "o_orderkey", 1000)


@query(
    "SELECT CAST(floor(rn / 200) AS BIGINT) AS batch_id, count(*) AS n, min(c_custkey) AS lo FROM (SELECT c_custkey, row_number() OVER (ORDER BY "
    "c_custkey) - 1 AS rn FROM customer) GROUP BY 1"
)
def offset_batches(t):
    return batches.assign_batches(t.customer.select("c_custkey"), ["c_custkey"], 200).groupBy("batch_id").agg(F.count("*").alias("n"), F.min("c_custkey").alias("lo"))


@query("SELECT * FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 20")
def offset_page(t):
    return batches.read_page(t.customer, ["c_custkey"], 20, 50)


@query("SELECT CAST(rn AS BIGINT) AS rn, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders) WHERE rn % 1000 = 0")
def batch_markers(t):
    return batches.batch_markers(t.orders, "o_orderkey", 1000)


@query(
    f"SELECT CAST(rn AS BIGINT) AS rn, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders WHERE o_orderdate "
    f"> TIMESTAMP '{SINCE}') WHERE rn % 1000 = 0"
)
def batch_markers_delta(t):
    return batches.batch_markers(delta.delta(t.orders, ntz(SINCE), "o_orderdate"), "o_orderkey", 1000)


@query(
    "SELECT CAST(rn AS BIGINT) AS rn, p_itempk FROM (SELECT p_itempk, row_number() OVER (ORDER BY p_itempk) - 1 AS rn "
    "FROM mk WHERE p_table = 'orders') WHERE rn % 500 = 0"
)
def batch_markers_deletions(t):
    return batches.batch_markers(delta.deletion_markers(t.mk, "orders"), "p_itempk", 500)


@query(
    "SELECT CAST(rn AS BIGINT) AS rn, itempk FROM (SELECT itempk, row_number() OVER (ORDER BY itempk) - 1 AS rn FROM lp "
    "WHERE itempk IN (SELECT p_partkey FROM part WHERE p_partkey % 7 = 0)) WHERE rn % 100 = 0"
)
def batch_markers_localized(t):
    return batches.batch_markers(delta.localized_delta(t.lp, t.part.filter("p_partkey % 7 = 0"), "itempk", "p_partkey"), "itempk", 100)


@query(
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', "
    "count(*) FROM customer UNION ALL SELECT 'events', count(*) FROM events"
)
def row_counts(t):
    """No data column is read: counts come from file footers."""
    own = Tables(footer_reader(t.spark), t.sf_dir)
    return delta.row_counts({n: getattr(own, n) for n in ("orders", "lineitem", "customer", "events")})


@query(
    f"SELECT 'orders' AS table_name, count(*) AS row_count FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}' UNION ALL SELECT 'lineitem', count(*) FROM "
    f"lineitem WHERE l_shipdate > TIMESTAMP '{SINCE}'"
)
def delta_counts(t):
    return delta.row_counts({"orders": delta.delta(t.orders, ntz(SINCE), "o_orderdate"), "lineitem": delta.delta(t.lineitem, ntz(SINCE), "l_shipdate")})


@query("SELECT p_table, count(*) AS row_count FROM mk GROUP BY p_table")
def deletion_counts(t):
    return delta.counts_by(t.mk, "p_table")


@query("SELECT 'part' AS table_name, count(*) AS row_count FROM part WHERE p_partkey % 7 = 0")
def localized_counts(t):
    return delta.row_counts({"part": t.part.filter("p_partkey % 7 = 0")})


@query("SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY o_orderstatus")
def partition_counts(t):
    return delta.counts_by(t.orders, "o_orderstatus")


@query(
    "WITH s AS (SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1), g AS (SELECT nullif(o_orderstatus, 'P') AS "
    "o_orderstatus, count(*) AS n FROM tgt GROUP BY 1) "
    "SELECT coalesce(s.o_orderstatus, g.o_orderstatus) AS o_orderstatus, coalesce(s.n, 0) AS source_rows, coalesce(g.n, 0) AS target_rows, coalesce(s.n, "
    "0) - coalesce(g.n, 0) AS difference "
    "FROM s FULL JOIN g ON s.o_orderstatus IS NOT DISTINCT FROM g.o_orderstatus"
)
def reconcile_counts(t):
    """One group is null."""
    status = F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    return delta.reconcile(t.orders.select(status), t.tgt.select(status), "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    return delta.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# projections, coercions, views


@query("SELECT s_suppkey, s_nationkey FROM supplier")
def exclude_columns(t):
    return project.exclude_columns(t.supplier, ["S_NAME", "s_acctbal"])


@query("SELECT s_suppkey, CAST(NULL AS VARCHAR) AS s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier")
def nullify_columns(t):
    return project.nullify(t.supplier, ["s_name", "S_ACCTBAL"])


@query("SELECT s_suppkey, 'x' AS s_name, 7 AS s_nationkey, s_acctbal FROM supplier")
def override_columns(t):
    return project.override(t.supplier, {"S_Name": "x", "s_nationkey": 7})


@query(
    "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, 3 AS c_nationkey, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN 'anon' ELSE c_mktsegment END AS "
    "c_mktsegment FROM customer"
)
def column_precedence(t):
    made = F.when(F.col("c_custkey") % 2 == 0, F.lit("anon"))
    return project.apply_column_rules(t.customer, ["c_name"], {"c_name": "lost", "c_nationkey": 3}, {"c_mktsegment": made, "c_nationkey": F.lit(9), "c_name": made})


@query("SELECT l_orderkey, CAST(ascii(l_returnflag) AS SMALLINT) AS code, chr(ascii(l_returnflag)) AS back FROM lineitem")
def coerce_char_smallint(t):
    code = coerce.char_to_smallint(F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", code.alias("code"), coerce.smallint_to_char(code).alias("back"))


@query("SELECT doc_id, replace(text, 'e', '') AS clean FROM documents")
def strip_nul(t):
    """Every ``e`` of whole texts is a NUL."""
    return t.documents.select("doc_id", coerce.strip_nul(F.translate("text", "e", "\0")).alias("clean"))


@query("SELECT c_custkey, CAST(CASE WHEN x IS NULL OR x = '' THEN NULL ELSE coalesce(TRY_CAST(x AS DOUBLE), ascii(x)) END AS BIGINT) AS n FROM dirty")
def numeric_or_codepoint(t):
    return t.dirty.select("c_custkey", coerce.to_numeric_or_codepoint(F.col("x")).cast("bigint").alias("n"))


@query("SELECT c_custkey, nullif(x, '') AS x FROM dirty")
def empty_to_null(t):
    return t.dirty.select("c_custkey", coerce.empty_to_null(F.col("x")).alias("x"))


@query(
    "SELECT s_suppkey, concat('S-', s_suppkey) AS s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey "
    "= r_regionkey WHERE r_name LIKE 'A%'"
)
def view_inner_join(t):
    for n in ("supplier", "nation", "region"):
        getattr(t, n).createOrReplaceTempView(n)
    return project.build_view(t.spark, "suppliers_of_region", ["s_suppkey", "s_name", "n_name", "r_name"], {"s_name": "concat('S-', s_suppkey)"}, source="supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE 'A%'")


@query(
    "SELECT c.* FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 12) i ON c.c_nationkey = i.n_nationkey WHERE "
    "i.n_name <> 'FRANCE' OR i.n_name IS NULL OR c.c_custkey = 1"
)
def view_left_join_typeinfo(t):
    info = t.nation.filter("n_nationkey < 12").select("n_nationkey", "n_name")
    keep = (F.col("n_name") != "FRANCE") | F.col("n_name").isNull() | (F.col("c_custkey") == 1)
    return t.customer.join(info, F.col("c_nationkey") == F.col("n_nationkey"), "left").filter(keep).select(*t.customer.columns)


@query("SELECT c_custkey, concat(c_custkey, '@x') AS c_name, upper(c_mktsegment) AS c_mktsegment FROM customer")
def view_expression(t):
    masking.register_masking(t.spark)
    t.customer.createOrReplaceTempView("customer")
    return project.build_view(t.spark, "customer_masked", ["c_custkey", "c_name", "c_mktsegment"], {"c_name": "mask_unique_str(c_custkey, '@x')", "c_mktsegment": "upper(c_mktsegment)"}, source="customer")


# merges and runs


@query(
    f"""WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}')
SELECT coalesce(s.o_orderkey, k.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE k.o_custkey END AS o_custkey,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE k.o_orderstatus END AS o_orderstatus,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE k.o_totalprice END AS o_totalprice, k.o_orderpriority FROM tgt k FULL JOIN src s ON k.o_orderkey = s.o_orderkey"""
)
def upsert(t):
    changed = delta.delta(t.orders, ntz(SINCE), "o_orderdate")
    return merge.upsert(t.tgt, project.exclude_columns(changed, ["o_orderpriority", "o_orderdate"]), ["o_orderkey"])


@query(
    """WITH src AS (SELECT itempk, langpk, p_title FROM lp WHERE itempk % 7 = 0)
SELECT coalesce(s.itempk, k.itempk) AS itempk, coalesce(s.langpk, k.langpk) AS langpk, CASE WHEN s.itempk IS NOT NULL THEN s.p_title ELSE k.p_title END AS p_title, k.p_size
FROM lptgt k FULL JOIN src s ON k.itempk = s.itempk AND k.langpk = s.langpk"""
)
def upsert_composite_key(t):
    changed = delta.localized_delta(t.lp.drop("p_price"), t.part.filter("p_partkey % 7 = 0"), "itempk", "p_partkey")
    return merge.upsert(t.lptgt, changed, ["itempk", "langpk"])


@query("SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM mk m WHERE m.p_itempk = o.o_orderkey)")
def delete_by_key(t):
    return merge.delete_by_key(t.orders, t.mk, "o_orderkey")


@query(
    f"""WITH kept AS (SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM mk m WHERE m.p_itempk = tgt.o_orderkey)),
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}')
SELECT coalesce(s.o_orderkey, k.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE k.o_custkey END AS o_custkey,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE k.o_orderstatus END AS o_orderstatus,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE k.o_totalprice END AS o_totalprice, k.o_orderpriority FROM kept k FULL JOIN src s ON k.o_orderkey = s.o_orderkey"""
)
def incremental_sync(t):
    changed = delta.delta(t.orders, ntz(SINCE), "o_orderdate").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return jobs.incremental_sync(t.tgt, changed, delta.deletion_markers(t.mk, "orders"), "o_orderkey")


@query("SELECT * FROM supplier")
def full_sync(t):
    return jobs.full_sync(t.supplier, t.supplier.filter("s_suppkey % 2 = 0"))


@query("SELECT * FROM supplier WHERE s_suppkey < 0")
def full_sync_empty(t):
    """An empty source empties the target although truncation is excluded."""
    return jobs.full_sync(t.supplier.filter("s_suppkey < 0"), t.supplier.filter("s_suppkey % 2 = 0"), excluded=True)


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey % 2 = 0")
def full_sync_excluded(t):
    return jobs.full_sync(t.supplier, t.supplier.filter("s_suppkey % 2 = 0"), excluded=True)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, 0.5 * o_totalprice AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def truncate_load(t):
    """A full copy with rules, over a target with other rows, both written to Parquet and read back."""
    there = Profile(new_folder(t.spark, "target"))
    wanted = lambda df: project.exclude_columns(df, ["o_orderdate", "o_orderpriority"]).filter("o_orderstatus <> 'P'").withColumn("o_totalprice", 0.5 * F.col("o_totalprice"))
    jobs.run_full(t.spark, Profile(f"{t.sf_dir}"), there, ["orders"], truncate=False, rules={"orders": lambda df: df.select("o_orderkey")})
    jobs.run_full(t.spark, Profile(f"{t.sf_dir}"), there, ["orders"], rules={"orders": wanted})
    return read_table(t.spark, there, "orders")


MERGED = f"""WITH src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}')
SELECT coalesce(s.o_orderkey, k.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE k.o_custkey END AS o_custkey,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE k.o_orderstatus END AS o_orderstatus,
CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE k.o_totalprice END AS o_totalprice, k.o_orderpriority FROM """


def _target(t: Tables, name: str = "orders", files: int = 8) -> Profile:
    """A written target with ``tgt``'s rows, in files of neighbouring keys."""
    there = Profile(new_folder(t.spark, "target"))
    merge.overwrite(t.tgt.repartitionByRange(files, "o_orderkey").sortWithinPartitions("o_orderkey"), there, name)
    return there


@query(MERGED + "tgt k FULL JOIN src s ON k.o_orderkey = s.o_orderkey")
def merge_touched_files(t):
    """As ``upsert``, on a written table of which only files with a changed key are written anew."""
    there = _target(t)
    changed = delta.delta(t.orders, ntz(SINCE), "o_orderdate").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    merge.merge_files(there, "orders", changed, ["o_orderkey"])
    return read_table(t.spark, there, "orders")


@query(MERGED + "(SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM mk m WHERE m.p_itempk = tgt.o_orderkey AND m.modifiedts > TIMESTAMP '2024-01-01 12:00:00')) k FULL JOIN src s ON k.o_orderkey = s.o_orderkey")
def incremental_run(t):
    """A whole run into a written target: deletions, then the delta, in one change of the table; done twice."""
    there, here = _target(t), Profile(new_folder(t.spark, "source"))
    t.orders.drop("o_orderpriority").withColumnRenamed("o_orderdate", "modifiedts").write.parquet(here.path("orders"))
    markers = t.mk.filter(F.col("modifiedts") > ntz("2024-01-01 12:00:00"))
    for _ in range(2):
        _, out = jobs.run_incremental(t.spark, here, there, {"orders": ["o_orderkey"]}, SINCE, "2024-01-01 00:00:00", markers, as_time=ntz)
        _raise(out)
    return read_table(t.spark, there, "orders")


def _raise(outcomes: list[tuple[str, str | None]]) -> None:
    if errors := [e for _, e in outcomes if e]:
        raise RuntimeError(errors[0])


@query("SELECT * FROM orders")
def resumed_run(t):
    """A copy in batches that ends after the first two jobs, and a second call that writes the rest."""
    here, there = Profile(new_folder(t.spark, "source")), Profile(new_folder(t.spark, "target"))
    t.orders.repartitionByRange(12, "o_orderkey").write.parquet(here.path("orders"))
    book, jobs_done = ledger.Ledger(t.spark, new_folder(t.spark, "ledger")), []

    def ends(df: DataFrame) -> DataFrame:
        jobs_done.append(df)
        if len(jobs_done) == 3:
            raise RuntimeError("the run ends here")
        return df

    run = lambda rule: jobs.run_resumable(t.spark, here, there, {"orders": ["o_orderkey"]}, book, "r1", size=1, at_once=3, rules={"orders": rule})
    run(ends)
    _raise(run(lambda df: df))
    return read_table(t.spark, there, "orders")


@query(
    "SELECT 'orders' AS pipelinename, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS "
    "target_rows, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS difference "
    "UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part), 0"
)
def reconcile_run(t):
    """Counts that a run took while it wrote; no table is read again."""
    book = ledger.Ledger(t.spark, new_folder(t.spark, "ledger"))
    _raise(jobs.run_full(t.spark, Profile(t.sf_dir), Profile(new_folder(t.spark, "target")), ["orders", "part"], rules={"orders": lambda df: df.filter("o_orderstatus <> 'P'")}, ledger=book, run="m1"))
    return book.reconcile("m1")


CHANGES = "SELECT user_id AS pk, event_id AS v, ts, event_type AS op FROM events"


@query(
    f"SELECT pk, v FROM (SELECT pk, v, op, row_number() OVER (PARTITION BY pk ORDER BY ts DESC, v DESC) AS rn FROM ({CHANGES})) WHERE rn = 1 AND op <> "
    f"'error' UNION ALL SELECT p_partkey + 1000000, p_size FROM part"
)
def streamed_changes(t):
    """A stream of changes applied to a written table, each batch as if it came twice."""
    there, at = Profile(new_folder(t.spark, "target")), new_folder(t.spark, "changes")
    old = t.part.selectExpr("p_partkey + 1000000 AS pk", "CAST(p_size AS BIGINT) AS v")
    merge.overwrite(old.union(t.events.filter("event_id % 3 = 0").selectExpr("user_id AS pk", "-1L AS v").distinct()), there, "item")
    # of changes at one time the one with the greater number counts
    t.events.selectExpr("user_id AS pk", "event_id AS v", "struct(ts, event_id) AS at", "event_type AS op").write.parquet(at)
    apply = jobs.apply_changes(there, "item", ["pk"], "at", "changes", F.col("op") == "error")

    def twice(df: DataFrame, number: int) -> None:
        apply(df, number)
        apply(df, number)

    stream = t.spark.readStream.schema(t.spark.read.parquet(at).schema).parquet(at)
    run_available(stream, twice, new_folder(t.spark, "mark")).awaitTermination()
    return read_table(t.spark, there, "item")


@query(
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem WHERE l_returnflag IN (SELECT min(l_returnflag) FROM lineitem UNION ALL "
    "SELECT max(l_returnflag) FROM lineitem)"
)
def read_chosen_partitions(t):
    """Partitions are found by the layout; those that are not chosen are left unread."""
    at = new_folder(t.spark, "partitioned")
    t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag").write.partitionBy("l_returnflag").parquet(at)
    found = list_partitions(t.spark, at, "l_returnflag")
    ends = found.agg(F.min("l_returnflag").alias("a"), F.max("l_returnflag").alias("b"))
    chosen = ends.select(F.explode(F.array("a", "b")).alias("l_returnflag"))
    return read_partitions(t.spark.read.parquet(at), "l_returnflag", chosen)


@query(
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice, o_orderstatus FROM orders UNION ALL SELECT "
    "o_orderkey, o_custkey, o_totalprice, NULL FROM tgt"
)
def evolved_run(t):
    """A full run whose target lacks a column of the source, has one that the source lacks, and keeps its rows."""
    there, here = Profile(new_folder(t.spark, "target")), Profile(new_folder(t.spark, "source"))
    merge.overwrite(t.tgt.select("O_ORDERKEY", "o_custkey", "o_totalprice", F.lit("x").alias("only_here")), there, "orders")
    t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").write.parquet(here.path("orders"))
    _raise(jobs.run_full(t.spark, here, there, ["orders"], truncate=False, switches=schema.Switches(remove_columns=True)))
    return read_table(t.spark, there, "orders").withColumnRenamed("O_ORDERKEY", "o_orderkey")


@query(
    "SELECT DISTINCT lower(table_name) AS table_name FROM tcat WHERE lower(table_name) NOT IN (SELECT replace(lower(table_name), 'src_', 'tgt_') FROM cat "
    "WHERE row_count > 25)"
)
def tables_to_clear(t):
    """Names of tables differ in case, some come twice in different cases."""
    included = t.cat.filter("row_count > 25").select(F.replace(F.lower("table_name"), F.lit("src_"), F.lit("tgt_")).alias("table_name"))
    return merge.tables_to_clear(t.tcat.union(t.tcat.select(F.upper("table_name"))), included)


@query("SELECT DISTINCT p_itempk, p_table, changetype, min(ts) OVER (PARTITION BY p_itempk, p_table) AS modifiedts FROM (SELECT item_pk AS p_itempk, table_name AS p_table, 'DELETED' AS changetype, ts FROM chg JOIN tmap USING (typecode) WHERE change = 'REMOVE')", "capture_deletions")
def _capture(t):
    return capture_deletions(t.chg, t.tmap)


@query("SELECT DISTINCT table_name FROM tmap WHERE table_name IN (SELECT lower(n_name) FROM nation WHERE n_regionkey < 3)")
def deletion_tables(t):
    return catalog.deletion_tables(t.tmap, t.nation.filter("n_regionkey < 3").select(F.col("n_name").alias("table_name")))


# ledger


ROLL = (
    "SELECT migrationid, max(lastupdate) AS last_update, count(*) AS total, count(duration) AS completed, count(*) FILTER (failure = 1) AS failed FROM "
    "tasks GROUP BY migrationid"
)


@query(ROLL)
def status_rollup(t):
    return ledger.rollup_status(t.tasks)


@query(
    f"SELECT *, CASE WHEN completed >= total THEN last_update END AS end_at, CASE WHEN completed >= total THEN 'PROCESSED' ELSE 'RUNNING' END AS status, "
    f"completed >= total AS is_completed, failed > 0 AS is_failed FROM ({ROLL})"
)
def migration_status(t):
    return ledger.migration_status(ledger.rollup_status(t.tasks))


@query(f"SELECT *, CASE WHEN completed >= total THEN last_update END AS end_at, CASE WHEN completed >= total THEN 'COMPLETED' ELSE 'RUNNING' END AS status, completed >= total AS is_completed, failed > 0 AS is_failed FROM ({ROLL.replace('count(*) AS total', 'CAST(4 AS BIGINT) AS total')})")
def schema_rollup(t):
    return ledger.migration_status(ledger.rollup_status(t.tasks, total=4), done="COMPLETED")


@query("SELECT user_id % 100 AS migrationid, max(ts) AS last_update FROM events GROUP BY 1 HAVING max(ts) < (SELECT max(ts) FROM events) - INTERVAL 2 HOUR")
def stalled_tasks(t):
    return ledger.stalled(t.tasks, t.events.agg(F.max("ts")).scalar(), 7200)


@query(f"SELECT r.migrationid, startat, last_update, coalesce(total, 0) AS total, coalesce(completed, 0) AS completed, coalesce(failed, 0) AS failed FROM runs r LEFT JOIN ({ROLL.replace('FROM tasks', 'FROM tasks WHERE user_id % 100 < 60')}) USING (migrationid)")
def run_status(t):
    return ledger.run_status(t.runs, t.tasks.filter("user_id % 100 < 60"))


@query(
    "SELECT event_type, round(CAST(sum(rows) AS DOUBLE) / sum(seconds), 6) AS average, round(min(CAST(rows AS DOUBLE) / seconds), 6) AS slowest, "
    "round(max(CAST(rows AS DOUBLE) / seconds), 6) AS fastest FROM bat GROUP BY event_type"
)
def throughput(t):
    return ledger.throughput(t.bat, "event_type").select("event_type", *(F.round(c, 6).alias(c) for c in ("average", "slowest", "fastest")))


@query(
    "SELECT event_type, round(avg(a), 6) AS mean_throughput FROM (SELECT event_type, user_id, CAST(sum(rows) AS DOUBLE) / sum(seconds) AS a FROM bat GROUP "
    "BY 1, 2) GROUP BY 1"
)
def throughput_by_category(t):
    return ledger.throughput_by_category(t.bat, "user_id", "event_type").withColumn("mean_throughput", F.round("mean_throughput", 6))


@query("SELECT * FROM plan WHERE batchid % 3 <> 0")
def pending_batches(t):
    return ledger.pending_batches(t.plan, t.plan.filter("batchid % 3 = 0"), ["batchid"])


@query("SELECT * FROM tasks WHERE duration IS NULL")
def pending_tasks(t):
    return ledger.pending_tasks(t.tasks)


@query("SELECT * FROM tasks WHERE failure = 1")
def failed_tasks(t):
    return ledger.failed_tasks(t.tasks)


@query("SELECT * FROM tasks WHERE lastupdate >= TIMESTAMP '2024-01-02 00:00:00'")
def updated_tasks(t):
    return ledger.updated_tasks(t.tasks, ntz("2024-01-02 00:00:00"))


@query("SELECT migrationid FROM runs ORDER BY startat DESC, migrationid DESC LIMIT 1")
def latest_run(t):
    return ledger.latest_run(t.runs, "migrationid", "startat")


# schemas


@query("SELECT DISTINCT lower(table_name) AS table_name FROM cols WHERE lower(table_name) NOT IN (SELECT lower(table_name) FROM tcols)")
def schema_diff_tables(t):
    return schema.missing_tables(t.cols, t.tcols)


MISSING = (
    "SELECT DISTINCT lower(table_name) AS table_name, lower(column_name) AS column_name FROM cols c WHERE lower(table_name) IN (SELECT lower(table_name) "
    "FROM tcols) AND NOT EXISTS (SELECT 1 FROM tcols d WHERE lower(d.table_name) = lower(c.table_name) AND lower(d.column_name) = lower(c.column_name))"
)


@query(MISSING)
def schema_diff_columns(t):
    return schema.missing_columns(t.cols, t.tcols)


@query(f"SELECT table_name, string_agg(column_name, ';' ORDER BY column_name) AS columns FROM ({MISSING}) GROUP BY 1")
def schema_diff_summary(t):
    return schema.summary(schema.missing_columns(t.cols, t.tcols))


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_phone FROM customer")
def align_schema(t):
    wanted = T.StructType([T.StructField(n, k) for n, k in (("c_custkey", T.LongType()), ("c_name", T.StringType()), ("C_NATIONKEY", T.LongType()), ("c_phone", T.StringType()))])
    return schema.align_schema(t.customer, wanted).withColumnRenamed("C_NATIONKEY", "c_nationkey")


# catalogue


@query("SELECT DISTINCT lower(table_name) AS table_name FROM cat")
def list_tables(t):
    from tablesync.sources.profile import list_tables as listed

    return listed(t.cat)


@query(
    "SELECT * FROM cat WHERE lower(table_name) NOT IN ('src_props1', 'src_composedtypes1') AND (lower(table_name) LIKE 'src_tab1%' OR lower(table_name) = "
    "'src_props7')"
)
def table_filters(t):
    wanted = t.cat.select(F.upper("table_name").alias("table_name")).filter("table_name LIKE 'SRC_TAB1%' OR table_name IN ('SRC_PROPS7', 'SRC_PROPS1')")
    return catalog.filter_tables(t.cat, include=wanted, exclude=["src_PROPS1", "src_composedtypes1"])


@query("SELECT DISTINCT lower(table_name) AS table_name, lower(column_name) AS column_name FROM cols")
def list_columns(t):
    from tablesync.sources.profile import list_columns as listed

    return listed(t.cols)


def _common(prefix: str, suffix: str, relation: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower(table_name), '^{prefix}', ''), 'lp$', '')"
    return f"SELECT DISTINCT table_name AS full_name, CASE WHEN {bare} IN ('props{suffix}', 'composedtypes{suffix}') THEN left({bare}, length({bare}) - 1) ELSE {bare} END || CASE WHEN lower(table_name) LIKE '%lp' THEN 'lp' ELSE '' END AS common_name FROM {relation}"


@query(f"SELECT s.common_name, s.full_name AS source_table, g.full_name AS target_table FROM ({_common('src_', '1', 'cat')}) s JOIN ({_common('tgt_', '2', 'tcat')}) g USING (common_name)")
def plan_items(t):
    return catalog.plan_items(catalog.candidates(t.cat, "src_", "1"), catalog.candidates(t.tcat, "tgt_", "2"))


@query(
    f"SELECT 'source' AS side, common_name, full_name FROM ({_common('src_', '1', 'cat')}) WHERE common_name NOT IN (SELECT common_name FROM ({_common('tgt_', '2', 'tcat')})) "
    f"UNION ALL SELECT 'target', common_name, full_name FROM ({_common('tgt_', '2', 'tcat')}) WHERE common_name NOT IN (SELECT common_name FROM ({_common('src_', '1', 'cat')}))"
)
def schema_diff_both_ways(t):
    return schema.table_difference(catalog.candidates(t.cat, "src_", "1"), catalog.candidates(t.tcat, "tgt_", "2"))


@query(f"SELECT common_name FROM ({_common('tgt_', '2', 'tcat')}) UNION SELECT common_name FROM ({_common('src_', '1', 'cat')}) WHERE common_name LIKE 'tab%'")
def align_tables(t):
    """Tables that only one side has, of each side; those that are missing are added, superfluous ones stay."""
    left = catalog.candidates(t.cat, "src_", "1").filter("common_name LIKE 'tab%'")
    return schema.align_tables(left, catalog.candidates(t.tcat, "tgt_", "2"), remove=False)


@query(
    "SELECT DISTINCT table_name AS full_name FROM cat WHERE lower(table_name) NOT IN ('src_props7', 'src_propsextra')"
)
def filter_candidates(t):
    return catalog.filter_candidates(catalog.candidates(t.cat, "src_", "1"), "src_", "1").select("full_name")


@query(
    "SELECT DISTINCT table_name, CASE WHEN lower(table_name) = 'src_composedtypes1' THEN 'tgt_composedtypes2' WHEN lower(table_name) = 'src_props1' THEN "
    "'tgt_Props2' ELSE concat('tgt_', substr(table_name, 5)) END AS target_name FROM cat"
)
def translate_names(t):
    full = F.col("table_name")
    return t.cat.select("table_name", names.translate_name(names.base_name(full, "src_", "1"), names.additional_suffix(full), "tgt_", "2").alias("target_name")).distinct()


@query("SELECT DISTINCT table_name, concat('v_', table_name) AS view_name, table_name AS back FROM cat")
def view_names(t):
    v = names.view_name(F.col("table_name"))
    return t.cat.select("table_name", v.alias("view_name"), names.table_of_view(v).alias("back")).distinct()


@query(
    "SELECT i.*, CAST(row_number() OVER (PARTITION BY table_name ORDER BY position) AS INTEGER) AS key_order FROM idx i JOIN "
    "(SELECT table_name, index_name FROM (SELECT table_name, index_name, row_number() OVER (PARTITION BY table_name ORDER BY count(*), index_name) AS rn "
    "FROM idx WHERE index_name IN ('ix1', 'ix3', 'ix5', 'ix7') GROUP BY 1, 2) WHERE rn = 1) b USING (table_name, index_name)"
)
def smallest_unique_key(t):
    unique = F.col("index_name").isin("ix1", "ix3", "ix5", "ix7").alias("is_unique")
    return catalog.smallest_unique_key(t.idx, t.idx.select("table_name", "index_name", unique).distinct())


@query(
    "SELECT table_name, row_count, CAST(CASE WHEN lower(table_name) = 'src_props1' THEN 0 WHEN lower(table_name) = 'src_composedtypes1' THEN 2 ELSE 1 END "
    "AS INTEGER) AS sort_group FROM cat"
)
def order_items(t):
    return catalog.order_items(t.cat, ["src_props1"], ["SRC_composedtypes1"])


@query(
    "SELECT CASE WHEN lower(table_name) LIKE 'src_tab1%' THEN 'SRC_TAB1' WHEN lower(table_name) LIKE 'src_p%' THEN 'src_p' ELSE '' END AS prefix, count(*) "
    "AS n_tables FROM cat GROUP BY 1"
)
def prefix_summary(t):
    return catalog.prefix_summary(t.cat, ["SRC_TAB1", "src_p"])


@query(
    "WITH s AS (SELECT DISTINCT replace(lower(table_name), 'src_', 'tgt_') AS n FROM cat), "
    "g AS (SELECT DISTINCT concat(CASE WHEN lower(table_name) LIKE '%5' THEN 'mig_' ELSE '' END, lower(table_name)) AS m FROM tcat), "
    "b AS (SELECT n, CAST(count(m) AS BIGINT) AS k, CASE WHEN bool_or(m LIKE 'mig_%') THEN 'staged' WHEN count(m) = 0 THEN 'missing' ELSE 'direct' END AS "
    "copied FROM s LEFT JOIN g ON replace(m, 'mig_', '') = n GROUP BY 1) "
    "SELECT copied, count(*) AS n_source, CAST(sum(k) AS BIGINT) AS n_target FROM b GROUP BY 1"
)
def migration_summary(t):
    name = F.lower("table_name")
    source = t.cat.select(F.replace(name, F.lit("src_"), F.lit("tgt_")).alias("table_name"))
    staged = t.tcat.select(F.concat(F.when(name.endswith("5"), "MIG_").otherwise(""), "table_name").alias("table_name"))
    return catalog.migration_summary(source, staged, "mig_")


@query("SELECT * FROM dep WHERE TypeSystemName = 'SYS1' AND Typecode IS NOT NULL AND TableName IS NOT NULL")
def type_tables(t):
    return catalog.type_tables(t.dep, "SYS1")


@query("SELECT concat('src_aud', p_partkey) AS table_name, p_partkey % 5 = 0 AS is_audit FROM part")
def is_audit(t):
    return catalog.is_audit(t.part.select(F.concat(F.lit("src_aud"), "p_partkey").alias("table_name")), t.dep, "src_")


@query("SELECT * FROM dep WHERE TypeSystemName = 'SYS2'")
def default_conditions(t):
    from tablesync.sources.profile import default_conditions as conditions

    return conditions(t.dep, "tgt_YDeployments", "SYS2")


@query("SELECT * REPLACE ('NEW' AS TypeSystemName) FROM dep")
def override_type_system(t):
    return catalog.override_type_system(t.dep, "SYS1", "NEW")


@query(
    "SELECT * REPLACE (CASE WHEN TypeSystemName = 'SYS1' AND TableName IN ('composedtypes1', 'props1') THEN concat(left(TableName, length(TableName) - 1), "
    "'2') ELSE TableName END AS TableName, CASE WHEN TypeSystemName = 'SYS1' AND PropsTableName = 'Props1' THEN 'Props2' ELSE PropsTableName END AS "
    "PropsTableName) FROM dep"
)
def rewrite_deployments(t):
    return catalog.rewrite_deployments(t.dep, "1", "2", "SYS1")


@query(
    "SELECT name, CASE WHEN name = 'SYS2' THEN 'current' ELSE 'retired' END AS state, CASE WHEN name = 'SYS2' THEN 'migrated' ELSE comment END AS comment "
    "FROM systems"
)
def set_active(t):
    return catalog.set_active(t.systems, "SYS2", "migrated")


@query("SELECT DISTINCT systems.name, '1' AS suffix FROM systems JOIN dep ON systems.name = TypeSystemName WHERE state = 'current' AND TableName = 'composedtypes1'")
def current_type_system(t):
    return catalog.current_type_system(t.systems, t.dep)


@query("SELECT DISTINCT '1' AS suffix_found, true AS ok FROM dep WHERE TypeSystemName = 'SYS1' AND TableName = 'composedtypes1'")
def check_type_system(t):
    return catalog.check_type_system(t.dep, "SYS1", "1")


@query("SELECT p_brand AS InternalCode, p_partkey AS PK FROM part WHERE p_brand IN ('Brand#11', 'Brand#23')")
def type_info(t):
    return catalog.type_info(t.part.select(F.col("p_brand").alias("InternalCode"), F.col("p_partkey").alias("PK")), ["Brand#11", "Brand#23"])


STAGING = (
    "SELECT DISTINCT replace(lower(table_name), 'ydeployments', '') AS prefix FROM staged WHERE lower(table_name) LIKE '%ydeployments' AND "
    "lower(table_name) NOT IN ('run_ydeployments', 'mig_ydeployments')"
)


@query(STAGING)
def staging_prefixes(t):
    return catalog.staging_prefixes(t.staged, ["run_", "MIG_"])


@query(f"SELECT DISTINCT s.table_name FROM staged s JOIN ({STAGING}) p ON starts_with(lower(s.table_name), p.prefix) WHERE (SELECT count(*) FROM ({STAGING})) > 5")
def staged_tables(t):
    return catalog.staged_tables(t.staged, catalog.staging_prefixes(t.staged, ["run_", "MIG_"]))


# masking and anonymisation


@query("SELECT c_custkey, CASE WHEN x IS NOT NULL THEN '***' END AS a, concat(c_custkey, '@y') AS b, CASE WHEN x = 'BUILDING' THEN NULL END AS c, '*' AS d FROM dirty")
def mask_functions(t):
    x = F.col("x")
    return t.dirty.select("c_custkey", masking.mask_str(x, "***").alias("a"), masking.mask_unique_str(F.col("c_custkey"), "@y").alias("b"), masking.mask_password(x).alias("c"), masking.mask_password_encoding(x).alias("d"))


@query("SELECT k, CASE WHEN k = 'db.secret' THEN '***' ELSE regexp_replace(v, '^(.*?)password=.*?;', '\\1password=***;') END AS v FROM conf")
def mask_config(t):
    return t.conf.select("k", masking.mask_config(F.col("k"), F.col("v"), ["db.secret"]).alias("v"))


RULES = [an.Rule("C_NAME", "REPLACE", "u-{RANDOM(number,6)}-{RANDOM(string,4)}"), an.Rule("c_mktsegment", "APPEND", "-{GUID}", exclude=("BUILDING",), exclude_row=("MACHINERY",)), an.Rule("c_acctbal", "DELETE")]


@query(
    "SELECT c_mktsegment AS segment, count(*) AS n, count(*) FILTER (c_mktsegment <> 'MACHINERY') AS renamed, count(*) FILTER (c_mktsegment NOT IN "
    "('MACHINERY', 'BUILDING')) AS appended, count(*) FILTER (c_mktsegment = 'MACHINERY') AS kept_balance FROM customer GROUP BY 1"
)
def anonymize_shape(t):
    new = an.anonymize(t.customer.withColumn("segment", F.col("c_mktsegment")), RULES, "customer", "c_custkey", "s1")
    guid = "^.*-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    return new.groupBy("segment").agg(F.count("*").alias("n"), F.count_if(F.col("c_name").rlike("^u-[1-9][0-9]{5}-[A-Za-z]{4}$")).alias("renamed"), F.count_if(F.col("c_mktsegment").rlike(guid)).alias("appended"), F.count_if(F.col("c_acctbal").isNotNull()).alias("kept_balance"))


_CITY = "CAST(('0x' || substr(sha256(concat_ws('|', 's1', 'customer', 'c_name', c_custkey, '0', '0')), 1, 12)) AS UBIGINT)"


@query(
    f"WITH cities AS (SELECT list(n_name ORDER BY n_nationkey) AS l FROM nation) SELECT c_custkey, l[CAST({_CITY} % len(l) AS BIGINT) + 1] AS c_name FROM "
    f"customer, cities"
)
def anonymize_from_lists(t):
    """A rule picks from a list that a file has."""
    at = new_folder(t.spark, "lists")
    cities = F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    t.nation.agg(cities.alias("city")).coalesce(1).write.json(at)
    rules = [an.Rule("c_name", "REPLACE", "{RANDOM(city)}")]
    return an.anonymize(t.customer, rules, "customer", "c_custkey", "s1", an.load_lists(t.spark, at)).select("c_custkey", "c_name")


def _h(k: int, i: int) -> str:
    return f"CAST(('0x' || substr(sha256(concat_ws('|', 's1', 'customer', 'c_name', c_custkey, '{k}', '{i}')), 1, 12)) AS UBIGINT)"


_NUMBER = " || ".join(["CAST(1 + " + _h(1, 0) + " % 9 AS VARCHAR)", *(f"CAST({_h(1, i)} % 10 AS VARCHAR)" for i in range(1, 6))])
_TEXT = " || ".join(f"substr('{an.LETTERS}', CAST({_h(3, i)} % 52 AS BIGINT) + 1, 1)" for i in range(4))


@query(f"SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE 'u-' || {_NUMBER} || '-' || {_TEXT} END AS c_name FROM customer")
def anonymize_values(t):
    return an.anonymize(t.customer, RULES, "customer", "c_custkey", "s1").select("c_custkey", "c_name")

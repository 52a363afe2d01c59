import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import anonymize as an
from tablesync.functions import coerce
from tablesync.operators import batches, delta, merge, project
from tablesync.plans import catalog, jobs, ledger, schema
from tablesync.plans.registry import ORACLES, QUERIES
from tablesync.sources.profile import Profile, key_range_predicates, read_by_key_ranges, read_table
from tablesync.streaming.capture import capture_deletions, run_available

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _same(a, b):
    clean = lambda df: sorted(([None if pd.isna(v) else round(v, 9) if isinstance(v, float) else v for v in r] for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)
    return sorted(a.columns) == sorted(b.columns) and clean(a) == clean(b)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert _same(QUERIES[name](spark, SF).toPandas(), db.execute(ORACLES[name]).df())


def test_upsert_takes_nulls_and_keeps_columns_not_copied(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, kept string")
    source = spark.createDataFrame([(1, None), (3, "c"), (None, "m")], "k int, v string")
    assert rows(merge.upsert(target, source, ["k"])) == rows(spark.createDataFrame([(1, None, "x"), (2, "b", "y"), (None, "n", "z"), (3, "c", None), (None, "m", None)], target.schema))


def test_upsert_refuses_or_orders_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "k int, v string, at int")
    with pytest.raises(Exception, match="repeated key"):
        merge.upsert(target, twice.drop("at"), ["k"]).collect()
    assert rows(merge.upsert(target, merge.unique_by(twice, ["k"], "at").drop("at"), ["k"])) == [(1, "c")]
    with pytest.raises(ValueError):
        merge.upsert(target, target, [])


def test_incremental_sync_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new, gone = spark.createDataFrame([(2, "B"), (3, "c")], target.schema), spark.createDataFrame([(1,), (2,)], "p_itempk int")
    once = jobs.incremental_sync(target, new, gone, "k")
    assert rows(once) == rows(jobs.incremental_sync(once, new, gone, "k")) == [(2, "B"), (3, "c")]


def test_distributed_rank_equals_the_plain_one(spark):
    df = spark.range(0, 997).select((F.col("id") * 7919 % 1009).alias("k"))
    got = {r["k"]: r["rn"] for r in batches.global_rank(df, ["k"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}
    assert batches.global_rank(df.limit(0), ["k"]).count() == 0


def test_column_rules(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError):
        project.exclude_columns(df, ["ID", "V"])
    assert rows(project.apply_column_rules(df, ["V"], {"v": "x"}, {"v": F.lit("y")})) == [(1, None)]
    with pytest.raises(ValueError):
        delta.delta(df, None, "v")


def test_templates(spark):
    for bad in ("{GUID", "GUID}", "{RANDOM(number}"):
        with pytest.raises(ValueError):
            an.split_template(bad)
    with pytest.raises(ValueError):
        an.template_column("{RANDOM(number,1)}", "s", "t", "c", F.lit(1))
    with pytest.raises(ValueError):
        an.template_column("{RANDOM(string)}", "s", "t", "c", F.lit(1))
    one = spark.range(1).select(an.template_column("  plain ", "s", "t", "c", F.lit(1)), an.template_column("a{NOPE}b", "s", "t", "c", F.lit(1)), an.template_column(" ", "s", "t", "c", F.lit(1)))
    assert rows(one) == [("plain", "ab", "")]


def test_anonymize_keeps_nulls_excluded_values_and_rows(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, None, "p"), (3, "keep", "p"), (4, "a", "whole")], "pk int, v string, w string")
    rules = [an.Rule("V", "REPLACE", "x", exclude=("keep",)), an.Rule("w", "DELETE", exclude_row=("whole",))]
    assert rows(an.anonymize(df, rules, "t", "pk", "s")) == [(1, "x", None), (2, None, None), (3, "keep", None), (4, "a", "whole")]


def test_coercions(spark):
    df = spark.createDataFrame([("",), ("A",), (None,), ("12.5",)], "x string")
    got = df.select("x", coerce.to_numeric_or_codepoint(F.col("x")).cast("double"), coerce.empty_to_null(F.col("x")), coerce.char_to_smallint(F.col("x")))
    assert rows(got) == rows(spark.createDataFrame([("", None, None, None), ("A", 65.0, "A", 65), (None, None, None, None), ("12.5", 12.5, "12.5", 49)], "a string, b double, c string, d short"))


def test_catalogue_and_schema(spark):
    with pytest.raises(ValueError):
        catalog.filter_tables(spark.createDataFrame([("a",)], "table_name string"), incremental=[])
    out = schema.align_schema(spark.createDataFrame([(1, 2)], "a int, b int"), T.StructType([T.StructField("A", T.LongType()), T.StructField("c", T.StringType())]))
    assert out.dtypes == [("A", "bigint"), ("c", "string")]
    dep = spark.createDataFrame([("t1", None, "t1aud")], "TableName string, PropsTableName string, AuditTableName string")
    there = spark.createDataFrame([("T1LP",), ("t1aud",)], "table_name string")
    got = {r[0] for r in catalog.source_candidates(dep, there, audit=True, custom=["mine"]).collect()}
    assert {"t1", "t1lp", "t1aud", "mine", "ydeployments"} <= got


def test_jobs_and_marks():
    done = jobs.run_tables(["a", "b"], lambda t: 1 / (t == "b"))
    assert done[0][1] and done[1][1] is None
    assert jobs.next_mark("m", "n", done) == "m" and jobs.next_mark("m", "n", done[1:]) == "n"
    with pytest.raises(ValueError):
        jobs.next_mark(None, "n", [])


def test_names_that_differ_in_case_and_groups_of_null(spark):
    t = spark.createDataFrame([("Orders",), ("ORDERS",), ("parts",)], "table_name string")
    assert rows(merge.tables_to_clear(t, spark.createDataFrame([("orders",)], "table_name string"))) == [("parts",)]
    own = spark.createDataFrame([(None,), ("a",)], "g string")
    assert rows(delta.reconcile(own, own, "g")) == rows(spark.createDataFrame([(None, 1, 1, 0), ("a", 1, 1, 0)], "g string, s long, t long, d long"))
    names = spark.createDataFrame([(f"src_{n}",) for n in ("props1", "Props2", "propsExtra", "maptypessn", "props1lp", "tab2")], "table_name string")
    kept = catalog.filter_candidates(catalog.candidates(names, "src_", "1"), "src_", "1")
    assert {r["full_name"] for r in kept.collect()} == {"src_props1", "src_maptypessn", "src_props1lp", "src_tab2"}
    one, two = catalog.candidates(names, "src_", "1"), catalog.candidates(names.filter("table_name <> 'src_tab2'"), "src_", "1")
    with pytest.raises(Exception, match="no target table for src_tab2"):
        catalog.plan_items(one, two, spark.createDataFrame([("TAB2",)], "table_name string")).collect()


def test_full_and_incremental_runs_write(spark, tmp_path):
    from tablesync.sources.profile import read_catalogue

    here, there = Profile(str(tmp_path / "s"), prefix="s_"), Profile(str(tmp_path / "t"))
    put = lambda p, n, data, schema: spark.createDataFrame(data, schema).write.mode("overwrite").parquet(p.path(n))
    put(here, "item", [(1, "a", 1), (2, "b", 1), (3, "c", 1)], "pk long, v string, modifiedts long")
    put(here, "itemlp", [(1, "en", "x"), (2, "en", "y")], "itempk long, langpk string, w string")
    put(here, "none", [], "pk long, v string")
    put(there, "none", [(9, "old")], "pk long, v string")
    put(there, "item", [(9, "old", 0)], "pk long, v string, modifiedts long")
    out = jobs.run_full(spark, here, there, ["item", "itemlp", "none", "lost"], excluded=("ITEM", "none"))
    assert [t for t, e in out if e] == ["lost"]
    assert rows(read_table(spark, there, "item").select("pk")) == [(1,), (2,), (3,), (9,)] and read_table(spark, there, "none").count() == 0
    assert [t for t, _ in jobs.run_full(spark, here, there, ["item", "itemlp"], done=("Item",))] == ["itemlp"]
    put(here, "item", [(1, "a", 1), (2, "B", 5), (4, "d", 6)], "pk long, v string, modifiedts long")
    put(here, "itemlp", [(1, "en", "not changed"), (2, "en", "Y"), (4, "de", "z")], "itempk long, langpk string, w string")
    markers = spark.createDataFrame([(3, "item", 4), (9, "item", 1)], "p_itempk long, p_table string, modifiedts long")
    tables = {"item": ["pk"], "itemlp": ["itempk", "langpk"]}
    run = lambda mark, names: jobs.run_incremental(spark, here, there, names, mark, "7", markers, as_time=lambda m: F.lit(int(m)))
    for mark in ("2", "2"):
        new, out = run(mark, tables)
        assert new == "7" and not any(e for _, e in out)
        assert rows(read_table(spark, there, "item").select("pk", "v")) == [(1, "a"), (2, "B"), (4, "d"), (9, "old")]
        assert rows(read_table(spark, there, "itemlp")) == [(1, "en", "x"), (2, "en", "Y"), (4, "de", "z")]
    assert run("2", tables | {"lost": ["pk"]})[0] == "2"
    with pytest.raises(ValueError):
        run(None, tables)
    listed = {tuple(r) for r in read_catalogue(spark, here).collect()}
    assert ("s_item", "pk") in listed and ("s_itemlp", "w") in listed


def test_ranks_of_one_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("k"))
    assert sorted(r["rn"] for r in batches.global_rank(df, ["k"]).collect()) == list(range(3000))
    got = {(r["k"], r["batch_id"]) for r in batches.key_range_batches(df, "k", 100).collect()}
    assert (7, 24) in got and len({b for k, b in got if k == 7}) == 1 and (2999, 29) in got


def test_report_round_trip(spark, tmp_path):
    from tablesync.sources.profile import read_reports

    ledger.write_report(spark.createDataFrame([("m1", "PROCESSED")], "id string, status string"), str(tmp_path / "r"))
    assert read_reports(spark, str(tmp_path / "r")).first()["id"] == "m1"


def test_jdbc_ranges_and_merge(spark, tmp_path):
    p = Profile(f"jdbc:derby:{tmp_path}/db;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    spark.range(10).selectExpr("id AS k", "id * 2 AS v").write.format("jdbc").options(**p.jdbc_options(), dbtable="t").save()
    df = read_by_key_ranges(spark, p, "t", '"k"', [0, 4, 8])
    assert df.rdd.getNumPartitions() == 3 and df.count() == 10
    merge.upsert_jdbc(spark.createDataFrame([(3, -1), (20, -2)], "k long, v long"), p, "t", ["k"])
    merge.delete_jdbc(spark.createDataFrame([(0,)], "p_itempk long"), p, "t", "k")
    got = {r[0]: r[1] for r in read_table(spark, p, "t").collect()}
    assert len(got) == 10 and got[3] == -1 and got[20] == -2 and 0 not in got
    assert key_range_predicates("k", []) == []
    with pytest.raises(ValueError):
        read_by_key_ranges(spark, p, "t", "k", [])


def test_capture_stream_equals_batch_and_resumes(spark, tmp_path):
    events = spark.createDataFrame([(1, 5, "REMOVE", datetime.datetime(2024, 1, 1)), (1, 5, "REMOVE", datetime.datetime(2024, 1, 2)), (2, 5, "SAVE", datetime.datetime(2024, 1, 1)), (3, 9, "REMOVE", datetime.datetime(2024, 1, 1))], "item_pk long, typecode int, change string, ts timestamp_ntz")
    types = spark.createDataFrame([(5, "orders")], "typecode int, table_name string")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
        run_available(capture_deletions(stream, types), lambda df, _: seen.extend(df.select("p_itempk", "p_table").collect()), str(tmp_path / "mark")).awaitTermination()
    assert sorted(map(tuple, seen)) == rows(capture_deletions(events, types).select("p_itempk", "p_table")) == [(1, "orders")]

"""Runs that write: nothing is lost, applied twice or seen in part."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesync.operators import merge
from tablesync.plans import jobs
from tablesync.plans.ledger import Ledger
from tablesync.plans.schema import Switches, evolved
from tablesync.sources.files import Folder
from tablesync.sources.profile import Profile, list_partitions, markers_jdbc, markers_query, read_in_ranges, read_partitions, read_table, table_exists
from tablesync.streaming.capture import capture_deletions, run_available
from tests.test_library import rows

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture
def db(tmp_path):
    return Profile(f"jdbc:derby:{tmp_path}/db;create=true", driver=DRIVER)


def put(spark, profile, name, data, schema, files=1):
    df = spark.createDataFrame(data, schema)
    if profile.is_jdbc:
        df.write.format("jdbc").options(**profile.jdbc_options(), dbtable=f"{profile.prefix}{name}").mode("overwrite").save()
    else:
        df.repartitionByRange(files, df.columns[0]).write.mode("overwrite").parquet(profile.path(name))


def got(spark, profile, name, *columns):
    return rows(read_table(spark, profile, name).select(*(columns or ["*"])))


def incremental(spark, source, target, markers=None, tables=None):
    return jobs.run_incremental(spark, source, target, tables or {"item": ["pk"]}, "2", "7", markers, as_time=lambda m: F.lit(int(m)))


KIND = "pk long, v long, modifiedts long"


def test_incremental_run_into_a_database_keeps_its_rows(spark, db, tmp_path):
    here = Profile(str(tmp_path / "s"))
    put(spark, here, "item", [(3, -3, 5), (100, -100, 6), (4, -4, 1)], KIND)
    put(spark, db, "item", [(i, i, 0) for i in range(15)], KIND)
    markers = spark.createDataFrame([(0, "item", 5), (1, "item", 1), (3, "item", 4)], "p_itempk long, p_table string, modifiedts long")
    for _ in range(2):
        mark, out = incremental(spark, here, db, markers)
        assert mark == "7" and not any(e for _, e in out)
        want = {i: i for i in range(1, 15)} | {3: -3, 100: -100}
        assert got(spark, db, "item", "pk", "v") == sorted(want.items(), key=repr)
    names = {t.lower() for t in _tables(spark, db)}
    assert "item" in names and not any(n.startswith("s") and len(n) == 21 for n in names)


def _tables(spark, profile):
    with merge.transaction(spark, profile) as link:
        found, out = link.getMetaData().getTables(None, "APP", "%", None), []
        while found.next():
            out.append(found.getString("TABLE_NAME"))
        return out


def test_failure_between_deletions_and_upserts_changes_nothing(spark, db, tmp_path, monkeypatch):
    here = Profile(str(tmp_path / "s"))
    put(spark, here, "item", [(3, -3, 5)], KIND)
    put(spark, db, "item", [(i, i, 0) for i in range(5)], KIND)
    before = got(spark, db, "item")
    monkeypatch.setattr(merge, "merge_statement", lambda *_: "MERGE INTO nowhere")
    mark, out = incremental(spark, here, db, spark.createDataFrame([(0, "item", 5)], "p_itempk long, p_table string, modifiedts long"))
    assert mark == "2" and out[0][1] and got(spark, db, "item") == before
    assert not any(t.lower().startswith("s") and len(t) == 21 for t in _tables(spark, db))


@pytest.mark.parametrize("kind", ["folder", "database"])
def test_views_stand_for_the_source_only(spark, db, tmp_path, kind):
    here, there = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")) if kind == "folder" else db
    put(spark, here, "item", [(i, 0, 0) for i in range(3)], KIND)
    put(spark, there, "item", [(i, i, 0) for i in range(15)], KIND)
    spark.createDataFrame([(i, -i, 9) for i in range(10, 20)], KIND).createOrReplaceTempView("v_item")
    mark, out = incremental(spark, here, there)
    assert mark == "7" and got(spark, there, "item", "pk", "v") == sorted([(i, i) for i in range(10)] + [(i, -i) for i in range(10, 20)], key=repr)
    assert not spark.catalog.tableExists("v_item")


def test_a_database_table_is_not_emptied_before_it_is_read(spark, db):
    put(spark, db, "item", [(i, i, 0) for i in range(5)], KIND)
    own = read_table(spark, db, "item")
    with pytest.raises(ValueError, match="emptied"):
        merge.overwrite(own.filter("pk > 2"), db, "item")
    assert own.count() == 5


def test_tables_and_keys_of_any_case_and_missing_ones(spark, db, tmp_path):
    here = Profile(str(tmp_path / "s"))
    put(spark, here, "item", [(1, 10, 5, "x"), (2, 20, 5, "y")], "PK long, V long, modifiedts long, extra string")
    put(spark, db, "item", [(1, 1, 0)], KIND)
    put(spark, here, "new", [(5, 5, 5)], KIND)
    mark, out = incremental(spark, here, db, tables={"item": ["Pk"], "new": ["pk"]}, markers=spark.createDataFrame([(1, "item", 9)], "p_itempk long, p_table string, modifiedts long"))
    # the target lacks a table, so no deletions in this run
    assert mark == "7" and got(spark, db, "item", "pk", "v") == [(1, 10), (2, 20)] and got(spark, db, "new", "pk") == [(5,)]


def test_merge_statements_of_other_databases():
    one = lambda dialect: merge.merge_statement(dialect, "t", "s", ["k"], ["k", "v"])
    assert one("postgresql") == 'INSERT INTO t ("k", "v") SELECT "k", "v" FROM s ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"'
    assert one("mysql") == "INSERT INTO t (`k`, `v`) SELECT `k`, `v` FROM s ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    assert one("sqlserver").startswith("MERGE INTO t t USING s s ON t.[k] = s.[k] WHEN MATCHED") and one("sqlserver").endswith(";")
    assert merge.merge_statement("postgresql", "t", "s", ["k"], ["k"]).endswith("DO NOTHING")
    assert merge.staging_statement(Profile("jdbc:sqlserver:x"), "s", "t", ["k"]) == "SELECT [k] INTO s FROM t WHERE 1 = 0"
    assert merge.delete_statement(Profile("jdbc:mysql:x"), "t", "s", ["a", "b"]) == "DELETE FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.`a` = t.`a` AND s.`b` = t.`b`)"
    assert markers_query(Profile("jdbc:sqlserver:x"), "t", "k", 10, "d > 1") == "SELECT DISTINCT [k] FROM (SELECT [k], ROW_NUMBER() OVER (ORDER BY [k]) AS rn FROM (SELECT [k] FROM t WHERE [k] IS NOT NULL AND (d > 1)) y) x WHERE (rn - 1) % 10 = 0"


def test_merge_of_files_rewrites_only_touched_ones(spark, tmp_path):
    there = Profile(str(tmp_path / "t"))
    put(spark, there, "item", [(i, i, 0) for i in range(100)] + [(None, 7, 7)], KIND, files=8)
    folder = Folder(spark, there.path("item"))
    before = set(folder.state().files)
    old = spark.createDataFrame([tuple(r) for r in folder.read().collect()], KIND)
    changed, gone = spark.createDataFrame([(3, -3, 1), (4, -4, 1), (500, 5, 5), (None, 1, 1)], KIND), spark.createDataFrame([(99,), (3,), (None,)], "pk long")
    touched = merge.merge_files(there, "item", changed, ["pk"], gone)
    assert 0 < len(touched) < 4 and set(folder.state().files) & before == before - set(touched) and not set(touched) & folder.listed()
    want = merge.upsert(merge.delete_by_key(old, gone, "pk", "pk"), changed, ["pk"])
    assert got(spark, there, "item") == rows(want)
    # a plain reader sees the same
    assert rows(spark.read.parquet(there.path("item"))) == rows(want)


def test_touched_files_of_keys_of_all_kinds(spark, tmp_path):
    there = Profile(str(tmp_path / "t"))
    kinds = "day date, at timestamp, here timestamp_ntz, dec decimal(20,3), name string, real double"
    one = lambda i: (datetime.date(2024, 1, 1) + datetime.timedelta(days=i), datetime.datetime(2024, 1, 1, i), datetime.datetime(2024, 1, 1, i, 30), Decimal(i) / 8, f"é{i:02}", float("nan") if i == 3 else i / 3)
    put(spark, there, "item", [one(i) for i in range(20)], kinds, files=5)
    whole = read_table(spark, there, "item")
    for c in whole.columns:
        keys = whole.filter("day IN ('2024-01-04', '2024-01-05')").select(c)
        assert 1 <= len(merge.touched_files(whole, keys)) <= 2 and merge.touched_files(whole, keys.limit(0)) == []
        assert merge.merge_files(there, "item", keys, [c])
        whole = read_table(spark, there, "item")
    assert whole.count() == 20


def test_a_crash_keeps_the_old_table_and_a_second_writer_fails(spark, tmp_path, monkeypatch):
    there = Profile(str(tmp_path / "t"))
    put(spark, there, "item", [(i, i, 0) for i in range(20)], KIND, files=4)
    merge.overwrite(read_table(spark, there, "item"), there, "item")
    before = got(spark, there, "item")
    changed = spark.createDataFrame([(1, -1, 1)], KIND)
    with monkeypatch.context() as m:
        m.setattr(Folder, "commit", lambda *a, **k: 1 / 0)
        for write in (lambda: merge.merge_files(there, "item", changed, ["pk"]), lambda: merge.overwrite(changed, there, "item"), lambda: merge.append(changed, there, "item", ("run:x", [1]))):
            with pytest.raises(ZeroDivisionError):
                write()
            assert got(spark, there, "item") == before
    folder = Folder(spark, there.path("item"))
    state = folder.state()
    merge.merge_files(there, "item", changed, ["pk"])
    with pytest.raises(RuntimeError, match="changed by another run"):
        folder.commit(state, list(state.files), changed.schema)
    # files that a crash has left are no part of the table
    assert got(spark, there, "item", "pk", "v") == sorted([(i, -1 if i == 1 else i) for i in range(20)], key=repr)


@pytest.mark.parametrize("kind", ["folder", "database", "from database"])
def test_resumed_run_equals_a_whole_one(spark, db, tmp_path, kind):
    here = Profile(str(tmp_path / "s")) if kind != "from database" else db
    there = db if kind == "database" else Profile(str(tmp_path / "t"))
    data = [(i, i * 2, i % 7) for i in range(200)]
    put(spark, here, "item", data, KIND, files=10)
    put(spark, there, "item", [(-1, 0, 0)], KIND)
    put(spark, here, "one", [(1, 1, 1)], KIND)
    calls = []

    def failing(df):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return df

    ledger = Ledger(spark, str(tmp_path / "ledger"))
    copy = lambda **more: jobs.run_resumable(spark, here, there, {"item": ["pk"], "one": ["pk"]}, ledger, "r1", rows=20, size=1, at_once=2, rules={"item": failing}, **more)
    out = dict(copy())
    assert "killed" in out["item"] and out["one"] is None
    assert 0 < len(got(spark, there, "item")) < 200 and ledger.pending("r1").count() > 0
    bounds = rows(ledger.batches("r1"))
    assert rows(ledger.tasks("r1").select("pipelinename", "failure")) == [("item", 1), ("one", 0)]
    made = len(calls)
    out = dict(jobs.run_resumable(spark, here, there, {"item": ["pk"], "one": ["pk"]}, ledger, "r1", rows=7, size=1 << 30, at_once=3, rules={"item": lambda df: (calls.append(1), df)[1]}))
    assert not any(out.values()) and len(calls) - made < 5
    assert got(spark, there, "item") == sorted(data, key=repr) and rows(ledger.batches("r1")) == bounds and ledger.pending("r1").count() == 0
    assert rows(ledger.tasks("r1").select("pipelinename", "failure", "sourcerowcount", "targetrowcount")) == [("item", 0, 200, 200), ("one", 0, 1, 1)]
    jobs.run_resumable(spark, here, there, {"item": ["pk"]}, ledger, "r1")
    assert len(got(spark, there, "item")) == 200


def test_a_batch_that_is_there_but_not_noted_is_not_written_again(spark, tmp_path, monkeypatch):
    here, there, ledger = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")), Ledger(spark, str(tmp_path / "ledger"))
    put(spark, here, "item", [(i, i, 0) for i in range(40)], KIND, files=4)
    copy = lambda: jobs.run_resumable(spark, here, there, {"item": ["pk"]}, ledger, "r", size=1, at_once=1)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "note", lambda *a: 1 / 0)
        assert copy()[0][1]
    assert 0 < len(got(spark, there, "item")) < 40
    assert copy() == [("item", None)] and got(spark, there, "item", "pk") == sorted([(i,) for i in range(40)], key=repr)


def test_resumed_run_spares_excluded_tables(spark, tmp_path):
    here, there = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t"))
    put(spark, here, "item", [(i, i, 0) for i in range(10)], KIND, files=3)
    put(spark, there, "item", [(-1, 0, 0)], KIND)
    for _ in range(2):
        jobs.run_resumable(spark, here, there, {"item": ["pk"]}, Ledger(spark, str(tmp_path / "l")), "r", size=1, excluded=("ITEM",))
    assert got(spark, there, "item", "pk") == sorted([(i,) for i in range(-1, 10)], key=repr)


@pytest.mark.parametrize("kind", ["folder", "database"])
def test_streamed_changes_are_applied_once(spark, db, tmp_path, kind):
    there = Profile(str(tmp_path / "t")) if kind == "folder" else db
    put(spark, there, "item", [(i, i, 0) for i in range(6)], KIND)
    schema = "pk long, v long, modifiedts long, op string"
    at = str(tmp_path / "in")
    put_changes = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(at)
    apply = jobs.apply_changes(there, "item", ["pk"], "modifiedts", "orders", F.col("op") == "REMOVE")
    seen = []

    def twice(df, number):
        """As after a crash between a batch and its checkpoint."""
        seen.append((df.count(), number))
        apply(df, number)
        version = merge.applied(spark, there, "item", "stream:orders")
        before = got(spark, there, "item")
        apply(df.withColumn("v", F.lit(-99).cast("long")), number)
        assert got(spark, there, "item") == before and number in version

    put_changes([(1, 10, 1, "SAVE"), (1, None, 2, "REMOVE"), (2, None, 1, "REMOVE"), (2, 20, 2, "SAVE"), (9, 90, 1, None), (None, 5, 5, "SAVE"), (3, None, 4, "REMOVE"), (3, 33, 4, "SAVE")])
    run = lambda: run_available(spark.readStream.schema(schema).parquet(at), twice, str(tmp_path / "mark")).awaitTermination()
    run()
    run()
    assert got(spark, there, "item", "pk", "v") == sorted([(0, 0), (2, 20), (3, 33), (4, 4), (5, 5), (9, 90)], key=repr)
    put_changes([(9, None, 9, "REMOVE"), (7, 70, 9, "SAVE")])
    run()
    assert got(spark, there, "item", "pk", "v") == sorted([(0, 0), (2, 20), (3, 33), (4, 4), (5, 5), (7, 70)], key=repr) and len(seen) == 2


def test_marker_state_is_bounded_by_the_watermark(spark, tmp_path):
    types = spark.createDataFrame([(5, "orders")], "typecode int, table_name string")
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=n)
    at, schema = str(tmp_path / "in"), "item_pk long, typecode int, change string, ts timestamp"
    seen, states = [], []

    def run(data):
        spark.createDataFrame([(i, 5, "REMOVE", day(h)) for i, h in data], schema).coalesce(1).write.mode("append").parquet(at)
        stream = run_available(capture_deletions(spark.readStream.schema(schema).parquet(at), types, "1 hour"), lambda df, _: seen.extend(r["p_itempk"] for r in df.collect()), str(tmp_path / "mark"))
        stream.awaitTermination()
        states.append([s["numRowsTotal"] for p in stream.recentProgress for s in p["stateOperators"]][-1])

    run([(i, 0) for i in range(50)])
    run([(0, 0.5), (1, 0.5), (100, 0.5)])  # repeats while kept
    assert sorted(seen) == [*range(50), 100]
    run([(200, 10)])
    run([(201, 10), (2, 1)])  # all but the newest are forgotten; one older than the watermark is late
    assert states[1] == 51 and states[-1] <= 3 and sorted(seen)[-2:] == [200, 201] and seen.count(2) == 1
    run([(3, 11)])  # forgotten, so a marker again
    assert seen.count(3) == 2


def test_full_run_counts_while_it_writes(spark, tmp_path):
    here, there, ledger = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")), Ledger(spark, str(tmp_path / "ledger"))
    put(spark, here, "item", [(i, i, 0) for i in range(30)], KIND)
    put(spark, here, "none", [], KIND)
    jobs.run_full(spark, here, there, ["item", "none", "lost"], rules={"item": lambda df: df.filter("pk % 3 = 0")}, ledger=ledger, run="m1")
    task = {r["pipelinename"]: r for r in ledger.tasks("m1").collect()}
    assert (task["item"]["sourcerowcount"], task["item"]["targetrowcount"], task["item"]["truncated"]) == (30, 10, True) and task["item"]["avgwriterrowthroughput"] > 0
    assert task["none"]["targetrowcount"] == 0 and task["lost"]["failure"] == 1 and task["lost"]["duration"] is None
    assert rows(ledger.reconcile("m1")) == rows(spark.createDataFrame([("item", 30, 10, 20), ("none", 0, 0, 0), ("lost", None, None, None)], "p string, s long, t long, d long"))


def test_schema_evolves_in_a_full_run(spark, db, tmp_path):
    here, there, ledger = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")), Ledger(spark, str(tmp_path / "ledger"))
    put(spark, here, "item", [(1, "a", 2.5)], "pk int, name string, more double")
    for target in (there, db):
        put(spark, target, "item", [(9, "z", 9)], "PK long, name string, old long")
    copy = lambda target, switches, **more: dict(jobs.run_full(spark, here, target, ["item"], ledger=ledger, run="m", switches=switches, **more))
    assert not any(copy(there, Switches(add_columns=False)).values())
    assert read_table(spark, there, "item").dtypes == [("PK", "bigint"), ("name", "string"), ("old", "bigint")] and got(spark, there, "item") == [(1, "a", None)]
    assert not any(copy(there, Switches(), truncate=False).values())
    assert read_table(spark, there, "item").columns == ["PK", "name", "old", "more"] and got(spark, there, "item") == [(1, "a", None, 2.5), (1, "a", None, None)]
    assert not any(copy(there, Switches(remove_columns=True)).values())
    assert got(spark, there, "item") == [(1, "a", 2.5)] and read_table(spark, there, "item").columns == ["PK", "name", "more"]
    changes = ledger.schema_changes()
    assert rows(changes.select("column_name", "type", "change")) == [("more", "double", "added"), ("old", "bigint", "removed")]
    assert not any(copy(db, Switches(remove_columns=True)).values())
    assert got(spark, db, "item", "PK", "name", "more") == [(1, "a", 2.5)] and len(read_table(spark, db, "item").columns) == 3
    put(spark, there, "left", [(1,)], "a int")
    assert not any(copy(there, Switches(remove_tables=True)).values()) and not table_exists(spark, there, "left") and table_exists(spark, there, "item")
    assert "none may be added" in dict(jobs.run_full(spark, here, Profile(str(tmp_path / "u")), ["item"], switches=Switches(add_tables=False)))["item"]
    with pytest.raises(ValueError):
        evolved(spark.createDataFrame([(1,)], "a int").schema, spark.createDataFrame([(1,)], "b int").schema, Switches(add_columns=False, remove_columns=True))


def test_a_database_table_is_read_in_ranges_that_it_finds_itself(spark, db):
    put(spark, db, "t", [(i * 3 % 101, str(i)) for i in range(100)] + [(None, "n")], "k long, v string")
    assert [r[0] for r in markers_jdbc(spark, db, "T", "K", 30).collect()] == sorted(i * 3 % 101 for i in range(100))[::30]
    df = read_in_ranges(spark, db, "t", "k", 30)
    assert df.rdd.getNumPartitions() == 4 and rows(df) == rows(read_table(spark, db, "t"))
    assert max(len(p) for p in df.rdd.glom().collect()) <= 31
    with merge.transaction(spark, db) as link:
        merge.run(link, "CREATE TABLE names (\"k\" VARCHAR(20), \"v\" INT)")
    spark.createDataFrame([(f"k'{i:02}", i) for i in range(20)], "k string, v int").write.format("jdbc").options(**db.jdbc_options(), dbtable="names").mode("append").save()
    assert rows(read_in_ranges(spark, db, "names", "k", 6)) == rows(read_table(spark, db, "names"))
    put(spark, db, "bare", [], "k long")
    assert read_in_ranges(spark, db, "bare", "k", 6).count() == 0


def test_partitions_are_found_and_pruned(spark, tmp_path):
    at = str(tmp_path / "p")
    spark.range(60).select("id", F.when(F.col("id") % 6 < 5, F.concat(F.lit("a b/"), (F.col("id") % 6).cast("string"))).alias("part")).write.partitionBy("part").parquet(at)
    found = list_partitions(spark, at, "part")
    assert rows(found) == rows(spark.createDataFrame([(f"a b/{i}",) for i in range(5)] + [(None,)], "part string"))
    whole = spark.read.parquet(at)
    chosen = read_partitions(whole, "part", found.filter("part IN ('a b/1', 'a b/3')"))
    assert rows(chosen) == rows(whole.filter("part IN ('a b/1', 'a b/3')"))
    other = spark.createDataFrame([("a b/1", 5), ("a b/2", 1)], "part string, n int")
    other.write.parquet(str(tmp_path / "o"))
    plan = read_partitions(whole, "part", spark.read.parquet(str(tmp_path / "o")).filter("n > 2"))
    assert "dynamicpruning" in plan._jdf.queryExecution().toString() and plan.count() == 10


def test_listing_of_a_database(spark, db):
    from tablesync.sources.profile import list_tables, list_views, read_catalogue

    put(spark, db, "item", [(1, 2, 3)], KIND)
    with merge.transaction(spark, db) as link:
        merge.run(link, "CREATE VIEW v_item AS SELECT * FROM item")
        merge.run(link, "CREATE TABLE migrationtoolkit_x (a INT)")
    assert rows(list_views(spark, db)) == [("V_ITEM",)]
    names = {r[0] for r in list_tables(read_catalogue(spark, db)).collect()}
    assert {"item", "v_item"} <= names and "migrationtoolkit_x" not in names
    assert {tuple(r) for r in read_catalogue(spark, db).collect()} >= {("ITEM", "pk"), ("ITEM", "v")}
    spark.range(1).createOrReplaceTempView("v_seen")
    assert ("v_seen",) in rows(list_views(spark, Profile("/nowhere")))
    spark.catalog.dropTempView("v_seen")


def test_counts_come_from_footers(spark, tmp_path):
    from tablesync.sources.profile import footer_reader

    spark.range(1000).select("id", (F.col("id") % 3).alias("part")).repartition(4).write.partitionBy("part").parquet(str(tmp_path / "t"))
    own = footer_reader(spark)
    whole = own.read.parquet(str(tmp_path / "t")).agg(F.count("*"), F.min("id"), F.max("id"))
    parts = own.read.parquet(str(tmp_path / "t")).groupBy("part").agg(F.count("*"))
    for df in (whole, parts):
        assert "PushedAggregation: [COUNT(*)" in df._jdf.queryExecution().toString()
    assert rows(whole) == [(1000, 0, 999)] and rows(parts) == [(0, 334), (1, 333), (2, 333)]
    assert "PushedAggregation: [COUNT" not in spark.read.parquet(str(tmp_path / "t")).agg(F.count("*"))._jdf.queryExecution().toString()


def test_lists_of_values_come_from_a_file(spark, tmp_path):
    from tablesync.functions import anonymize as an

    (tmp_path / "lists.json").write_text('{"city": ["Aa", "Bb", "Cc"],\n "street": ["Weg"]}')
    lists = an.load_lists(spark, str(tmp_path / "lists.json"))
    df = spark.range(200).select(F.col("id").alias("pk"), F.lit("x").alias("town"), F.lit("y").alias("way"))
    rules = [an.Rule("town", "REPLACE", "{RANDOM(city)}"), an.Rule("way", "APPEND", " {RANDOM( street )}")]
    new = an.anonymize(df, rules, "t", "pk", "s", lists)
    assert {r[0] for r in new.select("town").distinct().collect()} == {"Aa", "Bb", "Cc"} and rows(new.select("way").distinct()) == [("y Weg",)]
    assert rows(new) == rows(an.anonymize(df, rules, "t", "pk", "s", lists))
    with pytest.raises(ValueError, match="no list"):
        an.anonymize(df, rules, "t", "pk", "s")


def test_views_are_copied_in_batches_between_typed_bounds(spark, tmp_path):
    here, there, ledger = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")), Ledger(spark, str(tmp_path / "l"))
    data = [(datetime.date(2024, 1, 1) + datetime.timedelta(days=i % 37), i) for i in range(120)] + [(None, -1)]
    spark.createDataFrame(data, "day date, v int").createOrReplaceTempView("v_item")
    out = jobs.run_resumable(spark, here, there, {"item": ["day"]}, ledger, "r", rows=15, at_once=2)
    assert out == [("item", None)] and got(spark, there, "item") == sorted(data, key=repr)
    bounds = [tuple(r) for r in ledger.batches("r").orderBy("batchid").select("lowerboundary", "upperboundary").collect()]
    assert len(bounds) == 8 and bounds[0][0] == "2024-01-01" and bounds[-1][1] is None
    spark.catalog.dropTempView("v_item")


def test_many_tables_at_a_time(spark, tmp_path):
    here, there, ledger = Profile(str(tmp_path / "s")), Profile(str(tmp_path / "t")), Ledger(spark, str(tmp_path / "l"))
    names = [f"t{i}" for i in range(6)]
    for i, n in enumerate(names):
        put(spark, here, n, [(k, k, k) for k in range(i)], KIND)
    out = jobs.run_full(spark, here, there, [*names, "lost"], ledger=ledger, run="m", tables_at_once=3)
    assert [t for t, e in out if e] == ["lost"] and [t for t, _ in out] == [*names, "lost"]
    assert rows(ledger.reconcile("m").filter("pipelinename <> 'lost'").select("pipelinename", "target_rows")) == [(n, i) for i, n in enumerate(names)]

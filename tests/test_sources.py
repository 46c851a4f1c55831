import datetime as dt
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import session
from basketry.sources import buckets, increments, manifest, readers, schemas, writers


def test_every_schema_parses(spark):
    for table in schemas.TABLES:
        assert spark.createDataFrame([], schemas.TABLES[table]).columns


def test_landed_copy_reads_a_column_subset(spark, frame, tmp_path):
    writers.store(frame([(1, "b", "s")], schemas.TABLES["brands"]), f"{tmp_path}/brands")
    assert rows(readers.landed(spark, str(tmp_path), "brands", ["name"])) == [("b",)]
    assert rows(readers.landed(spark, str(tmp_path), "brands")) == [(1, "b", "s")]


def test_conform_selects_and_casts(spark, frame):
    raw = frame([("extra", "7", "n", "s")], "x string, id string, name string, slug string")
    assert readers.conform(raw, "brands").dtypes == [("id", "bigint"), ("name", "string"), ("slug", "string")]


def test_delimited_files_with_glob_encoding_and_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("nome;valor\nAção – €;1\n".encode("cp1252"))
    (tmp_path / "b.csv").write_bytes('nome;valor\n"x;y";2\n'.encode("cp1252"))
    got = readers.delimited(spark, f"{tmp_path}/*.csv", "nome string, valor int", sep=";", encoding="windows-1252")
    assert rows(got) == [("Ação – €", 1), ("x;y", 2)]


def test_positional_files_and_web_dates(spark, tmp_path):
    (tmp_path / "events.csv").write_text("20150131,google,cpc,c,17,2\nday,source,m,c,x,y\n")
    got = readers.web_dates(readers.positional(spark, str(tmp_path), schemas.WEB_EVENTS))
    assert rows(got, "date", "source", "customer_id") == [(dt.date(2015, 1, 31), "google", "17"), (None, "source", "x")]


def test_sheet_inline_and_run_day(spark, tmp_path):
    (tmp_path / "states.csv").write_text("state,consider\ndelivered,yes\n")
    assert rows(readers.sheet(spark, f"{tmp_path}/states.csv", "state string, consider string")) == [("delivered", "yes")]
    assert rows(readers.inline(spark, [(1, "a")], "k int, v string")) == [(1, "a")]
    assert rows(readers.run_day(spark, dt.date(2015, 1, 1))) == [(dt.date(2015, 1, 1),)]


def test_snapshot_replaces_only_its_day(spark, frame, tmp_path):
    path = f"{tmp_path}/snap"
    first, second = dt.date(2015, 1, 1), dt.date(2015, 1, 2)
    writers.dated_snapshot(frame([(1,)], "v int"), path, first)
    writers.dated_snapshot(frame([(2,)], "v int"), path, second)
    got = writers.dated_snapshot(frame([(3,), (4,)], "v int"), path, second)
    assert rows(got, "v", "snapshot_date") == [(1, first), (3, second), (4, second)]


def test_history_is_empty_on_the_first_run(spark, tmp_path):
    assert writers.history_or_empty(spark, f"{tmp_path}/none", "order_id long, product_cost double").count() == 0


def test_sorted_export_keeps_its_order_over_part_files(spark, tmp_path):
    path = f"{tmp_path}/out"
    writers.export(spark.range(1000).withColumnRenamed("id", "n"), path, order=["n"])
    read = []
    import glob

    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        read += [int(line) for line in open(part).read().split()[1:]]
    assert read == list(range(1000))


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.shared_folder(Session())


def test_stage_goes_to_the_named_folder(spark):
    staged = session.stage_table(spark.range(3))
    assert staged.inputFiles()[0].startswith("file://" + spark.conf.get("spark.checkpoint.dir"))
    assert staged.count() == 3


def test_source_names_become_declared_names(frame):
    raw = frame([(1, "captured", "delivered", 5, None, "extra")], "id int, `from` string, `to` string, order_id int, created_at timestamp, note string")
    found = readers.conform(raw, "order_transition_logs")
    assert found.columns == ["id", "from_state", "to_state", "order_id", "created_at"]
    assert rows(found, "from_state", "to_state", "order_id") == [("captured", "delivered", 5)]


def test_buckets_are_joined_and_grouped_as_they_lie(spark, frame, tmp_path):
    def stored(name, data):
        return buckets.store_buckets(frame(data, "k long, v int"), f"{tmp_path}/{name}", f"test_{name}", "k", 3)

    left, right = stored("left", [(i, i) for i in range(50)]), stored("right", [(i * 2, i) for i in range(50)])
    joined = left.join(right.groupBy("k").agg(F.sum("v").alias("w")).hint("merge"), "k", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and joined.where("w is not null").count() == 25
    spark.sql("DROP TABLE test_left")
    again = buckets.open_buckets(spark, f"{tmp_path}/left", "test_left", "k long, v int", "k", 3)
    assert rows(again) == rows(left.sparkSession.createDataFrame([(i, i) for i in range(50)], "k long, v int"))
    replaced = stored("right", [(7, 1)])
    assert rows(replaced) == [(7, 1)]


def files_under(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_merge_rewrites_only_touched_buckets(spark, frame, tmp_path):
    schema, path = "id long, state string, updated int", f"{tmp_path}/orders"
    bucket = increments.id_range("id", 10)
    first = [(i, "new", 1) for i in range(40)]
    assert increments.merge_into(frame(first, schema), path, ["id"], "updated", bucket) == [0, 1, 2, 3]
    before = files_under(tmp_path / "orders")
    change = [(35, "paid", 2), (36, "older", 0), (37, "same", 1), (41, "new", 1), (41, "newer", 2)]
    for _ in range(2):  # a repeated run changes nothing
        assert increments.merge_into(frame(change, schema), path, ["id"], "updated", bucket) == [3, 4]
        want = {i: "new" for i in range(40)} | {35: "paid", 37: "same", 41: "newer"}
        assert dict(rows(increments.merged_table(spark, path, schema), "id", "state")) == want
    after = files_under(tmp_path / "orders")
    kept = {p: t for p, t in before.items() if "key_bucket=3" not in str(p)}
    assert kept and all(after.get(p) == t for p, t in kept.items())
    assert not any("key_bucket=3" in str(p) for p in before.keys() & after.keys())
    assert increments.merge_into(frame([], schema), path, ["id"], "updated", bucket) == []
    assert increments.merged_table(spark, f"{tmp_path}/none", schema).count() == 0


def test_unpublished_runs_are_not_read(spark, frame, tmp_path):
    store = manifest.Store(spark, f"{tmp_path}/store")
    assert store.entries() == [] and store.read("k int").count() == 0
    first = store.write(frame([(1,), (2,)], "k int"))
    assert store.read("k int").count() == 0
    store.publish({"data": first})
    store.write(frame([(3,)], "k int"))  # this run breaks here
    assert rows(store.read("k int")) == [(1,), (2,)]
    other = manifest.Store(spark, f"{tmp_path}/store")
    other._numbers = lambda: []  # a build that looked before the first was published
    with pytest.raises(RuntimeError):
        other.publish({"data": first})
    assert rows(store.read("k int")) == [(1,), (2,)]


def test_only_new_files_are_loaded(spark, tmp_path):
    folder, path, schema = tmp_path / "in", f"{tmp_path}/loaded", "a string, b string"
    folder.mkdir()
    loaded = []

    def read(paths):
        loaded.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return readers.delimited(spark, paths, schema, sep=";")

    def load():
        df, n = increments.load_new_files(spark, f"{folder}/*.csv", path, schema, read)
        return rows(df), n

    (folder / "one.csv").write_text("a;b\n1;x\n2;y\n")
    (folder / "two.csv").write_text("a;b\n3;z\n")
    assert load() == ([("1", "x"), ("2", "y"), ("3", "z")], 2)
    assert load() == ([("1", "x"), ("2", "y"), ("3", "z")], 0)
    (folder / "copy of one.csv").write_text("a;b\n1;x\n2;y\n")
    (folder / "three.csv").write_text("a;b\n4;w\n")
    (folder / "empty.csv").write_text("")
    assert load() == ([("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")], 1)
    assert load()[1] == 0 and loaded == [["one.csv", "two.csv"], ["three.csv"]]


def test_staging_removes_its_shuffle_files(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = store.getAllFiles().size()
    staged = session.stage_table(spark.range(1000).repartition(3, "id"))
    for _ in range(100):
        if (left := store.getAllFiles().size()) <= before:
            break
        time.sleep(0.1)
    assert left <= before and staged.count() == 1000

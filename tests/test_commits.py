"""The store of several tables: one commit for all, snapshots, repeats, races, removal."""

import re
import threading

import pytest
from pyspark.sql import functions as F

from rollcall.operators import commits, review

ITEMS = {"a": commits.Table("k string, d string", ["k"], 4),
         "b": commits.Table("k string, n long", ["k"], 2)}


@pytest.fixture
def store(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    commits.create(spark, path, ITEMS)
    return path


def rows(spark, store, name="a", version=None):
    snap = commits.snapshot(spark, store, version)
    return sorted(tuple(r) for r in commits.read(spark, snap, name).collect())


def change(spark, values, schema="k string, d string, seq int"):
    return spark.createDataFrame(values, schema)


def test_tables_change_together_and_snapshots_stay(spark, store):
    commits.load(spark, store, {"a": change(spark, [("x", "old"), ("y", "old")], "k string, d string")})
    before = commits.snapshot(spark, store)
    held = commits.read(spark, before, "a")
    commits.commit(spark, store, {
        "a": change(spark, [("x", "first", 1), ("x", "new", 2), ("z", "new", 1)]),
        "b": change(spark, [("x", 5, 1)], "k string, n long, seq int")})
    assert rows(spark, store) == [("x", "new"), ("y", "old"), ("z", "new")]
    assert rows(spark, store, "b") == [("x", 5)]
    assert sorted(map(tuple, held.collect())) == [("x", "old"), ("y", "old")]
    assert rows(spark, store, "b", before.version) == []
    commits.compact(spark, store)
    assert rows(spark, store) == [("x", "new"), ("y", "old"), ("z", "new")]
    assert commits.snapshot(spark, store).tables["a"].changes == []


def test_create_again_keeps_everything(spark, store):
    commits.commit(spark, store, {"a": change(spark, [("x", "v", 1)])})
    version = commits.snapshot(spark, store).version
    assert commits.create(spark, store, ITEMS).version == version
    commits.create(spark, store, {**ITEMS, "c": ITEMS["a"]})
    assert rows(spark, store) == [("x", "v")] and rows(spark, store, "c") == []


def test_a_repeated_commit_does_nothing(spark, store):
    for value in ("once", "again"):
        commits.commit(spark, store, {"a": change(spark, [("x", value, 1)])}, writer="w", number=3)
    assert rows(spark, store) == [("x", "once")]
    assert commits.snapshot(spark, store).writers == {"w": 3}
    commits.commit(spark, store, {"a": change(spark, [("x", "older", 1)])}, writer="w", number=2)
    assert rows(spark, store) == [("x", "once")]


def test_a_commit_based_on_an_old_snapshot_is_refused(spark, store):
    old = commits.snapshot(spark, store)
    commits.commit(spark, store, {"a": change(spark, [("x", "v", 1)])})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, store, {"a": change(spark, [("x", "w", 1)])}, based_on=old)
    assert rows(spark, store) == [("x", "v")]


def test_writers_at_once_lose_nothing(spark, store):
    def write(i):
        commits.commit(spark, store, {"a": change(spark, [(f"k{i}", "v", 1)])})

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [k for k, _ in rows(spark, store)] == [f"k{i}" for i in range(6)]
    assert commits.snapshot(spark, store).version == 6


def test_a_commit_that_fails_shows_nothing(spark, store):
    bad = change(spark, [("x", "v", 1)]).withColumn("d", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        commits.commit(spark, store, {"b": change(spark, [("x", 1, 1)], "k string, n long, seq int"),
                                      "a": bad})
    assert rows(spark, store, "b") == [] and commits.snapshot(spark, store).version == 0


def test_removed_keys_and_keys_that_come_back(spark, store):
    commits.load(spark, store, {"a": change(spark, [("x", "1"), ("y", "1")], "k string, d string")})
    gone = change(spark, [("x", None, 1, True)], "k string, d string, seq int, _gone boolean")
    commits.commit(spark, store, {"a": gone})
    assert rows(spark, store) == [("y", "1")]
    commits.commit(spark, store, {"a": change(spark, [("x", "2", 1)])})
    assert rows(spark, store) == [("x", "2"), ("y", "1")]


def test_vacuum_keeps_what_versions_need(spark, store):
    for i in range(4):
        commits.commit(spark, store, {"a": change(spark, [("x", str(i), 1)])})
    commits.compact(spark, store)
    assert commits.vacuum(spark, store, keep=1) == []                # too young
    assert len(commits.vacuum(spark, store, keep=1, hours=0)) == 4
    assert rows(spark, store) == [("x", "3")]
    with pytest.raises(Exception):
        commits.snapshot(spark, store, 2)


def test_the_base_is_read_without_a_shuffle(spark, store):
    commits.load(spark, store, {"a": spark.range(1000).select(
        F.col("id").cast("string").alias("k"), F.lit("v").alias("d"))})
    commits.commit(spark, store, {"a": change(spark, [("5", "n", 1)])})
    found = commits.read(spark, commits.snapshot(spark, store), "a")
    plan = found._jdf.queryExecution().executedPlan().toString()
    left = re.search(r"ShuffledHashJoin .*?LeftAnti.*?\n(.*?)\n[^\n]*HashAggregate", plan, re.S)[1]
    assert "Bucketed: true" in left and "Exchange" not in left and "Sort" not in left
    assert "SortMergeJoin" not in plan
    assert found.count() == 1000


def test_approvals_that_fit_nothing_are_left_over(spark, tmp_path):
    path = f"file://{tmp_path}/review"
    review.create_store(spark, path, buckets=2)
    raw = spark.createDataFrame([("raw", "emails", "t", "a@x.io", "{}", 1)],
                                "tier string, entity string, tenant string, record_key string, "
                                "data string, seq int").withColumn(
        "updated_at", F.timestamp_seconds(F.lit(0)))
    commits.commit(spark, path, {"records": raw})
    asked = spark.createDataFrame(
        [("emails", "t", "a@x.io", None, 1), ("emails", "t", "b@x.io", None, 2),
         ("emails", "t", "c@x.io", '{"new":1}', 3), ("secrets", "t", "k", "{}", 4)],
        "entity string, tenant string, record_key string, edited_data string, seq int")
    left = review.approve_in_store(spark, path, asked, F.timestamp_seconds(F.lit(1)))
    assert sorted(r.record_key for r in left.collect()) == ["b@x.io", "k"]
    snap = commits.snapshot(spark, path)
    got = commits.read(spark, snap, "records").where("tier = 'reviewed'").collect()
    assert sorted((r.record_key, r.data) for r in got) == [("a@x.io", "{}"), ("c@x.io", '{"new":1}')]
    status = commits.read(spark, snap, "review_status").collect()
    assert sorted((r.record_key, r.status) for r in status) == [
        ("a@x.io", "approved"), ("c@x.io", "approved")]


def test_ordered_tables_ignore_late_and_repeated_rows(spark, tmp_path):
    path = f"file://{tmp_path}/ordered"
    commits.create(spark, path, {"a": commits.Table("k string, d string, seq int", ["k"], 4, order="seq")})
    commits.load(spark, path, {"a": change(spark, [("x", "base", 5), ("y", "base", 5)])})
    for values in ([("x", "late", 3), ("y", "new", 7), ("z", "one", 4)], [("z", "late", 2), ("x", "newer", 6)],
                   [("y", "again", 6), ("z", "two", 9), ("z", "same", 8)]):
        commits.commit(spark, path, {"a": change(spark, values)})
    want = [("x", "newer", 6), ("y", "new", 7), ("z", "two", 9)]
    assert rows(spark, path) == want
    commits.compact(spark, path)
    assert rows(spark, path) == want


def test_stream_commits_equal_the_batch(spark, tmp_path):
    from rollcall.streaming import upserts

    path, schema = f"file://{tmp_path}/store", "k string, d string, seq int"
    values = [(f"k{i % 7}", f"v{i}", i) for i in range(60)]
    for turn in range(2):                                # every file comes twice
        spark.createDataFrame(values, schema).repartition(6).write.mode("append").parquet(f"{tmp_path}/in")
    commits.create(spark, path, {"a": commits.Table(schema, ["k"], 2, order="seq")})
    for _ in range(2):                                   # the second run finds nothing new
        upserts.stream_commits(
            upserts.observation_stream(spark, f"{tmp_path}/in", schema, 3), path, "a",
            f"{tmp_path}/checkpoint", "stream").awaitTermination()
    last = {k: (k, d, s) for k, d, s in values}
    assert rows(spark, path) == sorted(last.values())
    assert commits.snapshot(spark, path).writers["stream"] == 3

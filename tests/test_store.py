"""Commits with a conflict check, the append-only run log, staging folders."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from campfin.operators.history import decide_mode
from campfin.operators.lookup import written
from campfin.plans import runs, tables
from campfin.plans.feeds import full_feed, write_feed
from campfin.plans.standins import build
from campfin.plans.tables import CommitConflict, EmptyCommit, TableStore
from campfin.session import shared_dir

META = "cm_id long, contribSum decimal(24,2), contribCount long"


def facts(spark, rows):
    df = spark.createDataFrame(rows, "sub_id long, y2 string")
    return df.select(F.col("sub_id").cast("decimal(19,0)").alias("sub_id"), "y2")


def ids(store):
    return sorted(int(r["sub_id"]) for r in store.read("indiv").collect())


def meta(spark, *ids):
    return spark.createDataFrame([(i, None, 1) for i in ids], META)


def test_writers_of_different_cycles_keep_each_others_rows(spark):
    store, other = TableStore(spark), None
    store.publish("indiv", facts(spark, [(1, "10"), (2, "12"), (3, "14")]))
    base = store.manifest("indiv")[0]
    other = TableStore(spark, store.root)
    other.publish("indiv", facts(spark, [(20, "12")]), ["12"], base=base)
    store.publish("indiv", facts(spark, [(10, "10")]), ["10"], base=base)   # built from the same version
    assert ids(store) == [3, 10, 20] and store.versions("indiv") == [1, 2, 3]


def test_writers_of_one_cycle_conflict_and_update_makes_the_change_again(spark):
    store = TableStore(spark)
    store.publish("indiv", facts(spark, [(1, "10")]))
    base = store.manifest("indiv")[0]
    store.publish("indiv", facts(spark, [(1, "10"), (2, "10")]), ["10"], base=base)
    with pytest.raises(CommitConflict):
        store.publish("indiv", facts(spark, [(1, "10"), (3, "10")]), ["10"], base=base)
    assert ids(store) == [1, 2] and not store.unreferenced("indiv")   # the loser's rows are removed
    seen = []

    def change(rows):
        if not seen:   # another writer comes first, once
            store.publish("indiv", facts(spark, [(1, "10"), (2, "10"), (4, "10")]), ["10"])
        seen.append(rows.count())
        return rows.unionByName(facts(spark, [(3, "10")]), allowMissingColumns=True), ["10"]

    store.update("indiv", change)
    assert seen == [2, 3] and ids(store) == [1, 2, 3, 4]


def test_concurrent_updates_lose_nothing(spark):
    store = TableStore(spark)
    store.publish("cmMeta", meta(spark, 0))

    def add(i):
        mine = TableStore(spark, store.root)
        mine.update("cmMeta", lambda rows: (rows.unionByName(meta(spark, i)), None))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(1, 5)))
    assert sorted(r["cm_id"] for r in store.read("cmMeta").collect()) == [0, 1, 2, 3, 4]


def test_whole_table_conflict_and_blind_rebuild(spark):
    store = TableStore(spark)
    store.publish("cmMeta", meta(spark, 1))
    store.publish("cmMeta", meta(spark, 1, 2))
    with pytest.raises(CommitConflict):
        store.publish("cmMeta", meta(spark, 1, 3), base=1)
    store.publish("cmMeta", meta(spark, 9), base=1, blind=True)   # rows that don't come from the table
    assert [r["cm_id"] for r in store.read("cmMeta").collect()] == [9]


def test_an_empty_commit_is_refused(spark):
    store = TableStore(spark)
    none = facts(spark, [(1, "10")]).where("sub_id < 0")
    store.publish("indiv", none)                       # a first, empty version
    store.publish("indiv", facts(spark, [(1, "10")]))
    with pytest.raises(EmptyCommit):
        store.publish("indiv", none)
    assert ids(store) == [1] and not store.unreferenced("indiv")
    store.publish("indiv", none, replace_cycles=["10"])   # a named cycle may go
    assert ids(store) == []
    store.publish("indiv", facts(spark, [(1, "10")]))
    store.publish("indiv", none, allow_empty=True)
    assert ids(store) == []


def test_a_bare_root_is_where_spark_writes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "bare"))
    assert store.root.startswith("file:/")
    store.publish("indiv", facts(spark, [(1, "10")]))
    assert ids(TableStore(spark, str(tmp_path / "bare"))) == [1]


def test_rows_that_no_listing_shows_are_no_commit(spark, monkeypatch):
    store = TableStore(spark)
    monkeypatch.setattr(store.files, "folders", lambda path: [])
    with pytest.raises(RuntimeError, match="1 rows were written"):
        store.publish("indiv", facts(spark, [(1, "10")]))


def test_a_note_is_one_file_and_ids_are_claimed(spark):
    store = TableStore(spark)
    assert store.read("UpdateHistory").count() == 0 and decide_mode(store.read("UpdateHistory")) == "full"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: TableStore(spark, store.root).append_event("b", f"n{i}"), range(24)))
    assert sorted(got) == list(range(1, 25))
    folder = f"{store.root}/UpdateHistory/events".replace("file:", "", 1)
    before = {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}
    store.append_event("s", "done", 'long "text"\nwith lines', F.lit("2012-08-20 12:00:00.123456").cast("timestamp"))
    after = {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}
    assert len(after) == len(before) + 1 and all(after[f] == t for f, t in before.items())
    last = store.read("UpdateHistory").orderBy(F.col("id").desc()).first()
    assert (last["id"], last["eventType"], last["longMessage"]) == (25, "s", 'long "text"\nwith lines')
    assert str(last["date"]) == "2012-08-20 12:00:00.123456"


def test_a_keyed_note_is_written_once(spark):
    store = TableStore(spark)
    a = store.append_event("s", "batch", key="q#1")
    assert store.append_event("s", "batch", key="q#1") == a
    assert store.append_event("s", "batch", key="q#2") == a + 1
    assert store.read("UpdateHistory").count() == 2


def test_staging_goes_with_its_run_also_after_a_failure(spark):
    store = TableStore(spark)
    kept = "data"
    with store.staging("one") as st:
        spark.range(3).write.parquet(st.path("bronze"))
        store.publish("cmMeta", meta(spark, 1))
        spark.range(1).write.parquet(f"{store.root}/cmMeta/{kept}/one-died")    # never committed
        spark.range(1).write.parquet(f"{store.root}/cmMeta/{kept}/two-alive")   # another run's
    assert store.files.folders(f"{store.root}/_staging") == []
    left = store.files.folders(f"{store.root}/cmMeta/{kept}")
    assert len(left) == 2 and "two-alive" in left and "one-died" not in left
    with pytest.raises(ZeroDivisionError), store.staging("three") as st:
        spark.range(3).write.parquet(st.path("bronze"))
        1 / 0
    assert store.files.folders(f"{store.root}/_staging") == []
    assert [r["cm_id"] for r in store.read("cmMeta").collect()] == [1]


def test_intermediate_tables_are_staging_too(spark):
    store = TableStore(spark)
    with store.staging() as st:
        inside = written(spark.range(3), "lookup")
        assert inside.inputFiles()[0].startswith(st.path("scratch").replace("file:/", "file:///", 1))
    assert store.files.folders(f"{store.root}/_staging") == []
    outside = written(spark.range(3), "lookup")
    assert "_staging" not in outside.inputFiles()[0] and outside.count() == 3


def test_a_run_leaves_no_scratch(spark):
    s = build(spark, "/root/testdata/sf0.001")
    feed = write_feed(spark, full_feed(s))
    work = f"{shared_dir(spark)}/campfin-work"
    store = TableStore(spark)
    before = set(store.files.folders(work))
    result = runs.run(spark, store, feed, mode="full")
    assert result.report.count() > 10 and result.repairs.count() > 10
    assert set(store.files.folders(work)) == before | {store.root.rsplit("/", 1)[1]}
    assert store.files.folders(f"{store.root}/_staging") == []


def test_a_failed_run_leaves_no_folder(spark, tmp_path):
    import zipfile
    os.makedirs(tmp_path / "feed" / "2012")
    with zipfile.ZipFile(tmp_path / "feed" / "2012" / "cn12.zip", "w") as zf:
        zf.writestr("cn.txt", "H1|A|REP|2012\n")
    with open(tmp_path / "feed" / "2012" / "indiv12.zip", "wb") as fh:
        fh.write(b"broken")
    store = TableStore(spark)
    with pytest.raises(Exception, match="not a zip"):
        runs.run(spark, store, f"file:{tmp_path}/feed", mode="full")
    assert store.files.folders(f"{store.root}/_staging") == []
    assert [r["eventType"] for r in store.read("UpdateHistory").orderBy("id").collect()] == ["b", "f"]


def test_vacuum_removes_old_leftovers_and_versions(spark):
    store = TableStore(spark)
    for i in range(4):
        store.publish("cmMeta", meta(spark, i))
    spark.range(1).write.parquet(f"{store.root}/cmMeta/data/x-left")
    spark.range(1).write.parquet(f"{store.root}/_staging/dead/bronze")
    assert store.vacuum(hours=1) == []                      # too young
    gone = store.vacuum(hours=0)
    assert sorted(p.rsplit("/", 1)[1] for p in gone) == ["dead", "x-left"]
    store.vacuum(hours=0, keep=2)
    assert store.versions("cmMeta") == [3, 4]
    assert len(store.files.folders(f"{store.root}/cmMeta/data")) == 2
    store.publish("cmMeta", meta(spark, 8))
    assert store.versions("cmMeta") == [3, 4, 5]


def test_exclusive_create_has_one_winner(spark, tmp_path):
    files = TableStore(spark, str(tmp_path)).files
    path, won, gate = f"file:{tmp_path}/claim", [], threading.Barrier(6)

    def claim(i):
        gate.wait()
        if files.create(path, str(i).encode()):
            won.append(i)

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and files.read(path) == str(won[0]).encode()
    assert os.listdir(tmp_path) == ["claim"]


def test_retries_end(spark, monkeypatch):
    store = TableStore(spark)
    store.publish("cmMeta", meta(spark, 1))
    monkeypatch.setattr(tables, "RETRIES", 2)
    monkeypatch.setattr(store.files, "create", lambda path, data: False)
    monkeypatch.setattr(store, "_wait_for", lambda name, version: None)
    with pytest.raises(CommitConflict):
        store.publish("cmMeta", meta(spark, 2))

"""The tagged change set against a row-by-row walk; deliveries in any order."""

import os
import random
from decimal import Decimal

from pyspark.sql import functions as F

from campfin.operators import facts as fx
from campfin.plans import runs
from campfin.plans.feeds import full_feed, incremental_feed, write_feed
from campfin.plans.standins import build
from campfin.plans.tables import TableStore
from campfin.session import scratch_path
from campfin.streaming import increments

SF = "/root/testdata/sf0.001"


def walk(base, deletes, adds, chgs):
    """The reference order, a row at a time: (final rows, counts)."""
    rows = dict(base)
    counts = dict.fromkeys(("deleted", "added", "changed"), 0)
    for k in set(deletes):
        counts["deleted"] += rows.pop(k, None) is not None
    start = set(rows)
    for name, lines in (("added", adds), ("changed", chgs)):
        for k, y2 in lines:
            counts[name] += 1 + (k in rows)
            rows[k] = y2
    named = {k for k, _ in adds + chgs}
    counts["inserted"], counts["replaced"] = len(named - start), len(named & start)
    return rows, counts


def test_counts_and_cycles_equal_the_walk(spark):
    rnd = random.Random(5)
    for _ in range(6):
        cycles = ["96", "98", "00"]
        base = {k: rnd.choice(cycles) for k in range(1, 60) if rnd.random() < 0.7}
        pick = lambda n: [(rnd.randint(1, 80), rnd.choice(cycles)) for _ in range(n)]
        deletes, adds, chgs = [k for k, _ in pick(12)], pick(15), pick(15)
        lines = ([(k, "delete", "98") for k in deletes] + [(k, "add", y) for k, y in adds]
                 + [(k, "chg", y) for k, y in chgs] + [(0, "add", "98"), (3, "other", "98")])
        actions = spark.createDataFrame([(Decimal(k), a, y, i) for i, (k, a, y) in enumerate(lines)],
                                        "sub_id decimal(19,0), kind string, y2 string, o long")
        prod = spark.createDataFrame([(Decimal(k), y) for k, y in base.items()], "sub_id decimal(19,0), y2 string")
        met = fx.meet_base(fx.tag_changes(actions, "o"), prod)
        final, counts = walk(base, deletes, adds, chgs)
        assert {m.split()[1]: v for m, v in fx.change_counts(met).collect()} == counts
        touched = {base[k] for k in set(deletes) | {k for k, _ in adds + chgs} if k in base}
        touched |= {final[k] for k, _ in adds + chgs}
        assert fx.touched_cycles(met) == sorted(touched)
        staged = actions.where("sub_id != 0")
        rows = None
        for kind in ("add", "chg"):
            part = fx.winners(staged.where(F.col("kind") == kind), met, kind, "o").select("sub_id", "y2")
            rows = part if rows is None else rows.unionByName(part)
        got = {int(r["sub_id"]): r["y2"] for r in fx.rewritten(prod, met, rows).collect()}
        assert got == final


def test_the_base_keys_are_scanned_once(spark):
    """What meets the base, counts and cycles together read its keys once."""
    path = scratch_path(spark, "base-keys")
    spark.range(100).selectExpr("cast(id as decimal(19,0)) sub_id", "'98' y2", "id v").write.parquet(path)
    base = spark.read.parquet(path)
    actions = spark.createDataFrame([(Decimal(5), "chg", "98", 1)], "sub_id decimal(19,0), kind string, y2 string, o long")
    met = fx.meet_base(fx.tag_changes(actions, "o"), base)
    plans = [d._jdf.queryExecution().executedPlan().toString()
             for d in (met, fx.change_counts(met), fx.winners(actions, met, "chg", "o"))]
    assert not any(path.rsplit("/", 1)[1] in p for p in plans)
    rewrite = fx.rewritten(base, met, base.limit(0))._jdf.queryExecution().executedPlan().toString()
    assert rewrite.count(f"{path.rsplit('/', 1)[1]}") <= 2   # the kept rows, and the empty frame of this test


def _indiv(store):
    return sorted((int(r["sub_id"]), str(r["transaction_amt"]), r["cm_id"], r["y2"])
                  for r in store.read("indiv").collect())


def test_one_file_per_batch_in_reverse_order_equals_the_run(spark):
    s = build(spark, SF)
    prev = write_feed(spark, full_feed(s, s.prev_indiv_src()))
    changes = write_feed(spark, incremental_feed(s))
    whole, split = TableStore(spark), TableStore(spark)
    for store in (whole, split):
        runs.run(spark, store, prev, mode="full")
    report = dict(runs.run(spark, whole, changes, mode="incremental").report.collect())
    assert report["indiv deleted"] > 0 and report["indiv replaced"] > 0

    bronze = scratch_path(spark, "bronze-reverse")
    runs.land(spark, changes, "incremental").where(F.col("kind").isin(*fx.ACTIONS)).repartition(
        2, "line_no").write.partitionBy("kind").parquet(f"{bronze}/delivery=1")
    root = bronze.replace("file:", "", 1)
    files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    rank = {"delete": 2, "add": 1, "chg": 0}
    files.sort(key=lambda f: rank[f.split("kind=")[1].split("/")[0]])
    assert len(files) == 6
    for i, f in enumerate(files):
        os.utime(f, (1_600_000_000 + 100 * i,) * 2)
    q = increments.start(spark, split, bronze, max_files=1)
    q.awaitTermination(900)
    assert q.exception() is None
    assert _indiv(split) == _indiv(whole)
    log = [r["longMessage"] for r in split.read("UpdateHistory").orderBy("id").collect()][2:]
    assert len(log) == 6 and "indiv deleted: 0" in log[0] and "indiv replaced: 0" in log[-1]

    # A batch that is replayed (its checkpoint lost the commit) changes nothing and logs nothing.
    lines = spark.read.schema(runs.BRONZE_SCHEMA + ", delivery long").parquet(bronze)
    replay = increments.apply_batch(split, "again")
    replay(lines, 0)
    replay(lines, 0)
    assert _indiv(split) == _indiv(whole)
    assert split.read("UpdateHistory").count() == 2 + 6 + 1


def test_a_later_delivery_has_the_last_word(spark):
    s = build(spark, SF)
    store = TableStore(spark)
    runs.run(spark, store, write_feed(spark, full_feed(s)), mode="full")
    key, cycle = store.read("indiv").select("sub_id", "y2").first()
    bronze = scratch_path(spark, "bronze-later")

    def line(kind, delivery):
        spark.createDataFrame([("p", "e", 1, str(key), 0, 0, cycle)], "path string, entry string, line_no long, "
                              "value string, replaced int, file_no int, y2 string").write.parquet(
            f"{bronze}/delivery={delivery}/kind={kind}")

    checkpoint = scratch_path(spark, "later-checkpoint")
    line("delete", 2)
    increments.start(spark, store, bronze, checkpoint).awaitTermination(300)
    assert store.read("indiv").where(F.col("sub_id") == key).count() == 0
    full = "|".join(["C00000001", "N", "Q1", "P", "1", "15", "IND", "N", "C", "NY", "1", "E", "O", "04121998",
                     "5.00", "", "T", "1", "", "", str(key)])
    spark.createDataFrame([("p", "e", 1, full, 0, 0, cycle)], "path string, entry string, line_no long, "
                          "value string, replaced int, file_no int, y2 string").write.parquet(f"{bronze}/delivery=1/kind=add")
    increments.start(spark, store, bronze, checkpoint).awaitTermination(300)   # an older delivery, late
    assert increments.applied(store, 0).count() == 1
    got = store.read("indiv").where(F.col("sub_id") == key).count()
    assert got == 0

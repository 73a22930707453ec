"""Heavy keys are measured and split alone; keys that match nothing don't
travel; duplicates are found before the lookups; id plans don't grow."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campfin.operators import facts as fx
from campfin.operators.dedupe import keep_first, keep_first_counted
from campfin.operators.ids import assign_ids
from campfin.operators.lookup import Lookup, heavy_keys, lookup


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _facts(spark):
    """Two thirds have an empty key, a fifth one hot key, some no key at all."""
    return spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 < 2, "").when(F.col("id") % 15 < 9, "HOT")
        .when(F.col("id") % 30 == 14, None).otherwise(F.concat(F.lit("K"), F.col("id") % 40)).alias("key"))


def _table(spark, extra=()):
    return spark.createDataFrame([("HOT", 1)] + [(f"K{i}", 100 + i) for i in range(40)] + list(extra), "key string, v int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("extra", [(), (("", 7),)])
def test_split_join_equals_broadcast(spark, how, extra):
    facts, take = _facts(spark), {"out": "v"} if how in ("left", "inner") else {}
    plain, split = (lookup(facts, Lookup.of(_table(spark, extra), max_rows=m), [("key", "key")], take, how, ["id"])
                    for m in (10_000, 0))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)


def test_only_heavy_keys_are_copied(spark):
    facts = _facts(spark).where("key != ''")
    assert len(heavy_keys(facts, [("key",)], share=0.3)["key",]) == 1
    both = heavy_keys(facts.withColumn("one", F.lit(1)), [("one",), ("key", "one")], share=0.3)
    assert len(both["one",]) == 1 and len(both["key", "one"]) == 1
    table = Lookup.of(_table(spark), max_rows=0, salt_buckets=8)
    joined = lookup(facts, table, [("key", "key")], {"out": "v"}, salt_cols=["id"])
    hot = F.xxhash64(F.struct(F.lit("HOT")))
    copies = table.df.select(F.explode(F.when(F.xxhash64(F.struct("key")) == hot, F.sequence(F.lit(0), F.lit(7)))
                                       .otherwise(F.array(F.lit(0)))))
    assert copies.count() == 40 + 8 and joined.where("key = 'HOT' and out = 1").count() > 400


def test_empty_and_missing_keys_pass_beside_the_join(spark):
    facts = _facts(spark)
    table = Lookup.of(_table(spark), max_rows=0)
    assert "key" in table.never_empty
    out = lookup(facts, table, [("key", "key")], {"out": "v"}, salt_cols=["id"])
    assert "Union" in _plan(out) and out.count() == 3000
    assert out.where("key = '' and out is null").count() == 2000
    # where the lookup holds an empty key those rows do join
    withempty = Lookup.of(_table(spark, [("", 7)]), max_rows=0)
    out = lookup(facts, withempty, [("key", "key")], {"out": "v"}, salt_cols=["id"])
    assert out.where("key = '' and out = 7").count() == 2000


def test_resolving_measures_heavy_keys_in_one_pass(spark, monkeypatch):
    staged = spark.createDataFrame([("12", "C1", ["C1", "S1", "", None][i % 4], "S1", "04122012", Decimal(1), Decimal(i + 1))
                                    for i in range(40)], "y2 string, cmte_id string, other_id string, cand_id string, "
                                   "transaction_dt string, transaction_amt decimal(14,2), sub_id decimal(19,0)")
    dims = [spark.createDataFrame([("12", f"{p}{i}", i) for i in range(5)], f"y2 string, {k} string, id long")
            for p, k in (("C", "cm_id"), ("S", "cn_id"))]
    calls, real = [], fx.heavy_keys
    monkeypatch.setattr(fx, "heavy_keys", lambda df, keys: calls.append(keys) or real(df, keys))
    plain, split = (sorted(map(str, fx.resolve(staged, *[Lookup.of(d, max_rows=m) for d in dims], "pas2").collect()))
                    for m in (100, 0))
    assert plain == split and calls == [[("cand_id", "y2"), ("cmte_id", "y2"), ("other_id", "y2")]]


def test_the_bound_is_in_bytes_too(spark):
    wide = spark.range(100).select(F.col("id").cast("string").alias("key"), F.repeat(F.lit("x"), 1000).alias("v"))
    spark.conf.set("campfin.broadcast.maxBytes", "50000")
    try:
        assert not Lookup.of(wide).broadcast and Lookup.of(wide.drop("v")).broadcast
        assert not Lookup.of(wide, rows=10_000).broadcast
    finally:
        spark.conf.unset("campfin.broadcast.maxBytes")


def test_without_duplicates_no_join_is_planned(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.col("id").alias("o"))
    kept, dropped = keep_first_counted(df, ["k"], "o")
    assert "Join" not in _plan(kept) and dropped.first()["dropped"] == 0 and kept.count() == 500


def test_no_lookup_below_the_duplicate_pass(spark):
    """Rows are resolved after duplicates are gone: the pass reads staged rows."""
    staged = spark.createDataFrame([("12", "C1", "", "", "04122012", Decimal(1), Decimal(i // 2), i) for i in range(2, 9)],
                                   "y2 string, cmte_id string, other_id string, cand_id string, transaction_dt string, "
                                   "transaction_amt decimal(14,2), sub_id decimal(19,0), k long")
    cm = Lookup.of(spark.createDataFrame([("12", "C1", 1)], "y2 string, cm_id string, id long"))
    cn = Lookup.of(spark.createDataFrame([("12", "S1", 1)], "y2 string, cn_id string, id long"))
    rows, dropped = keep_first_counted(staged, ["sub_id"], "k")
    out = fx.resolve(rows, cm, cn)
    assert dropped.first()["dropped"] == 3 and out.count() == 4
    assert _plan(out).count("BroadcastHashJoin") == 4   # three ids, one duplicate filter


@pytest.mark.parametrize("max_rows", [None, "0"])
def test_a_delivery_loaded_twice(spark, max_rows):
    if max_rows:
        spark.conf.set("campfin.broadcast.maxRows", max_rows)
    try:
        once = spark.range(2000).select((F.col("id") * 7).alias("k"), F.col("id").alias("o"), F.lit("a").alias("v"))
        twice = once.unionByName(once.withColumn("o", F.col("o") + 10_000).withColumn("v", F.lit("b")))
        got = keep_first(twice, ["k"], "o")
        assert got.count() == 2000 and got.where("v = 'b'").count() == 0
    finally:
        if max_rows:
            spark.conf.unset("campfin.broadcast.maxRows")


def test_id_plan_does_not_grow_with_partitions(spark):
    df = spark.range(300).select(F.lit("12").alias("y2"), F.format_string("C%05d", "id").alias("cm_id"))
    sizes = [len(_plan(assign_ids(df, ["y2", "cm_id"], num_partitions=n))) for n in (2, 200)]
    assert abs(sizes[0] - sizes[1]) < 200

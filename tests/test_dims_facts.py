from decimal import Decimal

from pyspark.sql import functions as F

from campfin.operators import facts as fx
from campfin.operators.dims import refresh_dim
from campfin.operators.lookup import Lookup
from campfin.schemas import CN_SCHEMA

DIM = "id long, y2 string, cn_id string, name string, party string"
STAGED = "y2 string, cn_id string, name string, party string, _order long"


def test_dimension_refresh_cases(spark):
    prod = spark.createDataFrame([
        (1, "12", "H1", "Ann", "DEM"),     # E7: city-like change in name -> updated, id kept
        (2, "12", "H2", "Bob", None),      # E8: NULL vs value -> not updated
        (3, "12", "H3", "Cy", "REP"),      # E9: absent from staging -> kept
        (4, "10", "H1", "Ann", "DEM"),     # E10: same FEC id, other cycle
    ], DIM)
    staged = spark.createDataFrame([
        ("12", "H1", "Anne", "DEM", 1),
        ("12", "H2", "Bob", "REP", 2),
        ("12", "H4", "Dee", "IND", 3),     # new
        ("12", "H4", "Dee2", "IND", 4),    # E11: duplicate key, first line wins
        ("10", "H1", "Ann", "DEM", 5),     # unchanged
    ], STAGED)
    r = refresh_dim(prod, staged, "cn_id", ["name", "party"], order="_order")
    got = sorted(tuple(x) for x in r.table.collect())
    assert got == [(1, "12", "H1", "Anne", "DEM"), (2, "12", "H2", "Bob", None),
                   (3, "12", "H3", "Cy", "REP"), (4, "10", "H1", "Ann", "DEM"),
                   (5, "12", "H4", "Dee", "IND")]
    counts = dict((m, v) for m, v in r.counts().collect())
    assert counts == {"matched": 3, "updated": 1, "inserted": 1}
    assert dict(r.written_counts()) == counts   # seen while the table was collected
    # Rerun with the same staging: nothing changes, ids stable.
    again = refresh_dim(r.table, staged, "cn_id", ["name", "party"], order="_order")
    assert sorted(tuple(x) for x in again.table.collect()) == got
    assert dict(again.counts().collect())["inserted"] == 0
    # null_safe treats NULL vs value as a change.
    ns = refresh_dim(prod, staged, "cn_id", ["name", "party"], order="_order", null_safe=True)
    assert dict((x["cn_id"], x["party"]) for x in ns.table.where("y2 = '12'").collect())["H2"] == "REP"


def test_legacy_collation_change_test(spark):
    prod = spark.createDataFrame([(1, "12", "H1", "Acme", "DEM")], DIM)
    staged = spark.createDataFrame([("12", "H1", "ACME ", "DEM", 1)], STAGED)
    binary = refresh_dim(prod, staged, "cn_id", ["name", "party"], order="_order")
    legacy = refresh_dim(prod, staged, "cn_id", ["name", "party"], order="_order",
                         collation="UTF8_LCASE_RTRIM")
    assert binary.table.first()["name"] == "ACME "
    assert legacy.table.first()["name"] == "Acme"


def _dims(spark):
    cm = spark.createDataFrame([(1, "12", "C1"), (2, "12", "C2"), (3, "10", "C9")],
                               "id long, y2 string, cm_id string")
    cn = spark.createDataFrame([(7, "12", "S1")], "id long, y2 string, cn_id string")
    return cm, cn


def _staged(spark, rows):
    return spark.createDataFrame(rows, "y2 string, cmte_id string, other_id string, "
                                       "cand_id string, transaction_dt string, "
                                       "transaction_amt decimal(14,2), sub_id decimal(19,0), "
                                       "k long")


def test_resolve_cases(spark):
    cm, cn = _dims(spark)
    staged = _staged(spark, [
        ("12", "C1", "C2", "S1", "04122012", Decimal("5.00"), Decimal(11), 1),  # other = committee
        ("12", "C1", "S1", "S1", "0412012", Decimal("6.00"), Decimal(12), 2),   # other = candidate
        ("12", "C9", "", "S9", "", Decimal("7.00"), Decimal(13), 3),    # E5 unknown in 12, E6 ''
        ("12", "C1", "X0", "S1", "13452012", Decimal("8.00"), Decimal(0), 4),  # E4 sub_id 0
    ])
    for max_rows in (None, 0):   # broadcast lookups, then the salted shuffle join
        cml = Lookup.of(cm.select("y2", "cm_id", "id"), max_rows=max_rows)
        cnl = Lookup.of(cn.select("y2", "cn_id", "id"), max_rows=max_rows)
        assert cml.broadcast == (max_rows is None)
        out = fx.resolve(staged, cml, cnl, "pas2")
        got = sorted((int(r["sub_id"]), r["cm_id"], r["other_cm_id"], r["other_cn_id"], r["cn_id"],
                      str(r["transaction_date"])) for r in out.collect())
        assert got == [(11, 1, 2, None, 7, "2012-04-12"), (12, 1, None, 7, 7, "2012-04-12"),
                       (13, None, None, None, None, "None")]


def _facts(spark, rows):
    return spark.createDataFrame(rows, "sub_id decimal(19,0), v string, k long")


def test_incremental_batch_cases(spark):
    base = _facts(spark, [(Decimal(1), "base1", 0), (Decimal(2), "base2", 0),
                          (Decimal(3), "base3", 0),
                          (Decimal(4061920121160012345), "big", 0)])
    deletes = spark.createDataFrame([(Decimal(2),), (Decimal(3),), (Decimal(4061920121160012345),)],
                                    "sub_id decimal(19,0)")          # E16 19-digit delete
    adds = _facts(spark, [(Decimal(3), "add3", 1),                  # E12 deleted then added
                          (Decimal(5), "add5a", 2), (Decimal(5), "add5b", 3),   # E15 last wins
                          (Decimal(6), "add6", 4)])
    chgs = _facts(spark, [(Decimal(6), "chg6", 1),                  # E13 chg beats add
                          (Decimal(9), "chg9", 2)])                 # E14 unknown -> inserted
    out = fx.apply_increment(base.drop("k"), deletes, adds, chgs, "k")
    got = sorted((int(r["sub_id"]), r["v"]) for r in out.collect())
    assert got == [(1, "base1"), (3, "add3"), (5, "add5b"), (6, "chg6"), (9, "chg9")]
    assert fx.deleted_rows(base, deletes).count() == 3
    assert fx.delete_by_key(base, deletes).count() == 1

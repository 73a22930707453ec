from decimal import Decimal

from pyspark.sql import functions as F

from campfin.operators.dedupe import keep_first, keep_last
from campfin.operators.ids import assign_ids
from campfin.operators.parse import parse_kind


def _lines(spark, values, y2="12"):
    return spark.createDataFrame([(y2, v, i) for i, v in enumerate(values)],
                                 "y2 string, value string, _order long")


def test_contrib_short_long_and_empty_fields(spark):
    full = "C00000001|N|Q1|P2012|123|15|IND|DOE, JANE|CITY||02139|ACME|ENG|04122012|250.00|" \
           "H00000001|T1|42|X|memo|4061920121160012345"
    short = "|".join(full.split("|")[:19])         # E17: 19 fields
    long = full + "|extra|more"                     # E17: 23 fields
    df = parse_kind(_lines(spark, [full, short, long]), "indiv").orderBy("_order")
    r = df.collect()
    assert r[0]["state"] == ""                      # E18: empty stays ''
    assert r[0]["transaction_amt"] == Decimal("250.00")
    assert r[0]["sub_id"] == Decimal("4061920121160012345")   # E16: 19 digits intact
    assert r[1]["memo_text"] is None and r[1]["sub_id"] == Decimal(0)  # missing; NOT NULL -> 0
    assert r[2]["sub_id"] == Decimal("4061920121160012345") and r[2]["memo_text"] == "memo"


def test_cn_line_types(spark):
    line = "H0AK00089|SMITH, JOHN|REP|2012|AK|H|00|C |C|C00000001|1 MAIN ST||JUNEAU|AK|99801"
    r = parse_kind(_lines(spark, [line], y2="04"), "cn").first()
    assert r["y2"] == "04" and r["election_year"] == Decimal(2012) and r["i_c_status"] == "C"


def test_keep_first_and_last(spark):
    # First line wins on load; E15: last line wins on replace.
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")],
                               "k string, o long, v string")
    assert sorted(tuple(r) for r in keep_first(df, ["k"], "o").collect()) == \
        [("a", 1, "x"), ("b", 3, "z")]
    assert sorted(tuple(r) for r in keep_last(df, ["k"], "o").collect()) == \
        [("a", 2, "y"), ("b", 3, "z")]


def test_assign_ids_dense_ordered_and_partition_independent(spark):
    # One cycle holds most rows (a hot key); ids must still be 1..n in (y2, key) order.
    data = [("12", f"C{i:08d}") for i in range(900)] + [("10", f"C{i:08d}") for i in range(100)]
    expect = {k: i + 1 + 50 for i, k in enumerate(sorted(data))}
    for parts in (1, 8):
        df = spark.createDataFrame(data, "y2 string, cm_id string").repartition(parts)
        got = {(r["y2"], r["cm_id"]): r["id"]
               for r in assign_ids(df, ["y2", "cm_id"], start=50).collect()}
        assert got == expect


def test_parse_rejects_nothing_counts_rows(spark):
    lines = _lines(spark, ["", "only-one-field", "a|b"])
    df = parse_kind(lines, "delete")
    assert df.count() == 3
    assert [r["sub_id"] for r in df.orderBy("_order").collect()] == [Decimal(0)] * 3
    assert df.where(F.col("sub_id") != 0).count() == 0


def test_render_parse_round_trip(spark):
    from campfin.operators.parse import render
    from campfin.schemas import CM_FIELDS
    row = ("C00000001", "FRIENDS OF X", "T", "1 MAIN", "", "CITY", "TX", "75001", "P", "H",
           "DEM", "Q", "", "ORG", "H0TX00001")
    names = [f[0] for f in CM_FIELDS]
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    lines = df.select(F.lit("12").alias("y2"), render(df, CM_FIELDS).alias("value"),
                      F.lit(1).alias("_order"))
    back = parse_kind(lines, "cm").select(*names).first()
    assert tuple(back) == row


def test_repair_counts(spark):
    from campfin.operators.repairs import repair_counts
    good = "C00000001|N|Q1|P2012|123|15|IND|DOE|CITY|MA|02139|ACME|ENG|04122012|250.00|" \
           "H00000001|T1|42|X|memo|4061920121160012345"
    f = good.split("|")
    short = "|".join(f[:19])                                   # short line
    long = good + "|extra"                                      # long line
    junk = "|".join(f[:14] + ["12USD", "\\N"] + f[16:])         # lenient number, \N field
    wide = "|".join(f[:2] + ["M10X"] + f[3:])                   # rpt_tp is 3 wide
    lines = spark.createDataFrame([("indiv", v) for v in (good, short, long, junk, wide)]
                                  + [("delete", ""), ("delete", "4061920121160012345")],
                                  "kind string, value string")
    got = {(r["kind"], r["repair"]): r["count"] for r in repair_counts(lines).collect()}
    assert got[("indiv", "short_lines")] == 1 and got[("indiv", "long_lines")] == 1
    assert got[("indiv", "null_fields")] == 1 and got[("indiv", "lenient_numbers")] == 1
    assert got[("indiv", "cut_text")] == 1
    assert got[("delete", "lenient_numbers")] == 1   # '' read as 0


def test_numbers_beyond_their_type_become_the_nearest_bound(spark):
    from campfin.functions.text import coerce_decimal
    from campfin.operators.repairs import repair_counts
    df = spark.createDataFrame([("40619201211600123456",), ("-99999999999999999999x",), ("12abc",), ("",), (None,)], "c string")
    got = [str(r[0]) for r in df.select(coerce_decimal("c", 19, 0)).collect()]
    assert got == ["9" * 19, "-" + "9" * 19, "12", "0", "None"]
    lines = spark.createDataFrame([("delete", "40619201211600123456"), ("delete", "7")], "kind string, value string")
    counts = {r["repair"]: r["count"] for r in repair_counts(lines).collect()}
    assert counts["out_of_range"] == 1 and counts["lenient_numbers"] == 0

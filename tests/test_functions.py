import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from campfin.functions import (
    any_changed, coerce_decimal, date_from_mmddyyyy, fit_text, y2_of_year,
)


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_dates_good_bad_and_short(spark):
    # E1 good, E2 empty/NULL/impossible -> NULL, E3 seven characters read by position.
    got = _one_col(spark, ["04122012", "", None, "13452012", "02302012", "0412012"],
                   date_from_mmddyyyy)
    assert got == [dt.date(2012, 4, 12), None, None, None, None, dt.date(2012, 4, 12)]


def test_coerce_decimal_lenient(spark):
    # E4: '0', '' and 'abc' become 0; leading numbers are kept; \N and missing are NULL.
    got = _one_col(spark, ["0", "", "abc", "12abc", " 7.5", "\\N", None, "4061920121160012345"],
                   lambda c: coerce_decimal(c, 19, 0))
    assert got == [Decimal(0), Decimal(0), Decimal(0), Decimal(12), Decimal(8), None, None,
                   Decimal("4061920121160012345")]


def test_fit_text(spark):
    # E18: '' stays ''; char columns drop trailing spaces, varchar keeps them; cut to size.
    assert _one_col(spark, ["", "ab ", "\\N", "abcdef"], lambda c: fit_text(c, 3, True)) == \
        ["", "ab", None, "abc"]
    assert _one_col(spark, ["ab ", "abcdef"], lambda c: fit_text(c, 4, False)) == ["ab ", "abcd"]


def test_y2_of_year_keeps_leading_zero(spark):
    # 2004 -> '04', a string.
    df = spark.createDataFrame([(2004,), (2012,)], "y int")
    assert [r[0] for r in df.select(y2_of_year("y")).collect()] == ["04", "12"]


def test_any_changed_three_valued(spark):
    # NULL on one side alone is not a change; null_safe makes it one.
    df = spark.createDataFrame([("a", "a", "x", None), ("a", "b", "x", "x"), ("a", "a", None, "x")],
                               "a1 string, a2 string, b1 string, b2 string")
    pairs = [("a", F.col("a1"), F.col("a2")), ("b", F.col("b1"), F.col("b2"))]
    plain = [r[0] for r in df.select(any_changed(pairs)).collect()]
    safe = [r[0] for r in df.select(any_changed(pairs, null_safe=True)).collect()]
    assert plain == [False, True, False]
    assert safe == [True, True, True]


def test_any_changed_legacy_collation(spark):
    df = spark.createDataFrame([("Acme", "ACME "), ("Acme", "Acne")], "o string, n string")
    got = [r[0] for r in df.select(
        any_changed([("e", F.col("o"), F.col("n"))], collation="UTF8_LCASE_RTRIM")).collect()]
    assert got == [False, True]


def test_dates_against_calendar(spark):
    """Brute force: random MMDDYYYY texts (impossible months/days included)
    against Python's calendar, in one Spark job."""
    import random
    rnd = random.Random(7)
    texts = [f"{rnd.randint(0, 19):02d}{rnd.randint(0, 39):02d}{rnd.randint(1900, 2100)}"
             for _ in range(3000)]

    def expect(t):
        try:
            return dt.date(int(t[4:]), int(t[:2]), int(t[2:4]))
        except ValueError:
            return None

    got = _one_col(spark, texts, date_from_mmddyyyy)
    assert got == [expect(t) for t in texts]

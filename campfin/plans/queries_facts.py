"""Registered queries: resolve (W2), dates (X1-X5), reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from campfin.functions.text import date_from_mmddyyyy
from campfin.plans import reports
from campfin.plans.registry import (
    DATE_SQL, INDIV_CTE, PAS2_COLS, REPORT_COLS, REPORT_CYCLE, RESOLVE_COLS, WIDE_SQL, register,
    resolve_sql, resolved, wide,
)
from campfin.plans.standins import build

# ---------------------------------------------------------------- resolve


@register("resolve_indiv", resolve_sql(WIDE_SQL, RESOLVE_COLS))
def q_resolve_indiv(spark, sf_dir):
    s = build(spark, sf_dir)
    return resolved(s, wide(s.sindiv())).select(*RESOLVE_COLS)


@register("resolve_oth", resolve_sql(WIDE_SQL, RESOLVE_COLS))
def q_resolve_oth(spark, sf_dir):
    s = build(spark, sf_dir)
    return resolved(s, wide(s.soth()), "oth").select(*RESOLVE_COLS)


@register("resolve_pas2", resolve_sql(WIDE_SQL, PAS2_COLS))
def q_resolve_pas2(spark, sf_dir):
    s = build(spark, sf_dir)
    return resolved(s, wide(s.spas2()), "pas2").select(*PAS2_COLS)


# ------------------------------------------------------------- dates

@register("date_from_mmddyyyy", """, v AS (
  SELECT k, 'as_filed' AS variant, transaction_dt AS txt FROM src
  UNION ALL SELECT k, 'short_month',
         concat(CAST(month(dt) AS string), lpad(CAST(day(dt) AS string), 2, '0'),
                CAST(year(dt) AS string)) FROM src JOIN o ON o_orderkey = k
  UNION ALL SELECT k, 'day_first',
         concat(lpad(CAST(day(dt) AS string), 2, '0'), lpad(CAST(month(dt) AS string), 2, '0'),
                CAST(year(dt) AS string)) FROM src JOIN o ON o_orderkey = k
  UNION ALL SELECT k, 'empty', '' FROM src)
SELECT k, variant, txt, """ + DATE_SQL.format(c="txt") + """ AS dt FROM v""")
def q_date(spark, sf_dir):
    s = build(spark, sf_dir)
    o = s.o.select(F.col("o_orderkey").alias("k"), "dt")
    base = s.src.select("k", "transaction_dt").join(o, "k")
    mm, dd, yy = (F.month("dt").cast("string"), F.lpad(F.dayofmonth("dt").cast("string"), 2, "0"),
                  F.year("dt").cast("string"))
    variants = F.array(
        F.struct(F.lit("as_filed").alias("variant"), F.col("transaction_dt").alias("txt")),
        F.struct(F.lit("short_month").alias("variant"), F.concat(mm, dd, yy).alias("txt")),
        F.struct(F.lit("day_first").alias("variant"),
                 F.concat(dd, F.lpad(mm, 2, "0"), yy).alias("txt")),
        F.struct(F.lit("empty").alias("variant"), F.lit("").alias("txt")))
    v = base.select("k", F.inline(variants))
    return v.select("k", "variant", "txt", date_from_mmddyyyy("txt").alias("dt"))


# ----------------------------------------------------------- reports

@register("cm_meta", INDIV_CTE + """
SELECT cm_id, CAST(sum(transaction_amt) AS decimal(24,2)) AS contribSum, count(*) AS contribCount
FROM indiv WHERE cm_id IS NOT NULL GROUP BY ALL""")
def q_cm_meta(spark, sf_dir):
    s = build(spark, sf_dir)
    return reports.cm_meta(resolved(s, s.sindiv(), columns=REPORT_COLS))


@register("top_committees", INDIV_CTE + f""",
totals AS (SELECT cm_id AS id, sum(transaction_amt) AS total FROM indiv GROUP BY ALL),
named AS (
  SELECT f.id, f.name AS committe, f.party,
         (SELECT d.name FROM cn d WHERE d.y2 = f.y2 AND d.cn_id = f.cn_id) AS candidate
  FROM cm f WHERE f.y2 = '{REPORT_CYCLE}')
SELECT candidate, committe, party, CAST(sum(coalesce(total, 0)) AS decimal(24,2)) AS amt
FROM named LEFT JOIN totals USING (id) GROUP BY ALL
ORDER BY amt DESC, candidate NULLS LAST, committe NULLS LAST, party NULLS LAST LIMIT 100""")
def q_top_committees(spark, sf_dir):
    s = build(spark, sf_dir)
    facts = resolved(s, s.sindiv(), columns=REPORT_COLS)
    return reports.top_committees(s.cm, s.cn, facts, REPORT_CYCLE)


# Every committee of the cycle: those whose contributions all lack a number have none and total 0.
@register("committee_totals", INDIV_CTE + f""",
totals AS (SELECT cm_id AS id, sum(transaction_amt) AS total FROM indiv GROUP BY ALL)
SELECT (SELECT d.name FROM cn d WHERE d.y2 = f.y2 AND d.cn_id = f.cn_id) AS candidate, f.name AS committe,
       f.party, CAST(sum(coalesce(total, 0)) AS decimal(24,2)) AS amt
FROM cm f LEFT JOIN totals USING (id) WHERE f.y2 = '{REPORT_CYCLE}' GROUP BY ALL""")
def q_committee_totals(spark, sf_dir):
    """The committee report without its limit, zero totals included."""
    s = build(spark, sf_dir)
    facts = resolved(s, s.sindiv(), columns=REPORT_COLS)
    return reports.top_committees(s.cm, s.cn, facts, REPORT_CYCLE, limit=None)


_CYCLE_FACTS = f""",
facts AS (SELECT employer, occupation, transaction_amt FROM indiv
          WHERE cm_id IN (SELECT id FROM cm WHERE y2 = '{REPORT_CYCLE}'))"""


@register("employer_occupation", INDIV_CTE + _CYCLE_FACTS + """
SELECT * FROM (
  SELECT employer, occupation, count(*) AS contrib_count,
         CAST(sum(transaction_amt) AS decimal(24,2)) AS contrib_sum
  FROM facts GROUP BY ALL)
WHERE contrib_count > 25""")
def q_employer_occupation(spark, sf_dir):
    s = build(spark, sf_dir)
    facts = resolved(s, s.sindiv(), columns=REPORT_COLS)
    return reports.employer_occupation(facts, s.cm, REPORT_CYCLE)


@register("employer_occupation_legacy", INDIV_CTE + _CYCLE_FACTS + """
SELECT employer, occupation, contrib_count, contrib_sum FROM (
  SELECT rtrim(lower(employer)) AS e, rtrim(lower(occupation)) AS o,
         min(employer) AS employer, min(occupation) AS occupation, count(*) AS contrib_count,
         CAST(sum(transaction_amt) AS decimal(24,2)) AS contrib_sum
  FROM facts GROUP BY 1, 2)
WHERE contrib_count > 25""")
def q_employer_occupation_legacy(spark, sf_dir):
    s = build(spark, sf_dir)
    facts = resolved(s, s.sindiv(), columns=REPORT_COLS)
    return reports.employer_occupation_legacy(facts, s.cm, REPORT_CYCLE)

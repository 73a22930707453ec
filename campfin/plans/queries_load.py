"""Registered queries: parsing raw lines (S6-S12), first-line-wins load."""

from __future__ import annotations

from pyspark.sql import functions as F

from campfin.operators.dedupe import keep_first
from campfin.operators.parse import parse_kind
from campfin.plans.rawlines import expected_sql, render_lines, with_n
from campfin.plans.registry import register
from campfin.plans.standins import build
from campfin.schemas import FIELDS_BY_KIND


def _parsed(lines, kind):
    names = [f[0] for f in FIELDS_BY_KIND[kind]]
    return parse_kind(lines, kind).select(*(["y2"] if kind != "delete" else []), *names)


@register("parse_cn", expected_sql("cn", "scn"))
def q_parse_cn(spark, sf_dir):
    s = build(spark, sf_dir)
    return _parsed(render_lines(s.scn, "cn", "n"), "cn")


@register("parse_cm", expected_sql("cm", "scm"))
def q_parse_cm(spark, sf_dir):
    s = build(spark, sf_dir)
    return _parsed(render_lines(s.scm, "cm", "n"), "cm")


@register("parse_contrib", expected_sql("indiv", "src"))
def q_parse_contrib(spark, sf_dir):
    s = build(spark, sf_dir)
    return _parsed(render_lines(s.sindiv(), "indiv", "k"), "indiv")


@register("parse_pas2", expected_sql("pas2", "src"))
def q_parse_pas2(spark, sf_dir):
    s = build(spark, sf_dir)
    return _parsed(render_lines(s.spas2(), "pas2", "k"), "pas2")


@register("parse_delete", expected_sql(
    "delete", "(SELECT sub_id, k FROM src WHERE k % 10 IN (7, 9))", with_y2=False))
def q_parse_delete(spark, sf_dir):
    s = build(spark, sf_dir)
    lines = render_lines(s.sdelete(), "delete", "k").withColumn("y2", F.lit(""))
    return _parsed(lines, "delete")


# Candidate lines with duplicates of some keys: for n % 10 = 0 the duplicate
# line comes first (and must win), for n % 10 = 5 it comes after the original.
@register("load_keep_first", """, t AS (SELECT *, CAST(substring(cn_id, 2) AS int) AS n FROM scn),
lines AS (
  SELECT y2, cn_id, name, party, n * 2 + 1 AS ord FROM t
  UNION ALL
  SELECT y2, cn_id, concat(name, ' DUP'), party,
         CASE WHEN n % 10 = 0 THEN n * 2 ELSE n * 2 + 2 END FROM t WHERE n % 5 = 0)
SELECT y2, cn_id, name, party FROM (
  SELECT *, row_number() OVER (PARTITION BY y2, cn_id ORDER BY ord) AS rn FROM lines) AS r
WHERE rn = 1""")
def q_load_keep_first(spark, sf_dir):
    s = build(spark, sf_dir)
    t = with_n(s.scn, "cn")
    dups = (t.where(F.col("n") % 5 == 0).withColumn("name", F.concat("name", F.lit(" DUP")))
            .drop("n"))
    lines = (render_lines(s.scn, "cn", "n * 2 + 1")
             .unionByName(render_lines(
                 dups, "cn", "CASE WHEN n % 10 = 0 THEN n * 2 ELSE n * 2 + 2 END")))
    staged = parse_kind(lines, "cn")
    return keep_first(staged, ["y2", "cn_id"], "_order").select("y2", "cn_id", "name", "party")

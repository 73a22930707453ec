"""Stand-in filings derived from the driver's tables (FIXTURES.md F4).

The test tables hold no finance filings, so candidates come from
``supplier``, committees from ``customer`` and contributions from
``orders``.  Every frame here is derived from those tables with Spark, so
the work grows with them.  ``STANDIN_SQL`` is the same derivation as SQL
CTEs for the DuckDB oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campfin.operators.ids import assign_ids_counted


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Candidate numbers that filings name: far more than some cycles have.
CANDIDATES = 1009


def fec_key(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), 8, "0"))


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def orders_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    yr = F.year("o_orderdate")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(14,2)").alias("amt"),
        F.col("o_orderdate").cast("date").alias("dt"),
        F.right((yr + yr % 2).cast("string"), F.lit(2)).alias("y2"))


def cycles(o: DataFrame) -> list[str]:
    """Distinct cycles (a handful of values: bounded by the years covered)."""
    return sorted(r[0] for r in o.select("y2").distinct().collect())


def staged_cn(spark: SparkSession, sf_dir: str, o: DataFrame,
              cycle_list: list[str] | None = None) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    ys = F.array(*[F.lit(y) for y in (cycle_list or cycles(o))])
    k = F.col("s_suppkey")
    return (s.select(k, "s_name", "s_nationkey", F.explode(ys).alias("y2"))
            .where(~((k % 7 == 0) & (F.col("y2") == "96")))
            .select(fec_key("S", k).alias("cn_id"), "y2", F.col("s_name").alias("name"),
                    F.when(k % 3 == 0, "DEM").when(k % 3 == 1, "REP").otherwise("IND")
                    .alias("party"),
                    F.col("s_nationkey").cast("string").alias("state")))


def staged_cm(spark: SparkSession, sf_dir: str, o: DataFrame) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").where(F.col("c_custkey") % 11 != 0)
    active = o.select(F.col("o_custkey").alias("c_custkey"), "y2").distinct()
    k = F.col("c_custkey")
    return (c.join(active, "c_custkey")
            .select(fec_key("C", k).alias("cm_id"), "y2", F.col("c_name").alias("name"),
                    F.left(F.col("c_mktsegment"), F.lit(3)).alias("party"),
                    F.when(k % 4 == 0, fec_key("S", k % 10)).otherwise(F.lit("")).alias("cn_id")))


def contributions(o: DataFrame) -> DataFrame:
    """``src`` of F4: one staged contribution per order, plus the split key ``k``."""
    k = F.col("o_orderkey")
    mm, dd = _pad2(F.month("dt")), _pad2(F.dayofmonth("dt"))
    return o.select(
        "y2",
        fec_key("C", F.col("o_custkey")).alias("cmte_id"),
        F.when(k % 2 == 0, F.lower("o_orderpriority"))
        .otherwise(F.concat("o_orderpriority", F.lit("  "))).alias("employer"),
        F.concat("o_orderstatus", F.lit("-Q"), F.quarter("dt").cast("string")).alias("occupation"),
        F.concat(mm, dd, F.year("dt").cast("string")).alias("transaction_dt"),
        F.col("amt").alias("transaction_amt"),
        F.when(k % 4 == 0, fec_key("C", F.col("o_custkey")))
        .when(k % 4 == 1, fec_key("S", k % CANDIDATES))
        .when(k % 4 == 2, F.lit("")).otherwise(F.lit("X00000000")).alias("other_id"),
        fec_key("S", k % CANDIDATES).alias("cand_id"),
        F.when(k % 50 == 0, F.lit(0).cast("decimal(19,0)"))
        .otherwise((F.lit(4000000000000000000) + k).cast("decimal(19,0)")).alias("sub_id"),
        k.alias("k"))


class Standins:
    """The stand-in tables; ids are assigned when a dimension is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self.o = orders_o(spark, sf_dir)
        self.src = contributions(self.o)

    @cached_property
    def scn(self) -> DataFrame:
        return staged_cn(self._spark, self._sf_dir, self.o, cycles(self.o))

    @cached_property
    def scm(self) -> DataFrame:
        return staged_cm(self._spark, self._sf_dir, self.o)

    @cached_property
    def _cn(self) -> tuple[DataFrame, int]:
        return assign_ids_counted(self.scn, ["y2", "cn_id"])

    @cached_property
    def _cm(self) -> tuple[DataFrame, int]:
        return assign_ids_counted(self.scm, ["y2", "cm_id"])

    @property
    def cn(self) -> DataFrame:
        return self._cn[0].select("id", *self.scn.columns)

    @property
    def cm(self) -> DataFrame:
        return self._cm[0].select("id", *self.scm.columns)

    @property
    def cn_rows(self) -> int:
        return self._cn[1]

    @property
    def cm_rows(self) -> int:
        return self._cm[1]

    # Every order is a contribution of every kind (F4 table).
    def sindiv(self): return self.src
    def soth(self): return self.src
    def spas2(self): return self.src
    def prev_indiv_src(self): return self.src.where(F.col("k") % 5 != 4)
    def sdelete(self):
        return self.src.where((F.col("k") % 10).isin(7, 9)).select("y2", "sub_id", "k")
    def sadd(self):
        return (self.src.where((F.col("k") % 5 == 4) | (F.col("k") % 10 == 0))
                .withColumn("transaction_amt",
                            (F.col("transaction_amt") + 1).cast("decimal(14,2)")))
    def schg(self):
        return (self.src.where((F.col("k") % 10 == 3) | (F.col("k") % 20 == 7))
                .withColumn("transaction_amt",
                            (F.col("transaction_amt") * 2).cast("decimal(14,2)")))


def previous_fields(attrs: list[str], numeric: set[str]) -> dict[str, str]:
    """SQL of the attributes that production had before, by name: attribute i
    differs where id % 31 = i (so that each alone must update), and is NULL
    where id % 31 = i + 15 (which must not)."""
    out = {}
    for i, a in enumerate(attrs):
        other = f"{a} + 1" if a in numeric else f"'old ' || {a}"
        out[a] = f"CASE id % 31 WHEN {i} THEN {other} WHEN {i + 15} THEN NULL ELSE {a} END"
    return out


def previous_dim(dim: DataFrame, attrs: list[str], numeric: set[str]) -> DataFrame:
    """The production dimension before: ids % 4 <> 0, attributes as in
    ``previous_fields``."""
    new = previous_fields(attrs, numeric)
    return dim.where(F.col("id") % 4 != 0).select(
        *[F.expr(new[c]).cast(dim.schema[c].dataType).alias(c) if c in new else F.col(c) for c in dim.columns])


def build(spark: SparkSession, sf_dir: str) -> Standins:
    return Standins(spark, sf_dir)


# The same stand-ins as SQL (runs unchanged on Spark SQL and DuckDB).
STANDIN_SQL = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CAST(o_totalprice AS decimal(14,2)) AS amt,
         CAST(o_orderdate AS date) AS dt,
         right(CAST(year(o_orderdate) + year(o_orderdate) % 2 AS string), 2) AS y2
  FROM orders),
cycles AS (SELECT DISTINCT y2 FROM o),
scn AS (
  SELECT concat('S', lpad(CAST(s_suppkey AS string), 8, '0')) AS cn_id, y2, s_name AS name,
         CASE s_suppkey % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE 'IND' END AS party,
         CAST(s_nationkey AS string) AS state
  FROM supplier CROSS JOIN cycles
  WHERE NOT (s_suppkey % 7 = 0 AND y2 = '96')),
scm AS (
  SELECT DISTINCT concat('C', lpad(CAST(c_custkey AS string), 8, '0')) AS cm_id, y2, c_name AS name,
         left(c_mktsegment, 3) AS party,
         CASE WHEN c_custkey % 4 = 0
              THEN concat('S', lpad(CAST(c_custkey % 10 AS string), 8, '0')) ELSE '' END AS cn_id
  FROM customer JOIN o ON o_custkey = c_custkey
  WHERE c_custkey % 11 <> 0),
cn AS (SELECT row_number() OVER (ORDER BY y2, cn_id) AS id, * FROM scn),
cm AS (SELECT row_number() OVER (ORDER BY y2, cm_id) AS id, * FROM scm),
src AS (
  SELECT y2, concat('C', lpad(CAST(o_custkey AS string), 8, '0')) AS cmte_id,
         CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority)
              ELSE concat(o_orderpriority, '  ') END AS employer,
         concat(o_orderstatus, '-Q', CAST(quarter(dt) AS string)) AS occupation,
         concat(lpad(CAST(month(dt) AS string), 2, '0'), lpad(CAST(day(dt) AS string), 2, '0'),
                CAST(year(dt) AS string)) AS transaction_dt,
         amt AS transaction_amt,
         CASE o_orderkey % 4
              WHEN 0 THEN concat('C', lpad(CAST(o_custkey AS string), 8, '0'))
              WHEN 1 THEN concat('S', lpad(CAST(o_orderkey % 1009 AS string), 8, '0'))
              WHEN 2 THEN '' ELSE 'X00000000' END AS other_id,
         concat('S', lpad(CAST(o_orderkey % 1009 AS string), 8, '0')) AS cand_id,
         CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS decimal(19,0))
              ELSE CAST(4000000000000000000 + o_orderkey AS decimal(19,0)) END AS sub_id,
         o_orderkey AS k
  FROM o)"""

"""Query registry: each registered query takes (spark, sf_dir) and returns a
DataFrame over the driver's tables; ``ORACLE`` holds the equivalent DuckDB
SQL (the stand-in CTEs of ``STANDIN_SQL`` followed by the query).

Every query derives its inputs from the given tables through the stand-ins
of ``campfin.plans.standins`` and runs over all of their rows.  Output
columns are aliased identically on both sides; sums are decimal(24,2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from campfin.operators import facts as fx
from campfin.plans.rawlines import expected_sql, typed
from campfin.plans.standins import STANDIN_SQL
from campfin.schemas import fact_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Cycle of the sample reports.
REPORT_CYCLE = "98"


def register(name: str, sql: str | None):
    """Register a query; ``sql`` continues the stand-in CTEs: it starts with
    ``-- cte`` (more CTEs, then the SELECT), ``,`` (same) or ``SELECT``."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            body = sql.lstrip()
            if body.startswith("-- cte"):
                ORACLE[name] = STANDIN_SQL + ",\n" + body
            else:
                ORACLE[name] = STANDIN_SQL + "\n" + body
        return fn
    return deco


# The three positions put in reading order, then read by the calendar.
DATE_SQL = ("CAST(try_strptime(left({c}, 2) || substring({c}, 3, 2) || right({c}, 4), '%m%d%Y') "
            "AS DATE)")

# Every column of a production contribution, in table order.
RESOLVE_COLS = [f.name for f in fact_schema("indiv")]
PAS2_COLS = [f.name for f in fact_schema("pas2")]


def id_sql(dimension: str, key: str, of: str) -> str:
    """A filing's numbered committee or candidate, looked up as one value."""
    return f"(SELECT d.id FROM {dimension} d WHERE d.y2 = f.y2 AND d.{key} = f.{of})"


def resolve_sql(src: str, columns: list[str], more: str = "") -> str:
    """``columns`` of every staged filing with a real sub_id, its ids looked up
    one by one."""
    date = DATE_SQL.format(c="transaction_dt")
    made = {"cm_id": id_sql("cm", "cm_id", "cmte_id"), "other_cm_id": id_sql("cm", "cm_id", "other_id"),
            "other_cn_id": id_sql("cn", "cn_id", "other_id"), "cn_id": id_sql("cn", "cn_id", "cand_id"),
            "transaction_dt": date, "transaction_date": date}
    listed = ", ".join(f"{made[c]} AS {c}" if c in made else c for c in columns)
    return f"SELECT {listed}{more} FROM {src} f WHERE sub_id <> 0"


# Every filing with all its fields (``typed`` in rawlines).
WIDE_SQL = "(" + expected_sql("indiv", "src", extra=("k", "cand_id")) + ")"


def wide(df: DataFrame) -> DataFrame:
    return typed(df, "indiv", extra=("k", "cand_id"))


# Resolved full load of indiv, as a CTE for later oracles.
INDIV_CTE = "-- cte\nindiv AS (" + resolve_sql("src", [
    "cm_id", "employer", "occupation", "transaction_amt", "sub_id", "y2"]) + ")"


# Fact columns the sample reports read.
REPORT_COLS = ["cm_id", "employer", "occupation", "transaction_amt", "sub_id", "y2"]


def resolved(s, staged: DataFrame, kind: str = "indiv", keep: tuple[str, ...] = (),
             columns: list[str] | None = None) -> DataFrame:
    return fx.resolve(staged, cm_lookup(s), cn_lookup(s), kind, keep=keep, columns=columns)


def cm_lookup(s):
    return fx.dim_lookup(s.cm, "cm_id", rows=s.cm_rows)


def cn_lookup(s):
    return fx.dim_lookup(s.cn, "cn_id", rows=s.cn_rows)

"""Registered queries: delete / replace / incremental batch."""

from __future__ import annotations

from campfin.operators import facts as fx
from campfin.plans.rawlines import expected_sql, marked, marked_sql
from campfin.plans.registry import RESOLVE_COLS, WIDE_SQL, cm_lookup, cn_lookup, register, resolve_sql, wide
from campfin.plans.standins import build

_COLS = ", ".join(RESOLVE_COLS)


def _changes(where: str, amount: str, mark: str, n: int) -> str:
    """Wide change rows: another amount, and every other field marked."""
    rows = f"(SELECT * REPLACE (CAST({amount} AS decimal(14,2)) AS transaction_amt) FROM src WHERE {where})"
    return marked_sql("(" + expected_sql("indiv", rows, extra=("k", "cand_id")) + ")", mark, n)


_CTES = f"""-- cte
prev AS ({resolve_sql("(SELECT * FROM " + WIDE_SQL + " w WHERE k % 5 <> 4)", RESOLVE_COLS)}),
del AS (SELECT sub_id FROM src WHERE k % 10 IN (7, 9)),
adds AS ({resolve_sql(_changes("k % 5 = 4 OR k % 10 = 0", "transaction_amt + 1", "+", 1), RESOLVE_COLS, ", k")}),
chg AS ({resolve_sql(_changes("k % 10 = 3 OR k % 20 = 7", "transaction_amt * 2", "*", 2), RESOLVE_COLS, ", k")})"""

# Rows by priority: later batches outrank earlier ones, later lines outrank earlier.
_LATEST = f"""
SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY sub_id ORDER BY prio DESC, ord DESC) AS rn
  FROM rows) AS r
WHERE rn = 1"""


def _state(spark, sf_dir):
    s = build(spark, sf_dir)
    cm, cn = cm_lookup(s), cn_lookup(s)
    prev = fx.resolve(wide(s.prev_indiv_src()), cm, cn)
    adds = fx.resolve(marked(wide(s.sadd()), "+", 1), cm, cn, "add", keep=("k",))
    chg = fx.resolve(marked(wide(s.schg()), "*", 2), cm, cn, "chg", keep=("k",))
    return s, prev, adds, chg


@register("delete_by_key", _CTES + f"""
SELECT {_COLS} FROM prev AS p
WHERE NOT EXISTS (SELECT 1 FROM del AS d WHERE d.sub_id = p.sub_id)""")
def q_delete_by_key(spark, sf_dir):
    s, prev, _a, _c = _state(spark, sf_dir)
    return fx.delete_by_key(prev, s.sdelete()).select(*RESOLVE_COLS)


@register("replace_add", _CTES + """,
rows AS (SELECT *, 0 AS prio, 0 AS ord FROM prev
         UNION ALL SELECT """ + _COLS + """, 1, k FROM adds)""" + _LATEST)
def q_replace_add(spark, sf_dir):
    _s, prev, adds, _c = _state(spark, sf_dir)
    return fx.replace_into(prev, adds, "k").select(*RESOLVE_COLS)


@register("replace_chg", _CTES + """,
rows AS (SELECT *, 0 AS prio, 0 AS ord FROM prev
         UNION ALL SELECT """ + _COLS + """, 1, k FROM chg)""" + _LATEST)
def q_replace_chg(spark, sf_dir):
    _s, prev, _a, chg = _state(spark, sf_dir)
    return fx.replace_into(prev, chg, "k").select(*RESOLVE_COLS)


@register("incremental_indiv", _CTES + """,
rows AS (SELECT *, 0 AS prio, 0 AS ord FROM prev AS p
         WHERE NOT EXISTS (SELECT 1 FROM del AS d WHERE d.sub_id = p.sub_id)
         UNION ALL SELECT """ + _COLS + """, 1, k FROM adds
         UNION ALL SELECT """ + _COLS + """, 2, k FROM chg)""" + _LATEST)
def q_incremental_indiv(spark, sf_dir):
    s, prev, adds, chg = _state(spark, sf_dir)
    return fx.apply_increment(prev, s.sdelete(), adds, chg, "k").select(*RESOLVE_COLS)


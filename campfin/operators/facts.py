"""W2, J3-J6, M4-M8 — contribution facts.

``resolve`` turns staged contribution rows into production rows: committee
id by (cmte_id, y2), other_id tried as committee and as candidate, candidate
id by (cand_id, y2) for pas2, date text to date, rows with sub_id 0 dropped.
All lookups are left joins against dimensions with unique keys, so a fact row
never multiplies.

``apply_increment`` is the add/change/delete batch in its fixed order —
delete, then replace adds, then replace changes — as one plan.  A run works on
one *tagged change set* instead (``tag_changes``): a row per sub_id with its
last action and its counts, met once with the base's keys (``meet_base``), from
which the touched cycles, every count of the report and the rewrite follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campfin.functions.text import date_from_mmddyyyy
from campfin.operators.lookup import Lookup, heavy_keys, lookup, written
from campfin.schemas import PRODUCTION_LIMITS, fact_schema


def dim_lookup(dim: DataFrame, key: str, rows: int | None = None) -> Lookup:
    """Narrow (y2, FEC id, id) lookup of a dimension, strategy decided once
    (``rows``: its row count when already known)."""
    return Lookup.of(dim.select("y2", key, "id"), rows=rows)


def resolve(staged: DataFrame, cm: Lookup, cn: Lookup, kind: str = "indiv",
            keep: tuple[str, ...] = (), columns: list[str] | None = None) -> DataFrame:
    """Production rows of ``kind`` (indiv, oth, add, chg, pas2) from staged rows.

    ``cm`` / ``cn`` come from ``dim_lookup``.  Columns absent from ``staged``
    come out NULL.  ``keep`` names extra staged columns to carry (e.g. the
    load order).  ``columns`` restricts the output (and skips the lookups
    whose ids are not asked for)."""
    pas2 = kind == "pas2"
    schema = fact_schema("pas2" if pas2 else "indiv")
    want = set(columns) if columns is not None else set(schema.fieldNames())
    s = staged.where(F.col("sub_id") != 0)
    salt = ["sub_id"] + [c for c in keep if c in staged.columns]
    null_id = F.lit(None).cast("long")
    steps = [("cm_id", cm, "cmte_id", "cm_id", "_cm"),
             ("other_cm_id", cm, "other_id", "cm_id", "_ocm"),
             ("other_cn_id", cn, "other_id", "cn_id", "_ocn")]
    if pas2:
        steps.append(("cn_id", cn, "cand_id", "cn_id", "_cn"))
    # Lookups beyond the broadcast bound share one pass that measures heavy keys.
    split = sorted({(k, "y2") for name, table, k, _d, _t in steps if name in want and not table.broadcast})
    heavy = heavy_keys(s, split) if split else {}
    for out_name, table, fact_key, dim_key, tmp in steps:
        if out_name in want:
            s = lookup(s, table, [(fact_key, dim_key), ("y2", "y2")], {tmp: "id"}, salt_cols=salt,
                       heavy=heavy.get((fact_key, "y2")))
        else:
            s = s.withColumn(tmp, null_id)
    limits = PRODUCTION_LIMITS.get("pas2" if pas2 else kind, {})
    computed = {
        "cm_id": F.col("_cm"), "other_cm_id": F.col("_ocm"), "other_cn_id": F.col("_ocn"),
        "transaction_dt": date_from_mmddyyyy("transaction_dt"),
        "transaction_date": date_from_mmddyyyy("transaction_dt"),
    }
    if pas2:
        computed["cn_id"] = F.col("_cn")
    out = []
    for f in schema.fields:
        if f.name not in want:
            continue
        if f.name in computed:
            e = computed[f.name]
        elif f.name in s.columns:
            e = F.col(f.name)
            if f.name in limits:
                e = F.left(e, F.lit(limits[f.name]))
        else:
            e = F.lit(None)
        out.append(e.cast(f.dataType).alias(f.name))
    out += [F.col(c) for c in keep if c in s.columns]
    return s.select(*out)


def key_lookup(keys: DataFrame) -> Lookup:
    """Distinct sub_ids of a change set, materialized once for check and join."""
    return Lookup.of(keys.select("sub_id").distinct(), materialize=True)


def delete_by_key(facts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Facts whose sub_id is not listed (``NOT IN`` without its NULL trap)."""
    return lookup(facts, key_lookup(deletes), [("sub_id", "sub_id")], {}, how="left_anti",
                  salt_cols=["sub_id"])


def deleted_rows(facts: DataFrame, deletes: DataFrame) -> DataFrame:
    """The facts a delete list removes (for the deleted count)."""
    return lookup(facts, key_lookup(deletes), [("sub_id", "sub_id")], {}, how="left_semi",
                  salt_cols=["sub_id"])


def latest_per_key(changes: DataFrame, order: str) -> DataFrame:
    """M7: one row per sub_id, the largest ``order`` wins (REPLACE semantics).

    ``max_by`` aggregates partially on the map side, so a hot key is combined
    before the shuffle."""
    cols = [c for c in changes.columns if c != "sub_id"]
    picked = changes.groupBy("sub_id").agg(
        F.max_by(F.struct(*cols), F.col(order)).alias("_row"))
    return picked.select("sub_id", "_row.*").select(*changes.columns)


def replace_into(facts: DataFrame, changes: DataFrame, order: str) -> DataFrame:
    """M5 / M6: REPLACE INTO by sub_id — changed keys take the last change row."""
    latest = latest_per_key(changes, order)
    kept = lookup(facts, key_lookup(latest), [("sub_id", "sub_id")], {}, how="left_anti",
                  salt_cols=["sub_id"])
    return kept.unionByName(latest.drop(order))


def apply_increment(facts: DataFrame, deletes: DataFrame, adds: DataFrame,
                    changes: DataFrame, order: str) -> DataFrame:
    """M8: delete, then replace adds, then replace changes — in one plan.

    ``adds`` / ``changes`` are resolved rows carrying ``order`` (load order
    within their batch).  Changes outrank adds; within a batch the later line
    wins.  Base rows survive unless their sub_id is deleted or replaced.
    """
    pri = F.struct(F.lit(1).alias("batch"), F.col(order).alias("o"))
    prc = F.struct(F.lit(2).alias("batch"), F.col(order).alias("o"))
    batch = (adds.withColumn("_prio", pri).drop(order)
             .unionByName(changes.withColumn("_prio", prc).drop(order)))
    latest = latest_per_key(batch, "_prio").drop("_prio")
    touched = deletes.select("sub_id").unionByName(latest.select("sub_id"))
    kept = lookup(facts, key_lookup(touched), [("sub_id", "sub_id")], {}, how="left_anti",
                  salt_cols=["sub_id"])
    return kept.unionByName(latest.select(*facts.columns))


# ------------------------------------------------------- tagged change set

#: Actions of a batch in the order they apply (fixed).
ACTIONS = ("delete", "add", "chg")


def action_rank(kind) -> Column:
    """0, 1, 2 for delete, add, chg."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(ACTIONS):
        out = F.when(kind == name, F.lit(i)).otherwise(out)
    return out


def tag_changes(actions: DataFrame, order: str) -> DataFrame:
    """One row per sub_id of ``actions`` (sub_id, kind, y2, ``order``): deleted,
    adds, chgs, and ``last`` = (rank, o, y2) of the action that has the last
    word.  Partial aggregates absorb a hot sub_id; rows without a number (0)
    change nothing."""
    kind = F.col("kind")
    last = F.struct(action_rank(kind).alias("rank"), F.col(order).alias("o"), F.col("y2").alias("y2"))
    return (actions.where((F.col("sub_id") != 0) & kind.isin(*ACTIONS)).groupBy("sub_id").agg(
        F.max(kind == "delete").alias("deleted"), F.count(F.when(kind == "add", 1)).alias("adds"),
        F.count(F.when(kind == "chg", 1)).alias("chgs"), F.max(last).alias("last")))


def meet_base(tags: DataFrame, base: DataFrame) -> DataFrame:
    """``tags`` with ``base_y2``, the cycle of the production row of that
    sub_id (NULL: there is none): the only pass over the base's keys."""
    table = Lookup.of(tags.select("sub_id"))
    hits = lookup(base.select("sub_id", F.col("y2").alias("base_y2")), table, [("sub_id", "sub_id")], {},
                  how="left_semi", salt_cols=["sub_id"])
    return written(tags.join(hits, "sub_id", "left"), "met")


def change_counts(met: DataFrame) -> DataFrame:
    """(metric, value) of a batch: rows deleted; rows that the add and the
    change step touched, a replaced row counting twice (once removed, once
    inserted); new sub_ids inserted; and production rows replaced."""
    there = F.col("base_y2").isNotNull()
    stays = there & ~F.col("deleted")
    named = F.col("adds") + F.col("chgs") > 0

    def one(c: Column) -> Column:
        return F.when(c, 1).otherwise(0)

    counts = {
        "indiv deleted": one(there & F.col("deleted")),
        "indiv added": F.when(F.col("adds") > 0, 2 * F.col("adds") - 1 + one(stays)),
        "indiv changed": F.when(F.col("chgs") > 0, 2 * F.col("chgs") - 1 + one(stays | (F.col("adds") > 0))),
        "indiv inserted": one(named & ~stays),
        "indiv replaced": one(named & stays),
    }
    row = met.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in counts.items()])
    stacked = ", ".join(f"'{n}', `{n}`" for n in counts)
    return row.select(F.expr(f"stack({len(counts)}, {stacked}) AS (metric, value)"))


def touched_cycles(met: DataFrame) -> list[str]:
    """Cycles that a batch rewrites: of production rows with a named sub_id,
    and of the rows that come in (a handful of values)."""
    into = F.when(F.col("last.rank") > 0, F.col("last.y2"))
    both = met.select(F.explode(F.array("base_y2", into)).alias("y2")).where("y2 is not null")
    return sorted(r["y2"] for r in both.distinct().collect())


def winners(staged: DataFrame, met: DataFrame, kind: str, order: str) -> DataFrame:
    """The staged rows of one action kind that have the last word."""
    mine = Lookup.of(met.where(F.col("last.rank") == ACTIONS.index(kind)).select(
        "sub_id", F.col("last.o").alias("o")))
    out = lookup(staged, mine, [("sub_id", "sub_id")], {"_o": "o"}, how="inner", salt_cols=["sub_id"])
    return out.where(F.col("_o") == F.col(order)).drop("_o")


def rewritten(base: DataFrame, met: DataFrame, rows: DataFrame) -> DataFrame:
    """Base rows whose sub_id no action names, and the winning ``rows``."""
    gone = Lookup.of(met.where("base_y2 is not null").select("sub_id"))
    kept = lookup(base, gone, [("sub_id", "sub_id")], {}, how="left_anti", salt_cols=["sub_id"])
    return kept.unionByName(rows.select(*base.columns))

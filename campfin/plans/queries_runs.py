"""Registered queries: versioned publish (K1, S14), run log (K2, W1), whole
runs over zip feeds (W3-W6, G7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from campfin.operators.history import mode_at, newest_event, with_note
from campfin.plans import runs
from campfin.plans.feeds import full_feed, incremental_feed, write_feed
from campfin.plans.registry import ORACLE, RESOLVE_COLS, WIDE_SQL, register, resolve_sql, resolved, wide
from campfin.plans.standins import STANDIN_SQL, build, read_table
from campfin.plans.tables import TableStore
from campfin.session import scratch_path
from campfin.streaming import increments


@register("full_refresh_indiv", resolve_sql(WIDE_SQL, RESOLVE_COLS))
def q_full_refresh_indiv(spark, sf_dir):
    """Publish the resolved load twice (the second publish switches versions
    while the first stays readable) and read the current version back."""
    s = build(spark, sf_dir)
    store = TableStore(spark)
    rows = resolved(s, wide(s.sindiv()))
    store.publish("indiv", rows.where(F.col("sub_id") < 0))  # an empty first version
    store.publish("indiv", rows)
    return store.read("indiv").select(*RESOLVE_COLS)


# --------------------------------------------------------------- run log

# A run log per order priority: id = order key, date = order date, event from
# the order status (F -> success, O -> begin, otherwise failure).
def _history(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("log"), F.col("o_orderkey").cast("long").alias("id"),
        F.col("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "s").when(F.col("o_orderstatus") == "O", "b")
        .otherwise("f").alias("eventType"),
        F.col("o_orderpriority").alias("shortMessage"), F.lit("").alias("longMessage"))


_HIST_CTE = """-- cte
hist AS (SELECT o_orderpriority AS log, o_orderkey AS id, o_orderdate AS date,
                CASE o_orderstatus WHEN 'F' THEN 's' WHEN 'O' THEN 'b' ELSE 'f' END AS eventType,
                o_orderpriority AS shortMessage, '' AS longMessage
         FROM orders)"""
_OFFSETS = (1, 12, 13, 14, 30)


@register("decide_mode", _HIST_CTE + """,
newest AS (SELECT h.* FROM hist AS h
           WHERE h.id = (SELECT max(id) FROM hist AS x WHERE x.log = h.log)),
nows AS (SELECT n.*, d AS days_after, n.date + d * INTERVAL 1 DAY AS now
         FROM newest AS n, (VALUES """ + ", ".join(f"({d})" for d in _OFFSETS) + """) AS t(d))
SELECT log, days_after,
       CAST(CASE WHEN eventType = 's' AND date > now - INTERVAL 13 DAY THEN 1 ELSE 0 END
            AS bigint) AS c,
       CASE WHEN eventType = 's' AND date > now - INTERVAL 13 DAY
            THEN 'incremental' ELSE 'full' END AS mode
FROM nows""")
def q_decide_mode(spark, sf_dir):
    """W1 for each log at 1, 12, 13, 14 and 30 days after its newest event."""
    newest = newest_event(_history(spark, sf_dir), by=("log",))
    at = newest.select("*", F.explode(F.array(*[F.lit(d) for d in _OFFSETS])).alias("days_after"))
    now = F.col("date") + F.make_dt_interval(F.col("days_after"))
    return mode_at(at, now).select("log", "days_after", "c", "mode")


@register("history_append", _HIST_CTE + """
SELECT id, date, eventType, shortMessage, longMessage FROM hist
UNION ALL
SELECT max(id) + 1, max(date) + INTERVAL 1 DAY, 's', 'Run complete',
       concat(CAST(count(*) AS string), ' rows logged before') FROM hist""")
def q_history_append(spark, sf_dir):
    """K2: one log (all orders) plus a success note: id = max(id) + 1."""
    h = _history(spark, sf_dir).drop("log")
    return with_note(h, "s", "Run complete",
                     F.concat(F.count(F.lit(1)).cast("string"), F.lit(" rows logged before")),
                     now=F.max("date") + F.make_dt_interval(F.lit(1)))


# ------------------------------------------------------------ whole runs

# Values as loaded from the feed lines (see rawlines): amounts with junk keep
# their number, empty amounts are 0, short lines lose their sub_id (0).
_PARSED = """-- cte
p AS (
  SELECT y2, cmte_id, k, transaction_amt AS amt0,
         CASE WHEN k % 19 = 0 THEN CAST(0 AS decimal(19,0)) ELSE sub_id END AS sid
  FROM src),
srcp AS (
  SELECT *, CASE WHEN k % 13 = 0 THEN amt0 WHEN k % 17 = 0 THEN CAST(0 AS decimal(14,2))
                 ELSE amt0 END AS amt FROM p)"""


def _amt(expr: str) -> str:
    return (f"CASE WHEN k % 13 = 0 THEN {expr} WHEN k % 17 = 0 THEN CAST(0 AS decimal(14,2)) "
            f"ELSE {expr} END")


_META = """
SELECT cm.id AS cm_id, CAST(sum(r.amt) AS decimal(24,2)) AS contribSum,
       count(r.sid) AS contribCount
FROM {rows} AS r JOIN cm ON r.cmte_id = cm.cm_id AND r.y2 = cm.y2
GROUP BY cm.id"""


@register("full_run_cm_meta", _PARSED + _META.format(rows="(SELECT * FROM srcp WHERE sid <> 0)"))
def q_full_run_cm_meta(spark, sf_dir):
    """A full run over a zip feed of the stand-ins; the resulting cmMeta."""
    s = build(spark, sf_dir)
    feed = write_feed(spark, full_feed(s))
    result = runs.run(spark, TableStore(spark), feed, mode=runs.FULL)
    return result.store.read("cmMeta")


@register("incremental_run_cm_meta", _PARSED + f""",
prev AS (SELECT y2, cmte_id, sid, amt, 0 AS prio, 0 AS ord FROM srcp
         WHERE k % 5 <> 4 AND sid <> 0
           AND sid NOT IN (SELECT sub_id FROM src WHERE k % 10 IN (7, 9))),
adds AS (SELECT y2, cmte_id, sid, {_amt("CAST(amt0 + 1 AS decimal(14,2))")} AS amt,
                1 AS prio, k AS ord
         FROM p WHERE (k % 5 = 4 OR k % 10 = 0) AND sid <> 0),
chg AS (SELECT y2, cmte_id, sid, {_amt("CAST(amt0 * 2 AS decimal(14,2))")} AS amt,
               2 AS prio, k AS ord
        FROM p WHERE (k % 10 = 3 OR k % 20 = 7) AND sid <> 0),
allrows AS (SELECT * FROM prev UNION ALL SELECT * FROM adds UNION ALL SELECT * FROM chg),
latest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY sid ORDER BY prio DESC, ord DESC) AS rn
  FROM allrows) AS x WHERE rn = 1)""" + _META.format(rows="latest"))
def q_incremental_run_cm_meta(spark, sf_dir):
    """A full run over the previous state, then an incremental run over
    add / change / delete archives; the resulting cmMeta."""
    s = build(spark, sf_dir)
    store = TableStore(spark)
    runs.run(spark, store, write_feed(spark, full_feed(s, s.prev_indiv_src())), mode=runs.FULL)
    runs.run(spark, store, write_feed(spark, incremental_feed(s)), mode=runs.INCREMENTAL)
    return store.read("cmMeta")


@register("land_bronze_counts", """
SELECT 'cn' AS kind, y2, count(*) AS lines FROM scn GROUP BY y2
UNION ALL SELECT 'cm', y2, count(*) FROM scm GROUP BY y2
UNION ALL SELECT 'indiv', y2, count(*) FROM src GROUP BY y2
UNION ALL SELECT 'oth', y2, count(*) FROM src GROUP BY y2
UNION ALL SELECT 'pas2', y2, count(*) FROM src GROUP BY y2""")
def q_land_bronze_counts(spark, sf_dir):
    """S3 + S4 + S11 + K3: a full feed's archives landed as bronze lines; the
    kind and cycle of every line come from its archive's name."""
    s = build(spark, sf_dir)
    bronze = runs.land(spark, write_feed(spark, full_feed(s)), runs.FULL)
    return bronze.groupBy("kind", "y2").agg(F.count(F.lit(1)).alias("lines"))


@register("run_report", _PARSED + """
SELECT 'lines cn' AS metric, count(*) AS value FROM scn
UNION ALL SELECT 'lines cm', count(*) FROM scm
UNION ALL SELECT 'lines indiv', count(*) FROM src
UNION ALL SELECT 'lines oth', count(*) FROM src
UNION ALL SELECT 'lines pas2', count(*) FROM src
UNION ALL SELECT 'cn matched', 0 UNION ALL SELECT 'cn updated', 0
UNION ALL SELECT 'cn inserted', count(*) FROM scn
UNION ALL SELECT 'cm matched', 0 UNION ALL SELECT 'cm updated', 0
UNION ALL SELECT 'cm inserted', count(*) FROM scm
UNION ALL SELECT 'pas2 duplicates dropped', 0
UNION ALL SELECT 'oth duplicates dropped', 0
UNION ALL SELECT 'indiv duplicates dropped', 0
UNION ALL SELECT 'pas2 rows', count(*) FROM srcp WHERE sid <> 0
UNION ALL SELECT 'oth rows', count(*) FROM srcp WHERE sid <> 0
UNION ALL SELECT 'indiv rows', count(*) FROM srcp WHERE sid <> 0
UNION ALL SELECT 'cmMeta rows', count(DISTINCT cm.id)
          FROM srcp AS r JOIN cm ON r.cmte_id = cm.cm_id AND r.y2 = cm.y2 WHERE r.sid <> 0""")
def q_run_report(spark, sf_dir):
    """The counts a full run reports."""
    s = build(spark, sf_dir)
    feed = write_feed(spark, full_feed(s))
    return runs.run(spark, TableStore(spark), feed, mode=runs.FULL).report


_INCREMENTAL_META = ORACLE["incremental_run_cm_meta"][len(STANDIN_SQL):].lstrip(", \n")


def _previous_state(spark, sf_dir):
    s = build(spark, sf_dir)
    store = TableStore(spark)
    runs.run(spark, store, write_feed(spark, full_feed(s, s.prev_indiv_src())), mode=runs.FULL)
    return s, store


def _until_done(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


# Counts of the incremental run, step by step: what stands after each step, and
# how many rows a step removes and inserts.
@register("incremental_run_report", _PARSED + """,
base AS (SELECT sid FROM srcp WHERE k % 5 <> 4 AND sid <> 0),
del AS (SELECT DISTINCT sub_id AS sid FROM src WHERE k % 10 IN (7, 9)),
adds AS (SELECT sid FROM p WHERE (k % 5 = 4 OR k % 10 = 0) AND sid <> 0),
chgs AS (SELECT sid FROM p WHERE (k % 10 = 3 OR k % 20 = 7) AND sid <> 0),
rest AS (SELECT sid FROM base WHERE sid NOT IN (SELECT sid FROM del)),
added AS (SELECT sid FROM rest UNION SELECT sid FROM adds),
final AS (SELECT sid FROM added UNION SELECT sid FROM chgs),
named AS (SELECT sid FROM adds UNION SELECT sid FROM chgs),
allrows AS (
  SELECT y2, cmte_id, sid, 0 AS prio, k FROM srcp WHERE k % 5 <> 4 AND sid <> 0
  UNION ALL SELECT y2, cmte_id, sid, 1, k FROM p WHERE (k % 5 = 4 OR k % 10 = 0) AND sid <> 0
  UNION ALL SELECT y2, cmte_id, sid, 2, k FROM p WHERE (k % 10 = 3 OR k % 20 = 7) AND sid <> 0),
latest AS (SELECT * FROM allrows
           QUALIFY row_number() OVER (PARTITION BY sid ORDER BY prio DESC, k DESC) = 1)
SELECT 'lines cn' AS metric, count(*) AS value FROM scn
UNION ALL SELECT 'lines cm', count(*) FROM scm
UNION ALL SELECT 'lines add', count(*) FROM src WHERE k % 5 = 4 OR k % 10 = 0
UNION ALL SELECT 'lines chg', count(*) FROM src WHERE k % 10 = 3 OR k % 20 = 7
UNION ALL SELECT 'lines delete', count(*) FROM src WHERE k % 10 IN (7, 9)
UNION ALL SELECT 'lines oth', count(*) FROM src
UNION ALL SELECT 'lines pas2', count(*) FROM src
UNION ALL SELECT 'cn matched', count(*) FROM scn UNION ALL SELECT 'cn updated', 0
UNION ALL SELECT 'cn inserted', 0
UNION ALL SELECT 'cm matched', count(*) FROM scm UNION ALL SELECT 'cm updated', 0
UNION ALL SELECT 'cm inserted', 0
UNION ALL SELECT 'pas2 duplicates dropped', 0
UNION ALL SELECT 'oth duplicates dropped', 0
UNION ALL SELECT 'pas2 rows', count(*) FROM srcp WHERE sid <> 0
UNION ALL SELECT 'oth rows', count(*) FROM srcp WHERE sid <> 0
UNION ALL SELECT 'indiv deleted', count(*) FROM base WHERE sid IN (SELECT sid FROM del)
UNION ALL SELECT 'indiv added', count(*) + count(*) FILTER (sid IN (SELECT sid FROM rest)) FROM adds
UNION ALL SELECT 'indiv changed', count(*) + count(*) FILTER (sid IN (SELECT sid FROM added)) FROM chgs
UNION ALL SELECT 'indiv inserted', count(*) FROM named WHERE sid NOT IN (SELECT sid FROM rest)
UNION ALL SELECT 'indiv replaced', count(*) FROM named WHERE sid IN (SELECT sid FROM rest)
UNION ALL SELECT 'indiv rows', count(*) FROM (
  SELECT sid FROM rest WHERE sid NOT IN (SELECT sid FROM named) UNION ALL SELECT sid FROM named) x
UNION ALL SELECT 'cmMeta rows', count(DISTINCT cm.id)
          FROM latest AS r JOIN cm ON r.cmte_id = cm.cm_id AND r.y2 = cm.y2
          WHERE r.prio > 0 OR r.sid NOT IN (SELECT sid FROM del)""")
def q_incremental_run_report(spark, sf_dir):
    """The counts an incremental run reports, from its tagged change set."""
    s, store = _previous_state(spark, sf_dir)
    return runs.run(spark, store, write_feed(spark, incremental_feed(s)), mode=runs.INCREMENTAL).report


@register("stream_changes_cm_meta", _INCREMENTAL_META)
def q_stream_changes_cm_meta(spark, sf_dir):
    """The change stream: a full run over the previous state, the change
    archives landed as bronze lines, then applied by a Structured Streaming
    query (available-now trigger); the resulting cmMeta equals the
    incremental run's."""
    s, store = _previous_state(spark, sf_dir)
    bronze = scratch_path(spark, "bronze-changes")
    increments.land_delivery(spark, write_feed(spark, incremental_feed(s)), bronze, 1)
    _until_done(increments.start(spark, store, bronze))
    return store.read("cmMeta")


@register("stream_split_delivery_cm_meta", _INCREMENTAL_META)
def q_stream_split_delivery_cm_meta(spark, sf_dir):
    """A delivery that arrives over three polls in the wrong order (changes,
    then adds, then deletes) gives what it gives whole."""
    s, store = _previous_state(spark, sf_dir)
    lines = runs.land(spark, write_feed(spark, incremental_feed(s)), runs.INCREMENTAL)
    bronze, checkpoint = scratch_path(spark, "bronze-split"), scratch_path(spark, "split-checkpoint")
    for kind in ("chg", "add", "delete"):
        lines.where(F.col("kind") == kind).write.mode("append").partitionBy("kind").parquet(f"{bronze}/delivery=1")
        _until_done(increments.start(spark, store, bronze, checkpoint))
    return store.read("cmMeta")

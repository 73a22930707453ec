"""Registered queries: file catalog (S1, X10), manifest diff (S2), archive
discovery (S3, X9), zip line source (S4, S5, S11).

The cycle years come from the orders' dates (first even cycle up to the
last order year); file listings are derived from per-cycle order counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from campfin.functions.text import ESCAPE
from campfin.sources.catalog import classify_archives, discover, expected_files_for, manifest_diff
from campfin.sources.ziplines import encoding_of, read_archives, read_zip_lines, write_archives
from campfin.plans.rawlines import line_sql, render_lines
from campfin.plans.registry import register
from campfin.plans.standins import build, read_table
from campfin.schemas import KINDS
from campfin.session import scratch_path

_KINDS_SQL = ", ".join(f"({i + 1}, '{k}')" for i, k in enumerate(KINDS))

_EXPECTED_CTE = f"""-- cte
bounds AS (SELECT min(year(o_orderdate)) + min(year(o_orderdate)) % 2 AS y0,
                  max(year(o_orderdate)) AS y1 FROM orders),
years AS (SELECT CAST(unnest(generate_series(y0, y1, 2)) AS int) AS year FROM bounds),
kinds AS (SELECT * FROM (VALUES {_KINDS_SQL}) AS t(kind_no, kind)),
expected AS (
  SELECT year, right(CAST(year AS string), 2) AS y2, kind_no, kind,
         concat(CAST(year AS string), '/', kind, right(CAST(year AS string), 2), '.zip') AS path
  FROM years, kinds)"""


def _years(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    b = o.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    return b.select(F.explode(F.sequence(F.col("lo") + F.col("lo") % 2, F.col("hi"), F.lit(2)))
                    .alias("year"))


@register("expected_files", _EXPECTED_CTE + "\nSELECT * FROM expected")
def q_expected_files(spark, sf_dir):
    return expected_files_for(_years(spark, sf_dir))


# Listings: remote lacks a file where (n + kind_no) % 7 = 0; local lacks one where
# (n + kind_no) % 3 = 0 and is one byte off where (n + kind_no) is odd.
_LISTINGS_CTE = _EXPECTED_CTE + """,
counts AS (SELECT y2, count(*) AS n FROM o GROUP BY y2),
sized AS (SELECT e.path, c.n + e.kind_no AS t, c.n * 100 + e.kind_no AS sz
          FROM expected AS e JOIN counts AS c ON c.y2 = e.y2),
remote AS (SELECT path, sz AS size FROM sized WHERE t % 7 <> 0),
loc AS (SELECT path, CASE WHEN t % 2 = 0 THEN sz ELSE sz + 1 END AS size
        FROM sized WHERE t % 3 <> 0)"""


@register("manifest_diff", _LISTINGS_CTE + """
SELECT e.path,
       CASE WHEN r.path IS NULL THEN 'not found' WHEN l.path IS NULL THEN 'new'
            WHEN l.size <> r.size THEN 'changed' ELSE 'unchanged' END AS status,
       CAST(l.size AS bigint) AS local_size, CAST(r.size AS bigint) AS remote_size
FROM expected AS e LEFT JOIN remote AS r ON r.path = e.path LEFT JOIN loc AS l ON l.path = e.path""")
def q_manifest_diff(spark, sf_dir):
    s = build(spark, sf_dir)
    expected = expected_files_for(_years(spark, sf_dir))
    counts = s.o.groupBy("y2").agg(F.count(F.lit(1)).alias("n"))
    sized = expected.join(counts, "y2").select(
        "path", (F.col("n") + F.col("kind_no")).alias("t"),
        (F.col("n") * 100 + F.col("kind_no")).alias("sz"))
    remote = sized.where(F.col("t") % 7 != 0).select("path", F.col("sz").alias("size"))
    local = sized.where(F.col("t") % 3 != 0).select(
        "path", F.when(F.col("t") % 2 == 0, F.col("sz")).otherwise(F.col("sz") + 1).alias("size"))
    return manifest_diff(expected, local, remote)


# Candidate paths: every expected file, plus an upper-case spelling
# (kind_no % 3 = 0), a backup copy (kind_no = 4), a prefixed name (kind_no = 5)
# and a name without cycle (kind_no = 6); only well-formed names may match.
_PATHS_CTE = _EXPECTED_CTE + """,
paths AS (
  SELECT concat('feed/', path) AS path FROM expected
  UNION ALL SELECT concat('feed/', CAST(year AS string), '/', upper(kind), y2, '.ZIP')
            FROM expected WHERE kind_no % 3 = 0
  UNION ALL SELECT concat('feed/', path, '.bak') FROM expected WHERE kind_no = 4
  UNION ALL SELECT concat('feed/', CAST(year AS string), '/x', kind, y2, '.zip')
            FROM expected WHERE kind_no = 5
  UNION ALL SELECT concat('feed/', CAST(year AS string), '/', kind, '.zip')
            FROM expected WHERE kind_no = 6),
named AS (
  SELECT path,
         lower(regexp_extract(regexp_extract(path, '([^/]+)$', 1), '{pat}', 1)) AS kind,
         regexp_extract(regexp_extract(path, '([^/]+)$', 1), '{pat}', 2) AS y2
  FROM paths)"""


@register("archive_discovery", _PATHS_CTE.replace(
    "{pat}", r"(?i)^(cm|cn|add|chg|delete|indiv|oth|pas2)(\d\d)\.zip$") + """
SELECT 'full' AS mode, path, kind, y2 FROM named
WHERE kind IN ('cn', 'cm', 'indiv', 'oth', 'pas2')
UNION ALL
SELECT 'incremental', path, kind, y2 FROM named
WHERE kind IN ('cn', 'cm', 'add', 'chg', 'delete', 'oth', 'pas2')""")
def q_archive_discovery(spark, sf_dir):
    e = expected_files_for(_years(spark, sf_dir))
    yr = F.col("year").cast("string")
    pre = F.lit("feed/")
    paths = (e.select(F.concat(pre, "path").alias("path"))
             .unionByName(e.where(F.col("kind_no") % 3 == 0).select(
                 F.concat(pre, yr, F.lit("/"), F.upper("kind"), "y2", F.lit(".ZIP")).alias("path")))
             .unionByName(e.where(F.col("kind_no") == 4).select(
                 F.concat(pre, "path", F.lit(".bak")).alias("path")))
             .unionByName(e.where(F.col("kind_no") == 5).select(
                 F.concat(pre, yr, F.lit("/x"), "kind", "y2", F.lit(".zip")).alias("path")))
             .unionByName(e.where(F.col("kind_no") == 6).select(
                 F.concat(pre, yr, F.lit("/"), "kind", F.lit(".zip")).alias("path"))))
    full = classify_archives(paths, "full").select(F.lit("full").alias("mode"), "path", "kind", "y2")
    inc = classify_archives(paths, "incremental").select(
        F.lit("incremental").alias("mode"), "path", "kind", "y2")
    return full.unionByName(inc)


@register("zip_lines", f"""
SELECT y2, 'indiv' AS kind, {line_sql("indiv")} AS value FROM src""")
def q_zip_lines(spark, sf_dir):
    """Contribution lines written as zip archives (parts per cycle) to the
    shared folder, read back through the zip line source; y2 and kind come
    from the archive names."""
    s = build(spark, sf_dir)
    root = scratch_path(spark, "zip-lines")
    write_archives(render_lines(s.sindiv(), "indiv", "k"), root, "indiv").count()
    lines = read_zip_lines(spark, root, escape=ESCAPE)
    named = classify_archives(lines, "full")
    return named.select("y2", "kind", "value")


# Text with a letter outside ASCII, written as ISO-8859-1 for cycles 96 and 00
# and as UTF-8 for the others; 00 is read by the wrong encoding, so its letter
# is one byte that can't be decoded.
@register("zip_encodings", """
SELECT y2, 'oth' AS kind,
       concat('Caf', CASE WHEN y2 = '00' THEN chr(65533) ELSE chr(233) END, ' ', CAST(k AS string)) AS value,
       CAST(CASE WHEN y2 = '00' THEN 1 ELSE 0 END AS int) AS replaced FROM src""")
def q_zip_encodings(spark, sf_dir):
    """Archives of two encodings read in one pass, each by its own; bytes
    that can't be decoded are replaced and counted."""
    s = build(spark, sf_dir)
    root = scratch_path(spark, "zip-encodings")
    lines = s.src.select("y2", F.concat(F.lit("Caf\u00e9 "), F.col("k").cast("string")).alias("value"),
                         F.col("k").alias("_order"))
    old = F.col("y2").isin("96", "00")
    write_archives(lines.where(old), root, "oth", encoding="iso-8859-1").count()
    write_archives(lines.where(~old), root, "oth").count()
    found = discover(spark, root, "full").collect()  # one row per archive
    archives = [(r["path"], i, r["kind"], r["y2"], encoding_of(r["path"], [("oth96", "iso-8859-1")]))
                for i, r in enumerate(sorted(found, key=lambda r: r["path"]))]
    return read_archives(spark, archives).select("y2", "kind", "value", "replaced")

"""Query of operator 7 and its oracle, which runs every rule on every URL."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.urls import HOST_RULES, PATTERN_RULES, judge_urls


def op7_url_rules(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql() -> str:
    hosts = ", ".join(f"({_quoted(r.host)}, {_quoted(r.path)}, {_quoted(r.verdict)})"
                      for r in HOST_RULES)
    pats = ", ".join(f"({_quoted(r.name)}, {_quoted(r.pattern)}, {_quoted(r.verdict)})"
                     for r in PATTERN_RULES)
    return f"""
    WITH host_rules(h, p, v) AS (VALUES {hosts}),
    pattern_rules(name, pat, v) AS (VALUES {pats}),
    cut AS (
      SELECT page_id, coalesce(url, '') AS u,
             CASE WHEN position('://' IN url) > 0
                  THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS u,
             translate(regexp_extract(rest, '^([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut),
    judged AS (
      SELECT page_id, host, path,
             (SELECT arg_max(h || p, length(h || p)) FROM host_rules
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
             (SELECT arg_max(v, length(h || p)) FROM host_rules
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rv,
             (SELECT string_agg(name, ',' ORDER BY name) FROM pattern_rules
              WHERE regexp_matches(u, pat)) AS fired,
             (SELECT count(*) FROM pattern_rules
              WHERE v = 'block' AND regexp_matches(u, pat)) AS blocks
      FROM parts)
    SELECT page_id, host, path, rule,
           coalesce(rv, CASE WHEN blocks > 0 THEN 'block' ELSE 'allow' END) AS verdict,
           coalesce(fired, '') AS patterns
    FROM judged"""


QUERIES = {"op7_url_rules": op7_url_rules}
ORACLE = {"op7_url_rules": _sql()}

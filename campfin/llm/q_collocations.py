"""Query of operator 11 and its SQL."""

from __future__ import annotations

from campfin.llm.collocations import mine_phrases
from campfin.llm.common import LOWER, UPPER, table


def op11_phrase_collocations(spark, sf_dir):
    return mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {"op11_phrase_collocations": op11_phrase_collocations}

ORACLE = {"op11_phrase_collocations": rf"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
freq AS (
  SELECT lang, m, p, count(*)::HUGEINT AS f
  FROM (SELECT lang, m, ws[i:i + m - 1] AS p FROM starts, range(1, 6) t(m) WHERE i + m - 1 <= len(ws))
  GROUP BY lang, m, p HAVING count(*) >= 100),
contained AS (
  SELECT DISTINCT s.lang, s.p
  FROM freq s JOIN (SELECT lang, f, p[:-2] AS part FROM freq WHERE m > 2
                    UNION ALL SELECT lang, f, p[2:] FROM freq WHERE m > 2) b
    ON s.lang = b.lang AND s.p = b.part
  WHERE 100 * b.f >= 100 * s.f),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r, n, (1000 * c.f * n) // (x.f * y.f) AS score
  FROM (SELECT lang, p, m, f, unnest(range(1, m)) AS k FROM freq WHERE m > 1) c
  JOIN freq x ON x.lang = c.lang AND x.p = c.p[:k]
  JOIN freq y ON y.lang = c.lang AND y.p = c.p[k + 1:]
  JOIN totals t ON t.lang = c.lang
  WHERE NOT EXISTS (SELECT 1 FROM contained d WHERE d.lang = c.lang AND d.p = c.p)),
weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS nth FROM cuts),
ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM weakest WHERE nth = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""}

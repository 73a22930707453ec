"""Raw filing lines rendered from the stand-ins, with the values a loader must
read back from them.

Each spec row is ``(field, raw_sql, expected_sql)`` in file order: the text
written into the line, and the typed value parsing must give.  Both are SQL
expressions valid on Spark and DuckDB over the stand-in row (``n`` / ``k``
is the numeric part of the row's key).  The lines include the awkward cases
of a real feed: empty fields, ``\\N``, trailing spaces in fixed-width
fields, overlong text, numbers with junk after them, short and long lines,
escaped bars, escape characters and line ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campfin.session import spread

NULL_MARK_SQL = "concat(chr(92), 'N')"
NULL_STR = "CAST(NULL AS string)"

CN_SPEC = [
    ("cn_id", "cn_id", "cn_id"),
    ("name", "name", "name"),
    ("party", "party", "party"),
    ("election_year",
     "CASE n % 4 WHEN 0 THEN '' WHEN 1 THEN concat('19', y2, 'x') ELSE concat('20', y2) END",
     "CAST(CASE n % 4 WHEN 0 THEN '0' WHEN 1 THEN concat('19', y2) ELSE concat('20', y2) END"
     " AS decimal(4,0))"),
    ("office_state", "concat(state, ' ')", "rtrim(left(concat(state, ' '), 2))"),
    ("office", "'H'", "'H'"),
    ("district", NULL_MARK_SQL, NULL_STR),
    ("i_c_status", "'C '", "'C'"),
    ("cn_status", "''", "''"),
    ("cm_id", "concat('C', lpad(CAST(n AS string), 8, '0'))",
     "concat('C', lpad(CAST(n AS string), 8, '0'))"),
    # An escaped bar in every third line, an escaped escape character in every fifth.
    ("street1", "CASE WHEN n % 3 = 1 THEN concat('A', chr(92), '|B ', name) ELSE name END",
     "CASE WHEN n % 3 = 1 THEN concat('A|B ', name) ELSE name END"),
    ("street2", "CASE WHEN n % 5 = 0 THEN concat('C:', chr(92), chr(92), 'N') ELSE '' END",
     "CASE WHEN n % 5 = 0 THEN concat('C:', chr(92), 'N') ELSE '' END"),
    ("city", "concat(name, '-', name)", "left(concat(name, '-', name), 18)"),
    ("state", "state", "state"),
    # A record that goes on over a line end meets its cycle and a bar there; the
    # text after them is a surplus field.
    ("zip", "CASE WHEN n % 11 = 0 THEN concat('9', chr(92), chr(10), 'tail')"
     " ELSE lpad(CAST(n % 100000 AS string), 5, '0') END",
     "CASE WHEN n % 3 = 0 THEN " + NULL_STR + " WHEN n % 11 = 0 THEN concat('9', chr(10), y2)"
     " ELSE lpad(CAST(n % 100000 AS string), 5, '0') END"),
]
CN_SHORT, CN_CUT, CN_LONG = "n % 3 = 0", 1, None

CM_SPEC = [
    ("cm_id", "cm_id", "cm_id"),
    ("name", "name", "name"),
    ("treasurer", "concat('T ', CASE WHEN n % 4 = 1 THEN concat(chr(92), 't', chr(92), '|') ELSE '' END, name)",
     "concat('T ', CASE WHEN n % 4 = 1 THEN concat(chr(9), '|') ELSE '' END, name)"),
    ("street_1", NULL_MARK_SQL, NULL_STR),
    ("street_2", "''", "''"),
    ("city", "concat(name, name)", "left(concat(name, name), 18)"),
    ("state", "'TX'", "'TX'"),
    ("zip", "lpad(CAST(n % 100000 AS string), 5, '0')", "lpad(CAST(n % 100000 AS string), 5, '0')"),
    ("cm_designation", "'P'", "'P'"),
    ("cm_type", "CASE n % 2 WHEN 0 THEN 'H ' ELSE 'S' END", "CASE n % 2 WHEN 0 THEN 'H' ELSE 'S' END"),
    ("party", "party", "party"),
    ("filing_freq", "'Q'", "'Q'"),
    ("interest_group_cat", "''", "''"),
    ("org_name", "concat(name, '   ')", "concat(name, '   ')"),
    ("cn_id", "cn_id", "CASE WHEN n % 3 = 0 THEN " + NULL_STR + " ELSE cn_id END"),
]
CM_SHORT, CM_CUT, CM_LONG = "n % 3 = 0", 1, "n % 5 = 0"

_CONTRIB_HEAD = [
    ("cmte_id", "cmte_id", "cmte_id"),
    ("amndt_ind", "'N'", "'N'"),
    ("rpt_tp", "CASE k % 3 WHEN 0 THEN 'Q1' WHEN 1 THEN 'YE' ELSE 'M10X' END",
     "left(CASE k % 3 WHEN 0 THEN 'Q1' WHEN 1 THEN 'YE' ELSE 'M10X' END, 3)"),
    ("transaction_pgi", "'P2012'", "'P2012'"),
    ("image_num", "lpad(CAST(k AS string), 11, '0')", "lpad(CAST(k AS string), 11, '0')"),
    ("transaction_tp", "'15'", "'15'"),
    ("entity_tp", "'IND'", "'IND'"),
    # Escaped bar, escape character, letter and line end (no cycle follows in contribution files).
    ("name", "concat('DONOR ', CASE k % 29 WHEN 0 THEN concat(chr(92), '|') WHEN 1 THEN concat(chr(92), chr(92))"
     " WHEN 2 THEN concat('x', chr(92), 'N') WHEN 3 THEN concat(chr(92), chr(10), '2 ') ELSE '' END,"
     " CAST(k AS string))",
     "concat('DONOR ', CASE k % 29 WHEN 0 THEN '|' WHEN 1 THEN chr(92) WHEN 2 THEN 'xN'"
     " WHEN 3 THEN concat(chr(10), '2 ') ELSE '' END, CAST(k AS string))"),
    ("city", "concat('CITY ', CAST(k % 97 AS string), '  ')",
     "concat('CITY ', CAST(k % 97 AS string), '  ')"),
    ("state", "CASE k % 2 WHEN 0 THEN 'N ' ELSE 'NY' END", "CASE k % 2 WHEN 0 THEN 'N' ELSE 'NY' END"),
    ("zip_code", "lpad(CAST(k % 100000 AS string), 9, '0')", "lpad(CAST(k % 100000 AS string), 9, '0')"),
    ("employer", "employer", "employer"),
    ("occupation", "occupation", "occupation"),
    ("transaction_dt", "transaction_dt", "transaction_dt"),
    ("transaction_amt",
     "CASE WHEN k % 13 = 0 THEN concat(CAST(transaction_amt AS string), 'USD') "
     "WHEN k % 17 = 0 THEN '' ELSE CAST(transaction_amt AS string) END",
     "CASE WHEN k % 13 = 0 THEN transaction_amt WHEN k % 17 = 0 THEN CAST(0 AS decimal(14,2)) "
     "ELSE transaction_amt END"),
    ("other_id", "other_id", "other_id"),
]
_CONTRIB_TAIL = [
    ("tran_id", "CASE WHEN k % 7 = 0 THEN " + NULL_MARK_SQL + " ELSE concat('T', CAST(k AS string)) END",
     "CASE WHEN k % 7 = 0 THEN " + NULL_STR + " ELSE concat('T', CAST(k AS string)) END"),
    ("file_num", "CAST(k * 3 AS string)", "CAST(k * 3 AS decimal(22,0))"),
    ("memo_cd", "''", "''"),
    ("memo_text", "repeat('m', CAST(k % 150 AS int))",
     "CASE WHEN k % 19 = 0 THEN " + NULL_STR + " ELSE left(repeat('m', CAST(k % 150 AS int)), 100) END"),
    ("sub_id", "CAST(sub_id AS string)",
     "CASE WHEN k % 19 = 0 THEN CAST(0 AS decimal(19,0)) ELSE sub_id END"),
]
CONTRIB_SPEC = _CONTRIB_HEAD + _CONTRIB_TAIL
PAS2_SPEC = _CONTRIB_HEAD + [("cand_id", "cand_id", "cand_id")] + _CONTRIB_TAIL
CONTRIB_SHORT, CONTRIB_CUT, CONTRIB_LONG = "k % 19 = 0", 2, "k % 23 = 0"

DELETE_SPEC = [("sub_id", "CAST(sub_id AS string)", "sub_id")]
DELETE_SHORT, DELETE_CUT, DELETE_LONG = None, 0, "k % 2 = 1"

SPECS = {
    "cn": (CN_SPEC, CN_SHORT, CN_CUT, CN_LONG, "CAST(substring(cn_id, 2) AS int)"),
    "cm": (CM_SPEC, CM_SHORT, CM_CUT, CM_LONG, "CAST(substring(cm_id, 2) AS int)"),
    "indiv": (CONTRIB_SPEC, CONTRIB_SHORT, CONTRIB_CUT, CONTRIB_LONG, None),
    "pas2": (PAS2_SPEC, CONTRIB_SHORT, CONTRIB_CUT, CONTRIB_LONG, None),
    "delete": (DELETE_SPEC, DELETE_SHORT, DELETE_CUT, DELETE_LONG, None),
}


def line_sql(kind: str) -> str:
    """SQL for the whole raw line: fields joined by '|', the last ``cut``
    fields left off where ``short`` holds, surplus fields where only ``long`` holds."""
    spec, short, cut, long, _n = SPECS[kind]
    raws = [r for _f, r, _e in spec]
    head, tail = raws[:len(raws) - cut], raws[len(raws) - cut:]
    parts = []
    for i, r in enumerate(head):
        parts.append(r if i == 0 else f"'|', {r}")
    if tail:
        t = ", ".join(f"'|', {r}" for r in tail)
        parts.append(f"CASE WHEN {short} THEN '' ELSE concat({t}) END")
    if long:
        cond = f"({long}) AND NOT ({short})" if short else long
        parts.append(f"CASE WHEN {cond} THEN '|SURPLUS|x' ELSE '' END")
    return "concat(" + ", ".join(parts) + ")"


def with_n(df: DataFrame, kind: str) -> DataFrame:
    n = SPECS[kind][4]
    return df.withColumn("n", F.expr(n)) if n else df


def render_lines(df: DataFrame, kind: str, order: str) -> DataFrame:
    """(y2, value, _order) lines of stand-in rows, rendered on Spark (spread
    first when the input is under-split: rendering is the heavy per-row work)."""
    base = with_n(spread(df), kind)
    cols = ["y2"] if "y2" in base.columns else []
    return base.select(*cols, F.expr(line_sql(kind)).alias("value"),
                       F.expr(order).alias("_order"))


def expected_sql(kind: str, source: str, with_y2: bool = True, extra: tuple[str, ...] = ()) -> str:
    """Oracle SELECT of the parsed values of ``source`` rows (and of ``extra``
    columns before them)."""
    spec, *_rest, n = SPECS[kind]
    exprs = ", ".join([*extra, *(["y2"] if with_y2 else []), *[f"{e} AS {f}" for f, _r, e in spec]])
    src = f"(SELECT *, {n} AS n FROM {source})" if n else source
    return f"SELECT {exprs} FROM {src} AS t"


def typed(df: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Stand-in rows with every field of their file layout, typed, as parsing
    their lines would give them."""
    base = with_n(df, kind)
    return base.select(*extra, "y2", *[F.expr(e).alias(f) for f, _r, e in SPECS[kind][0]])


# Change rows differ from what they replace in every field.
_MARKED = ("amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code "
           "employer occupation tran_id memo_cd memo_text").split()


def marked_fields(mark: str, n: int) -> dict[str, str]:
    """SQL of the fields of a change row, by name: text gets a mark, the file
    number grows, the date is another, the other party is the candidate."""
    out = {c: f"({c} || '{mark}')" for c in _MARKED}  # NULL stays NULL
    return out | {"file_num": f"CAST(file_num + {n} AS decimal(22,0))", "transaction_dt": f"'1231199{n}'",
                  "other_id": "cand_id"}


def marked(df: DataFrame, mark: str, n: int) -> DataFrame:
    new = marked_fields(mark, n)
    return df.select(*[F.expr(new[c]).alias(c) if c in new else F.col(c) for c in df.columns])


def marked_sql(source: str, mark: str, n: int) -> str:
    new = ", ".join(f"{e} AS {c}" for c, e in marked_fields(mark, n).items())
    return f"(SELECT * REPLACE ({new}) FROM {source})"

"""Declared layouts: raw file fields (by position) and production tables.

Every schema is fixed up front; nothing is inferred and files have no header.
A raw field is ``(name, kind, size, not_null)`` where ``kind`` is ``char``
(trailing spaces dropped, like a fixed-width text column), ``varchar`` (kept
as is) or ``decimal`` (``size`` is ``(precision, scale)``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for right results.
# File kinds, in the order the file catalog lists them per cycle.
KINDS = ["cm", "cn", "add", "chg", "delete", "indiv", "oth", "pas2"]
# Kinds read by each run mode (dimensions are always read).
DIMENSION_KINDS = ["cn", "cm"]
FULL_FACT_KINDS = ["indiv", "oth", "pas2"]
INCREMENTAL_FACT_KINDS = ["add", "chg", "delete", "oth", "pas2"]
# First even cycle mirrored.
FIRST_CYCLE_YEAR = 2004
# History event types: begin, success, failure.
EVENT_BEGIN, EVENT_SUCCESS, EVENT_FAILURE = "b", "s", "f"
# A run is incremental only if the newest history row is a success younger than this.
INCREMENTAL_MAX_AGE_DAYS = 13

# The file layouts below and the table columns after them are fixed values too
# (names, order, kinds and sizes as declared by the source system).
C, V, D = "char", "varchar", "decimal"

# Candidate file, 15 fields.
CN_FIELDS = [
    ("cn_id", C, 9, True), ("name", V, 200, False), ("party", V, 3, False),
    ("election_year", D, (4, 0), False), ("office_state", C, 2, False),
    ("office", C, 1, False), ("district", C, 2, False), ("i_c_status", C, 1, False),
    ("cn_status", C, 1, False), ("cm_id", C, 9, False), ("street1", V, 38, False),
    ("street2", V, 38, False), ("city", V, 18, False), ("state", C, 2, False),
    ("zip", C, 5, False),
]

# Committee file, 15 fields.
CM_FIELDS = [
    ("cm_id", C, 9, True), ("name", V, 90, False), ("treasurer", V, 38, False),
    ("street_1", V, 34, False), ("street_2", V, 34, False), ("city", V, 18, False),
    ("state", C, 2, False), ("zip", C, 5, False), ("cm_designation", C, 1, False),
    ("cm_type", C, 1, False), ("party", C, 3, False), ("filing_freq", C, 1, False),
    ("interest_group_cat", C, 1, False), ("org_name", V, 38, False), ("cn_id", C, 9, False),
]

# Contribution files (indiv, oth, add, chg), 21 fields.
CONTRIB_FIELDS = [
    ("cmte_id", C, 9, False), ("amndt_ind", C, 1, False), ("rpt_tp", V, 3, False),
    ("transaction_pgi", C, 5, False), ("image_num", V, 11, False),
    ("transaction_tp", V, 3, False), ("entity_tp", C, 3, False), ("name", V, 200, False),
    ("city", V, 45, False), ("state", C, 2, False), ("zip_code", V, 9, False),
    ("employer", V, 45, False), ("occupation", V, 45, False),
    ("transaction_dt", C, 8, False), ("transaction_amt", D, (14, 2), False),
    ("other_id", C, 9, False), ("tran_id", V, 45, False), ("file_num", D, (22, 0), False),
    ("memo_cd", C, 1, False), ("memo_text", V, 100, False), ("sub_id", D, (19, 0), True),
]

# Committee-to-candidate file (pas2), 22 fields: cand_id follows other_id.
PAS2_FIELDS = CONTRIB_FIELDS[:16] + [("cand_id", C, 9, False)] + CONTRIB_FIELDS[16:]

# Delete file: one field.  decimal(19,0) so that every sub_id can match.
DELETE_FIELDS = [("sub_id", D, (19, 0), True)]

FIELDS_BY_KIND = {
    "cn": CN_FIELDS, "cm": CM_FIELDS, "indiv": CONTRIB_FIELDS, "oth": CONTRIB_FIELDS,
    "add": CONTRIB_FIELDS, "chg": CONTRIB_FIELDS, "pas2": PAS2_FIELDS, "delete": DELETE_FIELDS,
}

# Dimension natural keys and the attributes compared on refresh.
CN_KEY, CM_KEY = "cn_id", "cm_id"
CN_ATTRS = [f[0] for f in CN_FIELDS[1:]]
CM_ATTRS = [f[0] for f in CM_FIELDS[1:]]


def spark_type(kind: str, size) -> T.DataType:
    if kind == D:
        return T.DecimalType(*size)
    return T.StringType()


def staging_schema(fields) -> T.StructType:
    """Typed staging rows: y2 + the parsed file fields."""
    return T.StructType(
        [T.StructField("y2", T.StringType(), False)]
        + [T.StructField(n, spark_type(k, s), True) for n, k, s, _ in fields]
    )


def dimension_schema(fields) -> T.StructType:
    """Production dimension: id, y2, then the file fields."""
    return T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("y2", T.StringType(), False)]
        + [T.StructField(n, spark_type(k, s), True) for n, k, s, _ in fields]
    )


CN_SCHEMA = dimension_schema(CN_FIELDS)
CM_SCHEMA = dimension_schema(CM_FIELDS)

_FACT_HEAD = [("cm_id", T.LongType())] + [
    (n, T.StringType()) for n in
    ["amndt_ind", "rpt_tp", "transaction_pgi", "image_num", "transaction_tp", "entity_tp",
     "name", "city", "state", "zip_code", "employer", "occupation"]
]
_FACT_TAIL = [("tran_id", T.StringType()), ("file_num", T.DecimalType(22, 0)),
              ("memo_cd", T.StringType()), ("memo_text", T.StringType()),
              ("sub_id", T.DecimalType(19, 0))]


def fact_schema(kind: str) -> T.StructType:
    """Production fact columns, in table order, plus the y2 partition column."""
    date_name = "transaction_date" if kind == "pas2" else "transaction_dt"
    cols = _FACT_HEAD + [(date_name, T.DateType()), ("transaction_amt", T.DecimalType(14, 2)),
                         ("other_cm_id", T.LongType()), ("other_cn_id", T.LongType())]
    if kind == "pas2":
        cols.append(("cn_id", T.LongType()))
    cols += _FACT_TAIL + [("y2", T.StringType())]
    return T.StructType([T.StructField(n, t, n not in ("sub_id",)) for n, t in cols])


INDIV_SCHEMA = fact_schema("indiv")
OTH_SCHEMA = fact_schema("oth")
PAS2_SCHEMA = fact_schema("pas2")

# Production text limits narrower than staging (applied when resolving).
PRODUCTION_LIMITS = {"pas2": {"city": 30}}

CM_META_SCHEMA = T.StructType([
    T.StructField("cm_id", T.LongType(), False),
    T.StructField("contribSum", T.DecimalType(24, 2), True),
    T.StructField("contribCount", T.LongType(), False),
])

HISTORY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("date", T.TimestampType(), True),
    T.StructField("eventType", T.StringType(), True),
    T.StructField("shortMessage", T.StringType(), True),
    T.StructField("longMessage", T.StringType(), True),
])

TABLE_SCHEMAS = {
    "cn": CN_SCHEMA, "cm": CM_SCHEMA, "indiv": INDIV_SCHEMA, "oth": OTH_SCHEMA,
    "pas2": PAS2_SCHEMA, "cmMeta": CM_META_SCHEMA, "UpdateHistory": HISTORY_SCHEMA,
}

"""S6-S12 — raw pipe-delimited lines to typed staging rows.

Fields bind by position after the escape rules (``record_fields``); trailing
empty fields count, a field beyond the end of a short line is NULL (``get``),
surplus fields are ignored.  A candidate or committee record that goes on over
an escaped line end meets its cycle and a bar there, because the loader's text
has them before every line; contribution lines have none.  Each field is fitted to its declared type
(``fit_text`` / ``coerce_decimal``); NOT NULL fields take their implicit
default (0 or '') when missing.  The CSV reader is not used: it turns ''
into NULL, where the loader keeps ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campfin.functions.text import ESCAPE, NULL_MARK, coerce_decimal, fit_text, record_fields
from campfin.operators.repairs import line_repairs
from campfin.schemas import D, DIMENSION_KINDS, FIELDS_BY_KIND

ORDER_COL = "_order"


def field_exprs(arr: Column, fields) -> list[Column]:
    """Typed fields from the split line ``arr``."""
    out = []
    for i, (name, kind, size, not_null) in enumerate(fields):
        raw = F.get(arr, i)
        if kind == D:
            v = coerce_decimal(raw, *size, null_mark=False)
            default = F.lit(0).cast(f"decimal({size[0]},{size[1]})")
        else:
            v = fit_text(raw, size, kind == "char", null_mark=False)
            default = F.lit("")
        if not_null:
            v = F.coalesce(v, default)
        out.append(v.alias(name))
    return out


def cycle_joint() -> Column:
    """What stands before every line of a dimension file: its cycle and a bar."""
    return F.concat(F.col("y2"), F.lit("|"))


def parse(lines: DataFrame, fields, keep: tuple[str, ...] = (ORDER_COL,),
          joint: Column | None = None, repairs: str = "") -> DataFrame:
    """Typed staging rows from ``lines`` (columns ``y2``, ``value`` and the
    ordering column).  ``fields`` is a layout from ``campfin.schemas``.  With
    ``repairs``, the repairs of each line (``replaced`` among its columns) follow
    in columns of that prefix."""
    extra = [c for c in keep if c in lines.columns]
    # Split once in its own projection; every field then reads the array.  A filter
    # on a field stays above it: below, it would split the line again for every
    # mention of the field, so the array stands in a struct that isn't deterministic.
    once = F.struct(record_fields("value", joint).alias("f"), F.monotonically_increasing_id().alias("at"))
    split = lines.select("y2", once.alias("_f"), *extra, *(["value", "replaced"] if repairs else []))
    counted = line_repairs(F.col("_f.f"), F.col("replaced"), lambda build: build(fields)) if repairs else {}
    return split.select("y2", *field_exprs(F.col("_f.f"), fields), *extra,
                        *[c.alias(repairs + name) for name, c in counted.items()])


def parse_kind(lines: DataFrame, kind: str, repairs: str = "") -> DataFrame:
    return parse(lines, FIELDS_BY_KIND[kind], joint=cycle_joint() if kind in DIMENSION_KINDS else None,
                 repairs=repairs)


def render(df: DataFrame, fields) -> Column:
    """The raw line of a typed row (inverse of ``parse`` for values that fit):
    escape character, bars and line ends are escaped, NULL in a nullable field
    is ``\\N``."""
    parts = []
    for name, _kind, _size, not_null in fields:
        c = F.col(name) if name in df.columns else F.lit(None)
        text = F.regexp_replace(c.cast("string"), r"([\\|])", r"\\$1")
        text = F.replace(text, F.lit("\n"), F.lit(ESCAPE + "n"))
        text = F.replace(text, F.lit("\r"), F.lit(ESCAPE + "r"))
        parts.append(F.coalesce(text, F.lit("" if not_null or name not in df.columns else NULL_MARK)))
    return F.concat_ws("|", *parts)

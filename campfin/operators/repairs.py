"""A1 — counts of the repairs a lenient load makes, per file kind.

One aggregation over the landed lines (grouped by kind, so the result has a
handful of rows): lines with fewer fields than the layout (missing fields
load as NULL or the column default), lines with more (surplus ignored),
``\\N`` fields (NULL), lines with any other escape, records that span lines,
bytes that could not be decoded, numbers read leniently (empty, junk after the number
or no number at all), numbers beyond their type (stored as the nearest bound),
and text cut to its column width.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campfin.functions.text import ESCAPE, out_of_range, record_fields
from campfin.schemas import D, DIMENSION_KINDS, FIELDS_BY_KIND

_CLEAN_NUMBER = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)\s*$"
_NULL_FIELD = r"(?<=\|)\\N(?=\|)"
REPAIRS = ["short_lines", "long_lines", "null_fields", "escaped_lines", "joined_lines", "replaced_bytes",
           "lenient_numbers", "out_of_range", "cut_text"]


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms) if terms else F.lit(0)


def _per_kind(kind: Column, build) -> Column:
    expr = F.lit(0)
    for k, fields in FIELDS_BY_KIND.items():
        expr = F.when(kind == k, build(fields)).otherwise(expr)
    return expr


def line_repairs(f: Column, replaced: Column, of: Callable) -> dict[str, Column]:
    """The repairs of a line (column ``value``), by name: ``f`` are its fields,
    ``replaced`` its bytes that could not be decoded, and ``of(build)`` is
    ``build`` of the field layout of its kind."""
    escape = F.contains("value", F.lit(ESCAPE))
    other = F.contains(F.regexp_replace(F.concat(F.lit("|"), "value", F.lit("|")), _NULL_FIELD, ""), F.lit(ESCAPE))
    n = F.size(f)

    def numeric(fields):
        terms = []
        for i, (_name, k, _size, _nn) in enumerate(fields):
            if k == D:
                x = F.get(f, i)
                bad = x.isNotNull() & ~x.rlike(_CLEAN_NUMBER)
                terms.append(F.when(bad, 1).otherwise(0))
        return _sum(terms)

    def beyond(fields):
        # What the type can't hold has more characters than it has places before the point.
        return _sum([F.when((F.length(F.get(f, i)) > size[0] - size[1])
                            & out_of_range(F.get(f, i), *size), 1).otherwise(0)
                     for i, (_name, k, size, _nn) in enumerate(fields) if k == D])

    def cut(fields):
        terms = []
        for i, (_name, k, size, _nn) in enumerate(fields):
            if k != D:
                x = F.get(f, i)
                width = F.length(F.rtrim(x)) if k == "char" else F.length(x)
                terms.append(F.when(width > size, 1).otherwise(0))
        return _sum(terms)

    expected = of(lambda fields: F.lit(len(fields)))
    return {
        "short_lines": F.when(n < expected, 1).otherwise(0),
        "long_lines": F.when(n > expected, 1).otherwise(0),
        # Only an escape makes a field NULL.
        "null_fields": F.when(escape, F.size(F.filter(f, lambda x: x.isNull()))).otherwise(0),
        "escaped_lines": F.when(escape & other, 1).otherwise(0),
        "joined_lines": F.when(F.contains("value", F.lit("\n")), 1).otherwise(0),
        "replaced_bytes": F.coalesce(replaced, F.lit(0)),
        "lenient_numbers": of(numeric), "out_of_range": of(beyond), "cut_text": of(cut)}


def repair_sums(prefix: str = "") -> list[Column]:
    """The sum of every repair over lines that hold its column."""
    return [F.sum(prefix + r).cast("long").alias(r) for r in REPAIRS]


def repair_counts(lines: DataFrame) -> DataFrame:
    """(kind, repair, count) for landed lines with columns ``kind``, ``value``
    (and ``y2``, ``replaced``).  A run counts them while it parses the lines."""
    cycle = F.coalesce(F.col("y2"), F.lit("")) if "y2" in lines.columns else F.lit("")
    joint = F.when(F.col("kind").isin(DIMENSION_KINDS), F.concat(cycle, F.lit("|"))).otherwise("")
    replaced = F.col("replaced") if "replaced" in lines.columns else F.lit(0)
    f = lines.select("kind", "value", record_fields("value", joint).alias("_f"), replaced.alias("_replaced"))
    per_line = line_repairs(F.col("_f"), F.col("_replaced"), lambda build: _per_kind(F.col("kind"), build))
    agg = f.select("kind", *[c.alias(r) for r, c in per_line.items()]).groupBy("kind").agg(*repair_sums())
    stacked = ", ".join(f"'{r}', {r}" for r in REPAIRS)
    return agg.select("kind", F.expr(f"stack({len(REPAIRS)}, {stacked}) AS (repair, count)"))

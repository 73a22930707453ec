"""Column expressions for raw text fields.  All JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker a loader reads as NULL, its escape character, and the letters that
# stand for a control character after it (fixed values).
NULL_MARK = "\\N"
ESCAPE = "\\"
CONTROL_ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}
# Leading number of a text field, as the loader reads '12abc' as 12.
_LEADING_NUMBER = r"^\s*([-+]?(\d+(\.\d*)?|\.\d+))"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_mmddyyyy(c) -> Column:
    """``MMDDYYYY`` text to a date by position: year = last 4, month = first 2,
    day = chars 3-4.  Impossible or empty input gives NULL (row kept).

    Positional on purpose: a 7-char '0412012' still reads 2012-04-12, where a
    ``MMddyyyy`` pattern parser gives NULL.
    """
    c = _col(c)
    text = F.concat(F.right(c, F.lit(4)), F.lit("-"), F.left(c, F.lit(2)), F.lit("-"),
                    F.substring(c, 3, 2))
    return text.try_cast("date")


def record_fields(value, joint: Column | None = None) -> Column:
    """Fields of a raw record, by the loader's escape rules.

    A bar ends a field unless the escape character stands before it.  ``\\N``
    alone is NULL; ``\\0 \\b \\n \\r \\t \\Z`` are control characters; before any
    other character (bar, escape character, line end) the escape is dropped.
    Where a record spans lines, ``joint`` is what the loader finds at the
    beginning of the next line.  A lone escape at the very end stands for itself.
    Lines without escapes take the plain split."""
    v = _col(value)
    plain = F.split(v, r"\|", -1)
    whole = v if joint is None else F.replace(v, F.lit("\n"), F.concat(F.lit("\n"), joint))
    whole = F.regexp_replace(whole, r"(?<!\\)((?:\\\\)*)\\\z", r"$1\\\\")
    raw = F.regexp_extract_all(F.concat(whole, F.lit("|")),
                               F.lit(r"(?s)([^|\\]*+(?:\\.[^|\\]*+)*+)\|"), F.lit(1))
    return F.when(F.contains(v, F.lit(ESCAPE)), F.transform(raw, _unescaped)).otherwise(plain)


def _unescaped(field: Column) -> Column:
    def token(t: Column) -> Column:
        second = F.substring(t, 2, 1)
        out = second
        for letter, char in CONTROL_ESCAPES.items():
            out = F.when(second == letter, F.lit(char)).otherwise(out)
        return F.when(F.startswith(t, F.lit(ESCAPE)), out).otherwise(t)

    tokens = F.regexp_extract_all(field, F.lit(r"(?s)\\.|[^\\]++"), F.lit(0))
    return (F.when(field == F.lit(NULL_MARK), F.lit(None).cast("string"))
            .when(F.contains(field, F.lit(ESCAPE)), F.array_join(F.transform(tokens, token), ""))
            .otherwise(field))


def fit_text(c, size: int, is_char: bool, null_mark: bool = True) -> Column:
    """Fit raw text to a declared column: ``\\N`` is NULL (unless the text is
    unescaped already: ``null_mark`` false), overlong text is cut, fixed-width
    (char) columns lose trailing spaces.  Empty stays ''."""
    c = _col(c)
    v = F.left(c, F.lit(size))
    if is_char:
        v = F.rtrim(v)
    if not null_mark:
        return v
    return F.when(c == F.lit(NULL_MARK), F.lit(None).cast("string")).otherwise(v)


def coerce_decimal(c, precision: int, scale: int, null_mark: bool = True) -> Column:
    """Raw text to decimal the way a lenient bulk loader does: ``\\N`` is NULL
    (with ``null_mark``), otherwise the leading number ('12abc' -> 12), and 0 when there is none
    ('' or 'abc').  A number that the type cannot hold becomes the nearest one
    that it can.  A missing field (NULL input) stays NULL."""
    c = _col(c)
    dt = f"decimal({precision},{scale})"
    lead = F.regexp_extract(c, _LEADING_NUMBER, 1)
    most = F.lit("9" * (precision - scale) + "." + "9" * scale).cast(dt)
    bound = F.when(F.startswith(lead, F.lit("-")), -most).otherwise(most).cast(dt)
    num = F.coalesce(lead.try_cast(dt), F.when(lead != "", bound), F.lit(0).cast(dt))
    null = c.isNull() | (c == F.lit(NULL_MARK)) if null_mark else c.isNull()
    return F.when(null, F.lit(None).cast(dt)).otherwise(num)


def out_of_range(c, precision: int, scale: int) -> Column:
    """Whether the leading number of a raw text is more than the type holds."""
    lead = F.regexp_extract(_col(c), _LEADING_NUMBER, 1)
    return F.coalesce((lead != "") & lead.try_cast(f"decimal({precision},{scale})").isNull(), F.lit(False))


def y2_of_year(year) -> Column:
    """Four-digit year to the two-digit cycle text: 2012 -> '12', 2004 -> '04'."""
    return F.right(_col(year).cast("string"), F.lit(2))


def file_name(path) -> Column:
    """Last path segment."""
    return F.regexp_extract(_col(path), r"([^/]+)$", 1)

"""Small helpers shared by the text operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Word separators: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
#: One or more separators, as a Java / RE2 / Python pattern.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also fold other scripts)."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Words of a text: runs of anything but the six separators; null: none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_RUN), "")


def double_array_literal(values) -> Column:
    """An array literal of many doubles as one foldable string expression
    (a literal per element would make a plan of that many nodes)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def py_words(text: str | None) -> list[str]:
    """The same words in Python (tests and brute force)."""
    return _WORD.findall(text or "")

"""S1-S3 — which archives should exist, which to fetch, which to load.

* ``expected_files``: even cycle years x file kinds -> ``yyyy/<kind><yy>.zip``.
* ``manifest_diff``: expected files against a remote and a local listing:
  ``not found`` (no remote file), ``new`` (no local copy), ``changed``
  (sizes differ) or ``unchanged``.
* ``classify_archives`` / ``discover``: archives of a folder tree whose name
  is ``<kind><yy>.zip`` (case-insensitive, anchored), with kind and cycle,
  restricted to the kinds a run mode reads.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campfin.functions.text import file_name, y2_of_year
from campfin.schemas import (
    DIMENSION_KINDS, FIRST_CYCLE_YEAR, FULL_FACT_KINDS, INCREMENTAL_FACT_KINDS, KINDS,
)

ARCHIVE_PATTERN = r"(?i)^(" + "|".join(KINDS) + r")(\d\d)\.zip$"
MODE_KINDS = {
    "full": DIMENSION_KINDS + FULL_FACT_KINDS,
    "incremental": DIMENSION_KINDS + INCREMENTAL_FACT_KINDS,
}
NOT_FOUND, NEW, CHANGED, UNCHANGED = "not found", "new", "changed", "unchanged"


def expected_files_for(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(year, y2, kind_no, kind, path) for every cycle year in ``years``."""
    kinds = F.array(*[F.struct(F.lit(i + 1).alias("kind_no"), F.lit(k).alias("kind"))
                      for i, k in enumerate(KINDS)])
    y = years.select(F.col(year_col).cast("int").alias("year"))
    yy = y2_of_year("year")
    return (y.select("year", F.inline(kinds))
            .select("year", yy.alias("y2"), "kind_no", "kind",
                    F.concat(F.col("year").cast("string"), F.lit("/"), F.col("kind"), yy,
                             F.lit(".zip")).alias("path")))


def expected_files(spark: SparkSession, year_from: int = FIRST_CYCLE_YEAR,
                   year_to: int | None = None) -> DataFrame:
    """Cycles year_from, year_from + 2, ... up to year_to (default: this year)."""
    year_to = year_to or _dt.date.today().year
    years = spark.range(1).select(
        F.explode(F.sequence(F.lit(year_from), F.lit(year_to), F.lit(2))).alias("year"))
    return expected_files_for(years)


def manifest_diff(expected: DataFrame, local: DataFrame, remote: DataFrame) -> DataFrame:
    """Status of each expected file.  ``local`` / ``remote`` are listings
    with columns (path, size)."""
    r = remote.select("path", F.col("size").cast("long").alias("remote_size"),
                      F.lit(True).alias("_remote"))
    lo = local.select("path", F.col("size").cast("long").alias("local_size"),
                      F.lit(True).alias("_local"))
    j = expected.select("path").join(r, "path", "left").join(lo, "path", "left")
    status = (F.when(F.col("_remote").isNull(), F.lit(NOT_FOUND))
              .when(F.col("_local").isNull(), F.lit(NEW))
              .when(F.col("local_size") != F.col("remote_size"), F.lit(CHANGED))
              .otherwise(F.lit(UNCHANGED)))
    return j.select("path", status.alias("status"), "local_size", "remote_size")


def classify_archives(paths: DataFrame, mode: str, path_col: str = "path") -> DataFrame:
    """Archives among ``paths`` that ``mode`` reads, with kind (lower
    case) and the file's two-digit cycle y2."""
    name = file_name(F.col(path_col))
    kind = F.lower(F.regexp_extract(name, ARCHIVE_PATTERN, 1))
    y2 = F.regexp_extract(name, ARCHIVE_PATTERN, 2)
    return (paths.withColumn("kind", kind).withColumn("y2", y2)
            .where(F.col("kind").isin(*MODE_KINDS[mode])))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of every file under ``root``; file contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", F.col("length").alias("size")))


def discover(spark: SparkSession, root: str, mode: str) -> DataFrame:
    """Archives under ``root`` for a run mode: (path, size, kind, y2)."""
    return classify_archives(list_files(spark, root), mode)

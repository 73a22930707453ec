"""M3 — generated integer ids: dense, in a fixed sort order, continuing after
the largest id already issued.

A global ``row_number() OVER (ORDER BY ...)`` runs in one task.  Instead the
rows are range-partitioned on the order (sampled bounds, so a hot cycle is
split over many tasks), sorted inside each partition, numbered by position,
and written to the shared folder, so that counts and positions come from the
very same partitioning, also when tasks are retried.  The rows per partition
are one grouped count over a single column of what was written; their running
sum (one row per partition) gives each partition's offset, joined back as a
broadcast of that many rows.  The plan is the same for any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campfin.operators.lookup import written

_LOW_BITS = (1 << 33) - 1


def assign_ids(df: DataFrame, order_cols: list[str], start: int = 0, id_col: str = "id",
               num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... in ``order_cols`` order."""
    return assign_ids_counted(df, order_cols, start, id_col, num_partitions)[0]


def assign_ids_counted(df: DataFrame, order_cols: list[str], start: int = 0,
                       id_col: str = "id",
                       num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``assign_ids`` plus the number of rows numbered.

    ``order_cols`` must identify rows uniquely (ties would be numbered in an
    arbitrary but consistent order).  Result ids are independent of how the
    input is partitioned.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = written(
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_mid"), "ids")
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = (numbered.join(F.broadcast(offsets), "_pid")  # one row per partition
           .withColumn(id_col, (F.col("_before") + F.col("_pos") + 1 + F.lit(start)).cast("long"))
           .drop("_pid", "_pos", "_before"))
    return out, numbered.count()

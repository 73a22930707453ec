"""Connected components of an edge table by alternating large and small stars.

Every round replaces a node's edges by edges to the smallest node it knows, so
the edges of a component turn into one star around its smallest node, in about
log(longest path) rounds.  Edges stay distributed; minima are aggregated
before they are shuffled; a round's edges are written to the shared folder,
which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from campfin.session import scratch_path


#: Edges a task of a round, about; smaller tables don't use every partition.
EDGES = 100_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _towards(edges: DataFrame) -> DataFrame:
    """Every edge with the smallest node next to (or at) its left end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return edges.join(least, edges.a == least.u).drop("u")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every left end has one edge and is no right end: then each
    component is one star around its smallest node."""
    ends = (edges.select(F.col("a").alias("x"), F.lit(1).alias("left"), F.lit(0).alias("right"))
            .unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("left"), F.lit(1).alias("right"))))
    node = ends.groupBy("x").agg(F.sum("left").alias("left"), F.max("right").alias("right"))
    return node.where("left > 1 or left + right > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); ``root`` is the
    smallest node of its component.  Loops and repeated edges are harmless; no
    edges give no rows."""
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"),
                                              F.least("a", "b").alias("b")).distinct(), "edges")
    # A round never has more edges than the first, so a task never has more of them.
    tasks = max(1, -(-now.count() // EDGES))
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_towards(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").coalesce(tasks))
        down = _towards(large).coalesce(tasks)
        small = (down.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).where("a != b").distinct().coalesce(tasks))
        now = stored(small, "edges")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())

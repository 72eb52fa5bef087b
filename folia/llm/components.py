"""Connected components of links between ids, by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and a join that Spark
can split, so an id with very many links is no task's burden. Each round is written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.llm.common import written


def _all_stars(edges: DataFrame) -> bool:
    """Whether every id has one smaller neighbour at most and that has none itself."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("root"), "v")
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("root"), F.lit(None).cast("long").alias("v")))
    seen = ends.groupBy("id").agg(F.max("child").alias("child"), F.max("root").alias("root"), F.min("v").alias("a"), F.max("v").alias("b"))
    return seen.filter("(child = 1 AND root = 1) OR a <> b").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every id that is linked to a smaller one; links has u and v."""
    ordered = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(ordered, "links")
    while not _all_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(roots.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select("u", F.col("v").alias("root"))


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components `roots` when further links are added: only roots are linked anew."""

    def root_of(df: DataFrame, column: str) -> DataFrame:
        known = roots.select(F.col("u").alias(column), F.col("root").alias("_root"))
        return df.join(known, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")

    more = components(root_of(root_of(links, "u"), "v"))
    moved = roots.join(more.select(F.col("u").alias("root"), F.col("root").alias("_root")), "root", "left")
    return written(moved.select("u", F.coalesce("_root", "root").alias("root")).unionByName(more), "roots")

"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import complete, store


def _all_stars(links: DataFrame) -> bool:
    """Whether each vertex either has one link to its root or is a root."""
    ends = links.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


@complete
def components(links: DataFrame) -> DataFrame:
    """``d, root`` for every linked vertex but the roots; a root is the smallest of its component.

    ``links`` has columns a and b. Stars are joined and flattened by turns: each vertex
    hands its larger, then its smaller neighbours to the smallest one it knows, until
    only stars are left. Every round is stored, so a lost executor costs no more than
    the round, and the driver sees one answer.
    """
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = store(links.select(big, small).where("a != b").distinct(), "links")
    while not _all_stars(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a")
        joined = pairs.select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
        links = store(joined.where("x.a != x.m").select("x.a", F.col("x.m").alias("b")).distinct(), "links")
    return links.select(F.col("a").alias("d"), F.col("b").alias("root"))

"""Connected components of a link table by alternating stars.

Each round hangs the larger neighbours of every node on its smallest neighbour
(large star), then the smaller ones (small star). Rounds grow with the logarithm
of the longest path. Links stay distributed; only two numbers a round reach the
driver. Minimums are staged before they are joined, so that both sides of the
join are plain exchanges and a node with very many links can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.staging import remove, stage


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 30))).first())


def _star(links: DataFrame, large: bool) -> tuple[DataFrame, str]:
    """``links``: distinct (u, v), u > v."""
    both = links.select("u", "v")
    if large:
        both = both.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least, path = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    joined = both.join(least, "u")
    if large:
        made = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    out = stage(made.distinct(), "star")
    remove(links.sparkSession, path)
    return out


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """Staged (u, root) of every node in a link, root being the smallest node reachable, and its path.

    ``links``: (a, b) of any order with repeats; values must not be null. Links of a
    node with itself are left out; no links give no rows.
    """
    spark = links.sparkSession
    current, path = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .distinct(), "links")
    before = None
    while (now := _summary(current)) != before and now[0]:
        before = now
        for large in (True, False):
            following, new = _star(current, large)
            remove(spark, path)
            current, path = following, new
    roots, new = stage(current.select("u", F.col("v").alias("root")).union(
        current.select(F.col("v").alias("u"), F.col("v").alias("root"))).distinct(), "roots")
    remove(spark, path)
    return roots, new

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.shared import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest neighbour of u, u itself included, as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (pairs.join(least, "u")
            .select("u", "v", F.least("u", "m").alias("m")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _least(down)
    return (stars.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(stars.select("u", F.col("m").alias("v"))).where("u <> v"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (u, v): root is the smallest node reachable.

    Alternates large-star and small-star steps on the links until they no longer change. Each
    round is stored in the shared folder; a node with many links is added up before the
    shuffle and its rows may be split by Spark's skew join. No links give no rows. Roots are
    in the result as well, with themselves.
    """
    links = cut_lineage(links.where("u <> v").distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        links = cut_lineage(_small_star(_large_star(links).distinct()).distinct())
    roots = links.select(F.col("v").alias("node")).distinct()
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(roots.select("node", F.col("node").alias("root"))))

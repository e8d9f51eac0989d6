"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One step over (u, v) rows: neighbours of a node are re-linked to their smallest."""
    if both:
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if both:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own)


def components(links: DataFrame) -> DataFrame:
    """``u`` and ``root`` (smallest node of its component) of every node in ``links`` (u, v).

    Rounds grow with the logarithm of a component's size. Each is written to the shared folder, which
    cuts the lineage. Rows with a NULL end are ignored.
    """
    edges = written(links.select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        edges = _star(edges, True).where("u <> v").distinct()
        edges = written(_star(edges, False).where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before or not now.n:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    tops = edges.select(F.col("v").alias("u")).distinct().join(roots, "u", "left_anti")
    return written(roots.unionAll(tops.select("u", F.col("u").alias("root"))))

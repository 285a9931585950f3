"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .common import save


def _state(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of the edges (a, b): the smallest node of its component.

    Large and small stars alternate until the edges are stars around their smallest nodes. Each
    step is written to the shared folder, which cuts the lineage, and minima are read back from
    there before they are joined, so the rows of a node with very many edges can be split.
    """
    root = work_path(edges.sparkSession, "components")
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e, before, step = save(e.distinct(), f"{root}/0"), None, 0
    while (now := _state(e)) != before and now[0]:
        before, step = now, step + 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{root}/{step}a")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = save(large.distinct(), f"{root}/{step}b")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), f"{root}/{step}c")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        e = save(small.distinct(), f"{root}/{step}")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

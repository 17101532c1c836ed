"""Connected components of a link table, by alternating large-star and small-star steps.

No task ever holds a component: each step is a pre-aggregated minimum per node and a join on the node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import cut, few


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node that has a link; ``comp`` is its component's smallest node."""
    bound = 2 * links.count() + 1  # no step has more edges than this
    edges = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), bound, 200_000)
    before = None
    while True:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = _minimum(both).select("u", F.least("u", "m").alias("m"))
        large = few(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), bound, 200_000)
        low = _minimum(large)
        small = few(large.join(low, "u"), bound, 200_000).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = cut(small.where("u <> v").distinct(), bound, 200_000)
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("comp", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)

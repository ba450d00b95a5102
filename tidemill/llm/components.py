"""Connected groups of a graph that may be larger than any machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import shuffles_dropped
from tidemill.session import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """Node and root (the smallest node of its group) of every node in ``edges`` (a, b).

    Large-star and small-star steps in turn until nothing changes (Kiveris and
    others, 2014): each links a node's neighbours to the smallest of them. A
    node's smallest neighbour is found with map-side combining and joined back
    to the edges, where Spark splits a node with very many. Every step is
    written to the shared folder, which cuts the lineage. Nodes may be of any
    type with an order; edges may repeat, point either way, or be loops.
    """
    spark = edges.sparkSession
    ordered = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    with shuffles_dropped(spark):
        now = materialise(ordered.distinct())
        before, last = None, state(now)
        while last != before:
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
            large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            near = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            step, now = now, materialise(near.unionByName(low.withColumnRenamed("m", "v")).distinct())
            discard(step, large)
            before, last = last, state(now)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

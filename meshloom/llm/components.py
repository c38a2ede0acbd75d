"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Return (node, component) for every node of an edge, component being its least node.

    Nulls and loops are left out; repeated edges don't matter; no edge gives no row. Every round is
    written to the shared folder, so its plan stays short and lost executors cost one round at most.
    A node's neighbours are reduced by a partial aggregate and joined back, never gathered in one task.
    """
    stars = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    stars, last = materialise(stars, "edges"), None
    while True:
        mark = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == last or not mark[0]:
            break
        last = mark
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, stars = stars, materialise(small, "edges")
        release(before)
    tips = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tips.unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components of an edge table by randomised contraction.

Every round each vertex hooks onto the neighbour (or itself) with the smallest
seeded hash and the edges are contracted along the hooks; a constant share of
the vertices goes each round, whatever the shape of the graph.  All groupings
are algebraic minima (combined before the shuffle, so a hub costs one row per
task) and all joins are plain equi-joins that AQE may split on a hot key.  No
edge, label or component is ever sent to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import shared_dir


def components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs -> one row (node, root) per vertex that has an edge.

    ``root`` is a vertex of the same component, equal for all its vertices.
    Loops, repeated and reversed edges and edges with a null end are allowed
    (null ends and loops link nothing); an empty table gives an empty table.
    """
    shared_dir(edges.sparkSession)
    cur = (
        edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct().checkpoint()
    )
    nodes = cur.select(F.col("u").alias("node")).union(cur.select("v")).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    seed = 0
    while not cur.isEmpty():
        seed += 1
        rank = lambda c: F.xxhash64(F.lit(seed), F.col(c))
        both = cur.select("u", "v").union(cur.select("v", "u"))
        near = both.groupBy("u").agg(F.min_by("v", rank("v")).alias("v"))
        hook = near.select(
            F.col("u").alias("old"), F.when(rank("v") < rank("u"), F.col("v")).otherwise(F.col("u")).alias("new")
        ).checkpoint()
        at = lambda c: hook.select(F.col("old").alias(c), F.col("new").alias("n" + c))
        cur = (
            cur.join(at("u"), "u").join(at("v"), "v").where("nu <> nv")
            .select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct().checkpoint()
        )
        labels = (
            labels.join(hook.withColumnRenamed("old", "root"), "root", "left")
            .select("node", F.coalesce("new", "root").alias("root"))
        )
    return labels

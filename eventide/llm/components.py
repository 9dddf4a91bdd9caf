"""Connected components of an edge table by randomized contraction.

Every round each node moves to the neighbour (or itself) of least random
priority, and edges are relabelled; edges inside one image vanish.  A round
leaves a constant fraction of the nodes whatever the graph's shape, so rounds
grow with the logarithm of the largest component.  All tables stay in Spark;
only "are there edges left" comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage ends there, and a lost executor costs nothing already written."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any comparable type -> ``(node, root)``, one row per
    node that has an edge; nodes of one component share one root.

    Null ends, self loops and repeated edges are allowed and add nothing.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return (df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct())

    left, roots, turn = stored(ordered(edges), "cc-edges"), None, 0
    while roots is None or not left.isEmpty():
        def rank(c, turn=turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("p"), F.col(c).alias("n"))
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = stored(both.groupBy("a").agg(F.min(rank("b")).alias("m"))
                       .select(F.col("a").alias("node"), F.least("m", rank("a"))["n"].alias("to")),
                       "cc-moves")
        if roots is None:
            roots = moved.select("node", F.col("to").alias("root"))
        else:
            hop = moved.select(F.col("node").alias("root"), "to")
            roots = stored(roots.join(hop, "root", "left")
                           .select("node", F.coalesce("to", "root").alias("root")), "cc-roots")
        for end in ("a", "b"):
            hop = moved.select(F.col("node").alias(end), "to")
            left = left.join(hop, end).drop(end).withColumnRenamed("to", end)
        left, turn = stored(ordered(left), "cc-edges"), turn + 1
    return roots

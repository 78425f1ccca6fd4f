"""Connected components of an edge table by hooking and contraction.

Edges and labels stay Spark tables, stored every round. In a round each vertex hooks to its smallest
neighbour, hooks are followed once more, and the edges are rewritten to the new labels and deduplicated,
so later rounds work on a few contracted edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.common import stored


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(v, c) for every vertex of ``edges`` (u, v longs): c is the smallest vertex of its component."""
    edges = edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = stored(edges.distinct(), f"{name}-edges")
    known = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                       f"{name}-hooks")
        again = hooks.select(F.col("u").alias("m"), F.col("m").alias("c"))
        labels = stored(hooks.join(again, "m").select("u", "c"), f"{name}-labels")
        if known is None:
            known = labels.select(F.col("u").alias("v"), "c")
        else:
            known = known.join(labels.select(F.col("u").alias("c"), F.col("c").alias("next")), "c", "left")
            known = stored(known.select("v", F.coalesce("next", "c").alias("c")), f"{name}-known")
        ends = labels.select(F.col("u").alias("v"), F.col("c").alias("cv"))
        left = edges.join(labels, "u").join(ends, "v").filter("c <> cv")
        edges = stored(left.select(F.least("c", "cv").alias("u"), F.greatest("c", "cv").alias("v")).distinct(),
                       f"{name}-edges")
        if edges.limit(1).count() == 0:
            return known
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")

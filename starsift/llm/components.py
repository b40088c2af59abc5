"""Connected components by random contraction, in DataFrame joins and aggregates only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the (a, b) edges: nodes have one root exactly if they are connected.

    Each round every node joins the node of lowest random priority among itself and its neighbours, which about halves
    the nodes of any graph, chains and stars included; loops and repeated edges vanish. Priorities differ by round.
    """
    edges = stored(edges.select("a", "b").filter(F.col("a") != F.col("b")).dropDuplicates(), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        seed = F.lit(len(steps))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("p"), F.col("b").alias("x"))).alias("near"))
        own = F.struct(F.xxhash64("a", seed).alias("p"), F.col("a").alias("x"))
        step = stored(best.select(F.col("a").alias("node"), F.least("near", own)["x"].alias("into")), "contraction")
        moved = edges.join(step.select(F.col("node").alias("a"), F.col("into").alias("a2")), "a").join(step.select(F.col("node").alias("b"), F.col("into").alias("b2")), "b")
        edges = stored(moved.filter(F.col("a2") != F.col("b2")).select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).dropDuplicates(), "edges")
        steps.append(step)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[-1].select("node", F.col("into").alias("root"))
    for step in reversed(steps[:-1]):
        up = roots.select(F.col("node").alias("into"), "root")
        roots = stored(step.join(up, "into", "left").select("node", F.coalesce("root", "into").alias("root")), "roots")
    return roots

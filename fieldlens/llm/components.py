"""Connected components of an edge list, by alternating stars on DataFrames."""

from pyspark.sql import functions as F

from fieldlens.llm.common import materialize

MAX_ROUNDS = 60


def _least(edges):
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges):
    """Every neighbour above a node goes to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.filter("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges):
    """Every node and its lower neighbours go to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    to = down.join(_least(down), "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return to.filter("u <> v").distinct()


def components(edges):
    """(node, root) for every node of the edge list (u, v): root is the least node of its component.

    Each round writes its edges to the shared folder, so a round starts from files whatever executor is lost. Rounds end
    when the edges stay the same; their number grows with the logarithm of the component size.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"the components were not settled after {MAX_ROUNDS} rounds")

"""Connected components by contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a long, b long); nodes share
    a label exactly if links join them. The label is one of the nodes.

    Each round every node moves to the neighbour (or itself) of the smallest
    hash, fresh by round, and the links move along. The number of nodes left
    falls by a constant factor a round whatever the shape, a chain included.
    Grouped minima combine on the map side, so a node with very many links is
    no hot group; the joins' one side is unique per key, which lets Spark
    split a skewed other side."""
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.where("a <> b").select("a", "b").distinct().checkpoint()
    both = edges.union(edges.select("b", "a"))
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    step = 0
    while not edges.isEmpty():
        step += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        both = edges.union(edges.select("b", "a"))
        moves = (both.groupBy("a").agg(F.min(rank("b")).alias("best"))
                 .select(F.col("a").alias("from"), F.least("best", rank("a"))["to"].alias("to")).checkpoint())
        labels = (labels.join(moves, labels["label"] == moves["from"], "left")
                  .select("node", F.coalesce("to", "label").alias("label")).checkpoint())
        edges = (edges.join(moves.select(F.col("from").alias("a"), F.col("to").alias("a2")), "a")
                 .join(moves.select(F.col("from").alias("b"), F.col("to").alias("b2")), "b")
                 .where("a2 <> b2")
                 .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct().checkpoint())
    return labels

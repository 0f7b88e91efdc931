"""Connected components of a graph kept in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.scratch import scratch_root


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, label``: every node of ``edges`` with the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label of that label, so long
    chains shorten by half. The minimum is formed before the shuffle and a hub's rows meet its label
    in a join that adaptive execution splits, so a hub with a third of the edges is no hot task.
    Rounds end when no label changes; the driver sees one number a round. Labels that still change after
    ``rounds`` rounds, more than a path of a billion billion nodes needs, end the job with an error.
    """
    scratch_root(edges.sparkSession)
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col(a) != F.col(b))
    both = both.union(both.select("other", "node")).distinct().checkpoint(eager=True)
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    labels = labels.checkpoint(eager=True)
    for _ in range(rounds):
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        near = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        top = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = near.join(top, "label", "left").select("node", "old", F.least("label", "up").alias("label")).checkpoint(eager=True)
        labels = new.select("node", "label")
        if new.where("label < old").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")

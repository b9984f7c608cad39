"""Connected components of links by label spreading and pointer jumping over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.durable import discard, written


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b: long): the smallest node each can reach.

    A round takes the least label around a node, as a partial aggregate (a hub is no single task), and then the label of that label, which halves distances. It ends when no label
    moves, so a chain of any length settles.
    """
    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    both = links.union(links.select("b", "a"))
    state = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        labels = state.select("node", "label")
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        step = step.join(jump, F.col("low") == F.col("at"), "left").select("node", F.least("low", F.coalesce("further", "low")).alias("label"), F.col("label").alias("was"))
        step = written(step, "labels")
        discard(state)
        state = step
        if step.where("label <> was").isEmpty():
            discard(links)
            return step.select("node", F.col("label").alias("component"))

"""Connected components of a link table, as joins; nothing is collected but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest reachable node) of all nodes of ``links (a, b)``.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so labels travel in doubling steps; it ends when a
    round changes none. Every round is written to shared storage. Nodes with
    many links meet their label in equi-joins, which adaptive execution splits,
    and in minima, which are taken on the map side. No links give no rows.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = hand_off(both.toDF("node", "other"))
    labels = hand_off(
        edges.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component"))
    )
    while True:
        near = edges.join(labels.toDF("other", "label"), "other").groupBy("node").agg(F.min("label").alias("least"))
        moved = hand_off(
            labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "least").alias("component"))
        )
        ahead = moved.select(F.col("node").alias("component"), F.col("component").alias("next"))
        done = hand_off(moved.join(ahead, "component").select("node", "old", F.col("next").alias("component")))
        if done.where("old <> component").isEmpty():
            return done.select("node", "component")
        labels = done.select("node", "component")

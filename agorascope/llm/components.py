"""Connected components by min-label propagation with pointer jumping; every round is a table in the shared folder."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.staging import Stage


def connected(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """links(a, b) -> (node, component): the smallest node reachable. Rounds end when no label changes.

    Labels jump to their label's label, so a chain of n nodes takes about log2 n rounds. A round's table goes once the next
    is there. Nulls in links are ignored; no links give no rows."""
    links = links.where("a is not null and b is not null")
    arcs = stage.table(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-arcs")
    labels = arcs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = stage.table(labels, f"{name}-labels-0")
    for turn in count(1):
        heard = arcs.join(labels.toDF("b", "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        hop = labels.toDF("component", "further")
        moved = labels.join(heard, "node").join(hop, "component", "left").select("node", F.least("component", "heard", "further").alias("component"), F.col("component").alias("was"))
        moved = stage.table(moved, f"{name}-labels-{turn}")
        stage.drop(f"{name}-labels-{turn - 1}")
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            stage.drop(f"{name}-arcs")
            return labels

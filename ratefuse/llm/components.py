"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratefuse.operators.stored import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each node of the edges (a, b); the component is its smallest id.

    Each round gives every node the smallest label among itself and its neighbours and then
    the label of that label, so paths shorten by half. Labels are written out every round; they
    only get smaller, so the rounds end. Without edges there are no rows; edges with a null and
    edges of a node to itself give none either.
    """
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("a").alias("near"))
    )
    both = stored(both.filter("id <> near").distinct(), "graph")
    labels = both.groupBy("id").agg(F.min("near").alias("near"))
    labels = stored(labels.select("id", F.least("id", "near").alias("component")), "labels")
    while True:
        of = labels.select(F.col("id").alias("near"), F.col("component").alias("theirs"))
        low = both.join(of, "near").groupBy("id").agg(F.min("theirs").alias("low"))
        step = labels.join(low, "id").select(
            "id", "component", F.least("component", "low").alias("low")
        )
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("further"))
        step = step.join(jump, "low", "left").select(
            "id", F.least("low", "further").alias("component"),
            (F.least("low", "further") < F.col("component")).alias("moved"),
        )
        step = stored(step, "labels")
        labels = step.select("id", "component")
        if step.filter("moved").isEmpty():
            return labels

"""Connected components of a graph given as a frame of edges, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id that it reaches.

    Each round gives every id the smallest label among its neighbours' and its own,
    then the label of that label, so labels travel along paths ever faster. Both
    are aggregates before they are joins: a hub's neighbours are never gathered.
    Rounds are checkpointed; they end when no label has changed.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    both = cut(e.union(e.select("b", "a")).toDF("a", "b").distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(label, both["b"] == label["id"]).groupBy("a").agg(F.min("label").alias("m"))
        step = label.join(near, label["id"] == near["a"]).select("id", "label", F.least("label", "m").alias("next"))
        of = label.select(F.col("id").alias("next"), F.col("label").alias("jump"))
        moved = cut(step.join(of, "next").select("id", F.least("next", "jump").alias("now"), "label"))
        if moved.where("now <> label").isEmpty():
            return moved.select("id", F.col("now").alias("component"))
        label = moved.select("id", F.col("now").alias("label"))

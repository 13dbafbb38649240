"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """For every id in ``links`` (columns a, b): id and the smallest id it reaches, component.

    Each turn takes the smallest label among the neighbours and then the label's own label, so long chains shrink by
    half and more. Labels are written to the shared folder after each turn. Minima are formed before the shuffle, and
    a node with very many links is split by the skew handling of the join.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")).select("id", F.least("id", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("id") == F.col("a")).select("id", "label", F.least("label", "near").alias("new"))
        ends = labels.select(F.col("id").alias("new"), F.col("label").alias("end"))
        labels = materialize(step.join(ends, "new").select("id", F.least("new", "end").alias("label"), (F.col("label") != F.least("new", "end")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        labels = labels.select("id", "label")

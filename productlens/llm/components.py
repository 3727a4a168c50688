"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from productlens.llm.tasks import drop_folder, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); nodes of one component share their root.

    Each round hooks every node to its smallest neighbour if that is smaller, and maps edges and labels to the hooks.
    Nodes go by a hash of their id (one-to-one for a long), so that the order is as good as random and chains shrink by
    a constant factor a round. Every round is written to the shared folder; all steps are joins and partial sums, with
    no task that holds a component. Edges with a NULL end or equal ends count for nothing.
    """
    spark = edges.sparkSession
    both = edges.where("a is not null and b is not null and a <> b").select(
        F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"), F.col("a").alias("na"), F.col("b").alias("nb"))
    names = both.select(F.col("a").alias("key"), F.col("na").alias("node")).union(both.select("b", "nb")).distinct()
    labels, labels_path = written(names.withColumn("root", F.col("key")).drop("key"), "component-labels")
    links, links_path = written(both.select("a", "b").distinct(), "component-edges")
    while not links.isEmpty():
        two_way = links.union(links.select("b", "a"))
        hooks, hooks_path = written(
            two_way.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "from"), "component-hooks")
        old, old_path = links_path, labels_path
        labels, labels_path = written(
            labels.join(hooks, F.col("root") == F.col("from"), "left")
            .select("node", F.coalesce("to", "root").alias("root")), "component-labels")
        left = links.join(hooks.select(F.col("from").alias("a"), F.col("to").alias("ta")), "a")
        right = left.join(hooks.select(F.col("from").alias("b"), F.col("to").alias("tb")), "b")
        links, links_path = written(
            right.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
            "component-edges")
        for path in (old, old_path, hooks_path):
            drop_folder(spark, path)
    drop_folder(spark, links_path)
    return labels


def label_components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``size`` nodes' component under the edges (a, b)."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        moved = label.copy()
        np.minimum.at(moved, label[a], low)
        np.minimum.at(moved, label[b], low)
        while (again := moved[moved]).tobytes() != moved.tobytes():
            moved = again
        if (moved == label).all():
            return label
        label = moved

"""Tables written to the shared folder, and connected components of an edge table."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence.session import shared_folder


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; ``file:/x`` is the same as ``file:///x``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


class Stage:
    """Tables of one run in a folder of the cluster's shared store.

    A table that is written and read again has no lineage left to recompute, whichever
    executor is lost, and is computed once.
    """

    def __init__(self, spark, name: str):
        self.spark, self.folder = spark, shared_folder(spark, name)
        self.held: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def free(self, *frames: DataFrame) -> None:
        """Delete tables of this run that nothing will read again."""
        for frame in frames:
            for own, path in [x for x in self.held if x[0] is frame]:
                fs, at = store(path)
                fs.delete_dir(at)
                self.held.remove((own, path))


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """node, label of every node of edges (a, b); label is the smallest node that it reaches.

    Each round takes the smallest label among the neighbours, then follows labels once
    (labels are nodes of the same component), so paths shrink fast and stars at once. Both
    joins are plain equi-joins whose hot keys AQE splits; minima are combined before the shuffle.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "near").alias("up"))
        lower = stage(lower)
        jump = lower.select(F.col("node").alias("up"), F.col("up").alias("next"))
        new = stage(lower.join(jump, "up").select("node", "old", F.least("up", "next").alias("label")))
        labels = new.select("node", "label")
        if new.filter(F.col("label") != F.col("old")).isEmpty():
            return labels

"""Names by hierarchy: a tree of terms walked upwards to the nearest name that is known.

The tree is a table (term, parent); a term may have several parents, as a descriptor has that
stands in several places. One join per level gives every term's ancestors with their distance;
labels are then mapped by an equi-join, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import cut_lineage

MAX_DEPTH = 32


def ancestors(tree: DataFrame, terms: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """term, ancestor, distance; a term is its own ancestor at distance 0.

    ``terms`` (a column ``term``) says where to start, all of the tree for None. Of several ways
    up the shortest counts; cycles end at ``max_depth``. Terms are compared as vocabulary keys.
    """
    edges = tree.select(text.label("term").alias("term"), text.label("parent").alias("parent")) \
        .filter("term <> '' AND parent <> '' AND term <> parent").distinct()
    if terms is None:
        start = edges.select("term").union(edges.select("parent")).distinct()
    else:
        start = terms.select(text.label("term").alias("term")).filter("term <> ''").distinct()
    edges = cut_lineage(edges.select(F.col("term").alias("ancestor"), "parent"))
    level = walked = cut_lineage(start.select("term", F.col("term").alias("ancestor"), F.lit(0).alias("distance")))
    for distance in range(1, int(max_depth) + 1):
        # a level is stored before the next one, and holds an ancestor once by however many ways
        level = cut_lineage(level.join(edges, "ancestor").select("term", F.col("parent").alias("ancestor"))
                            .distinct().withColumn("distance", F.lit(distance)))
        if level.isEmpty():
            break
        walked = walked.unionByName(level)
    return walked.groupBy("term", "ancestor").agg(F.min("distance").alias("distance"))


def at_depth(tree: DataFrame, depth: int, terms: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """term, ancestor: the ancestors that are ``depth`` steps below a root (0: the roots).

    A term that is nearer to its roots than that has none.
    """
    up = ancestors(tree, terms, max_depth)
    levels = ancestors(tree, up.select(F.col("ancestor").alias("term")), max_depth)
    parents = tree.select(text.label("term").alias("_child")).distinct()
    roots = levels.join(parents, levels["ancestor"] == parents["_child"], "left_anti")
    level = roots.groupBy("term").agg(F.min("distance").alias("level")).withColumnRenamed("term", "ancestor")
    return up.join(level.filter(F.col("level") == depth), "ancestor").select("term", "ancestor").distinct()


def conservative_name(df: DataFrame, column: str, tree: DataFrame, known: DataFrame, name: str = "canonical",
                      max_depth: int = MAX_DEPTH) -> DataFrame:
    """Add the nearest known name of a label: itself, or the nearest ancestor that is known.

    ``known`` has a column ``term``; ties go to the name first in order. A label without any known
    ancestor keeps null, so that nothing is guessed.
    """
    labels = df.select(F.col(column).alias("term")).distinct()
    listed = known.select(text.label("term").alias("ancestor"), F.col("term").alias("_name")) \
        .groupBy("ancestor").agg(F.min("_name").alias("_name"))
    nearest = ancestors(tree, labels, max_depth).join(listed, "ancestor") \
        .groupBy(F.col("term").alias("_term")).agg(F.min(F.struct("distance", "ancestor", "_name")).alias("_up"))
    return (df.withColumn("_term", text.label(column)).join(nearest, "_term", "left")
            .withColumns({name: F.col("_up._name"), f"{name}_distance": F.col("_up.distance")}).drop("_term", "_up"))

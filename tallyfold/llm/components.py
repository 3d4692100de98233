"""Connected components of a graph given by edges, by hooking each root to its least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import remove_folder, run_dir

# Nodes (16 bytes each) that are broadcast to rename the ends of edges.
BROADCAST_NODES = 1_000_000


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes what ``stored`` wrote; nothing may read it any more."""
    for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
        remove_folder(table.sparkSession, path)


def _lookup(labels: DataFrame) -> DataFrame:
    """A written table of labels as the right side of joins, marked for broadcast where its measured size allows it."""
    named = labels.select(F.col("node").alias("_node"), F.col("component").alias("_to"))
    return F.broadcast(named) if labels.count() <= BROADCAST_NODES else named


def _moved(table: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """``table`` with the nodes in ``column`` replaced by their labels, where they have one."""
    return table.join(lookup, F.col(column) == F.col("_node"), "left").withColumn(
        column, F.coalesce("_to", column)).drop("_node", "_to")


def _between(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _roots(parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parents, each less than its node, followed up to the roots; and their lookup."""
    while True:
        lookup = _lookup(parents)
        if parents.join(lookup, F.col("component") == F.col("_node"), "left_semi").isEmpty():
            return parents, lookup
        parents = stored(_moved(parents, "component", lookup), "parents")


def components(spark: SparkSession, edges: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``u, v`` in, ``node, component`` out for every node but the smallest of its component (which is the component).

    ``before`` is what this gave for other edges: the components of all edges come out, and only edges between its components are followed.

    A root that is left with edges has taken in a neighbour, or has a smaller one in the next round: roots halve in two rounds at most.
    """
    labels = before
    if before is not None:
        lookup = _lookup(before)
        edges = _moved(_moved(edges.select("u", "v"), "u", lookup), "v", lookup)
    now = stored(_between(edges), "edges")
    while not now.isEmpty():
        # Sums by node: a hub's edges meet as one row from each task.
        hooked = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        parents, lookup = _roots(stored(hooked, "parents"))
        labels = parents if labels is None else stored(_moved(labels, "component", lookup).unionByName(parents), "labels")
        now = stored(_between(_moved(_moved(now, "u", lookup), "v", lookup)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) if labels is None else labels

"""Connected components of links by repeated contraction, as Spark jobs.

Each round every node joins its neighbour that comes first in a random order (a
hash of the node), links are renamed to what their ends have joined, and links
within one node go. A round shrinks paths, stars and cliques alike by a constant
factor, so the rounds grow with the logarithm of the number of nodes. Each round's
tables are written in the shared folder; no link or label comes to the driver.
Renaming joins are summed first (one row per node), and a hub's many links are one
side of a join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.session import materialize


def connect(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); linked nodes have one root, which is one of them."""
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("root")), "labels")
    order = lambda c: F.struct(F.xxhash64(c).alias("o"), F.col(c).alias("v"))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        joined = materialize(first.select(F.col("a").alias("old"), F.least("m", order("a"))["v"].alias("new")), "joined")
        edges = materialize(
            edges.join(joined, edges["a"] == joined["old"]).select(F.col("new").alias("a"), "b")
            .join(joined, F.col("b") == joined["old"]).select("a", F.col("new").alias("b"))
            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
        labels = materialize(labels.join(joined, labels["root"] == joined["old"], "left").select("node", F.coalesce("new", "root").alias("root")), "labels")
    return labels

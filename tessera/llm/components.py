"""Connected components of a graph in a table, by minimum labels and pointer jumping; no link or label leaves the executors.

Links may come repeated, in either direction, and from a node to itself; a node with only itself is not returned. Links with a null
end are left out. An empty table gives no rows. Other columns are ignored. A chain of n nodes takes some log2(n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(links: DataFrame) -> DataFrame:
    """(v, root) of every node of links (a, b): root the smallest node it is connected with.

    Each round gives a node the smallest label among its own and its neighbours', then that label's label. Labels of
    a round are written to the shared folder. A node with very many links is joined by the skew join."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()  # null ends fall out, too
    both = C.handed(both, "links")
    labels = C.handed(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "v"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.alias("l").join(near.alias("n"), F.col("l.v") == F.col("n.a")).select("l.v", F.col("l.root").alias("old"), F.least("l.root", "n.near").alias("root"))
        jumped = lower.alias("x").join(labels.alias("y"), F.col("x.root") == F.col("y.v"), "left").select("x.v", "x.old", F.least(F.col("x.root"), F.coalesce("y.root", "x.root")).alias("root"))
        new = C.handed(jumped, "labels")
        labels = new.select("v", "root")
        if new.filter("old <> root").limit(1).count() == 0:
            return labels

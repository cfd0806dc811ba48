"""Connected components of a link table, by rounds of minimum labels; nothing is collected but one count a round.

Each round a node takes the smallest of: its label, its neighbours' labels, its label's label, and what nodes that had it as label took
since (so whole trees move at once, and rounds grow with the logarithm of a chain's length). A round is two joins of written tables, so
that adaptive execution can split the keys of large stars, and one aggregation with partial minima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node in ``links``; root is the smallest node that it reaches. Loops and repeated links are harmless; nulls are left out."""
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(links.select(b, a)).where("node IS NOT NULL AND other IS NOT NULL AND node <> other").distinct()
    edges = scratch.keep(both, "edges")
    labels = scratch.keep(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root")).withColumn("old", F.col("node")), "labels-0")
    done = 0
    while True:
        own = labels.select("node", "root", F.col("root").alias("old"))
        near = edges.join(labels.select(F.col("node").alias("other"), "root"), "other").select("node", "root", F.lit(None).cast("long").alias("old"))
        far = labels.select("node", F.col("root").alias("mid")).join(labels.select(F.col("node").alias("mid"), "root"), "mid").select("node", "root", F.lit(None).cast("long").alias("old"))
        up = labels.where("old <> root").select(F.col("old").alias("node"), "root", F.lit(None).cast("long").alias("old"))
        done += 1
        new = own.union(near).union(far).union(up).groupBy("node").agg(F.min("root").alias("root"), F.max("old").alias("old"))
        new = scratch.keep(new, f"labels-{done}")
        scratch.drop(f"labels-{done - 1}")
        labels = new
        if new.where("root <> old").isEmpty():
            return labels.select("node", "root")

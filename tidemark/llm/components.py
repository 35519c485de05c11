"""Connected components of a table of links, without bringing any link to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import checkpoint


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): for each end of a link the smallest node of its component.

    `links` has a and b. Each round gives every node the smallest root among its own and its
    neighbours', then lets it follow that root's root, so a chain of n links needs about log n rounds
    and a star one. A node with many neighbours is folded by a partial minimum before the shuffle.
    Links with a null end are passed over; self links keep their node. Stops when nothing changes; if
    that takes more than `max_rounds` an error is raised rather than a partial answer given.
    """
    ends = links.where("a is not null and b is not null")
    edges = checkpoint(ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpoint(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"))
    for _ in range(max_rounds):
        offered = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("offer"))
        nearer = labels.join(offered, "node", "left").select("node", "root", F.least("root", F.coalesce("offer", "root")).alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("root").alias("up"))
        jumped = nearer.join(up, "new", "left").select("node", "root", F.least("new", F.coalesce("up", "new")).alias("new"))
        jumped = checkpoint(jumped)
        if jumped.where("root <> new").isEmpty():
            return jumped.select("node", F.col("new").alias("root"))
        labels = jumped.select("node", F.col("new").alias("root"))
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")

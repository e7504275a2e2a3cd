"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.session import frozen


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); a component is named by its smallest node.

    Each round a node takes the smallest label among its neighbours' and its own; every third round
    it takes that label's own label as well, so that long chains shorten fast. Labels are kept in the
    shared folder between rounds; only the number of changes comes to the driver. Repeated
    links and links of a node to itself do no harm.
    """
    links = frozen(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = frozen(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    turn = 0
    while True:
        turn += 1
        told = links.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        step = told.unionByName(own).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        if turn % 3 == 0:
            ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
            step = step.join(ahead, "label").select("node", F.least("label", "further").alias("label"), "old")
        step = frozen(step)
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels.select("node", F.col("label").alias("component"))

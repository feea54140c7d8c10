"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.session import scratch_scope, write_observed, write_scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``.

    Smallest labels spread along edges, and each node also hands what it has learned to the node it
    was labelled with; labels then take a jump. Rounds grow with the logarithm of the
    components' diameter in practice. Each round is written, so a lost executor repeats one round
    at most. Sums per node combine before the shuffle, so a hub is no hot spot.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v"))
    both = write_scratch(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = write_scratch(
        both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels"
    )
    while True:
        around = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        seen = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("best"))
        offers = seen.select("node", F.col("best").alias("offer")).union(
            seen.filter(F.col("best") < F.col("label")).select(F.col("label").alias("node"), F.col("best").alias("offer"))
        )
        hooked = offers.groupBy("node").agg(F.min("offer").alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = hooked.join(jump, "label").select("node", F.least("label", "further").alias("label"))
        before = labels.select("node", F.col("label").alias("old"))
        table, metrics = write_observed(
            jumped.join(before, "node"), "labels", changed=F.count_if(F.col("label") != F.col("old"))
        )
        labels = table.select("node", "label")
        if not metrics["changed"]:
            return labels.select("node", F.col("label").alias("component"))

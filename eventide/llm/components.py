"""Connected components of a large edge list by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links``
    (a long, b long).

    Every round takes the smallest label among the neighbours, offers it to the
    node that the old label names as well (so whole trees are hooked, not single
    nodes), then takes the label of the label (pointer jumping). Labels only
    fall, and the rounds end when none does, however many that takes; a chain
    in random order takes about log2 of its length. Each round is a
    written table: a lost executor reads files again and nothing but a count
    reaches the driver. Joins are plain shuffles of two scans, so Spark splits
    a hot node."""
    both = links.filter("a <> b").select("a", "b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc_edges")
    lab = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "cc_labels")
    while True:
        near = (both.join(lab, both["b"] == lab["node"]).groupBy("a").agg(F.min("label").alias("m"))
                .select(F.col("a").alias("node"), "m"))
        step = lab.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        step = materialize(step, "cc_step")
        offers = (step.filter("label <> was").groupBy("was").agg(F.min("label").alias("offer"))
                  .select(F.col("was").alias("root"), "offer"))
        step = materialize(step.join(offers, F.col("node") == F.col("root"), "left")
                           .select("node", "was", F.least("label", "offer").alias("label")), "cc_hooked")
        up = step.select(F.col("node").alias("up"), F.col("label").alias("above"))
        new = materialize(step.join(up, F.col("label") == F.col("up"))
                          .select("node", "was", F.least("label", "above").alias("label")), "cc_labels")
        lab = new.select("node", "label")
        if new.filter("label <> was").isEmpty():
            return lab

"""Connected components of a link table, with DataFrame operations only.

Labels start as the node itself and move to the smallest label met: over links, then by
pointer jumping (the label of the label), until nothing changes.  Each round is written to
the shared folder.  The minimum is aggregated before the shuffle, so a hub with very
many links sends one row per task; nothing but a count of changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veridq.llm.common import materialise


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links(a, b)`` to ``(node, label)``: the smallest node reachable, for every
    node that has a link.  Order, direction and repeats do not matter; null ends and
    loops are ignored; no links give no rows."""
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    # the first round needs no join: the smallest neighbour
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), f"{name}-0")
    k = 0
    while True:
        k += 1
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("m")), "b").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("m"))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "m").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        # labels are nodes, so each has a label of its own
        nxt = materialise(hooked.join(jump, "low").select("node", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")), f"{name}-{k}")
        labels = nxt.select("node", "label")
        if nxt.where("moved").isEmpty():
            return labels

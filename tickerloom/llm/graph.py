"""Connected components of a table of links, by repeated hooking to smaller labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import store


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): for every node of `links` (a, b) the smallest node it reaches.

    Each round takes the smallest label among a node's links (partial minima before the shuffle, so a
    node with very many links is no hot key) and then the label of that label. Labels only fall, so
    a lost executor repeats a round and nothing else; a round's table is written to the shared folder.
    A chain of n links takes about log(n) rounds; a star takes one. No links: an empty table.
    """
    both = store(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    now = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    for _ in range(most_rounds):
        near = (
            both.join(now.withColumnsRenamed({"node": "b", "label": "near"}), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        )
        # A root takes the smallest label that any of its members saw.
        hooks = (
            near.join(now, "node").where("near < label").groupBy(F.col("label").alias("root")).agg(F.min("near").alias("hook"))
        )
        hooked = now.join(hooks, F.col("label") == F.col("root"), "left").select("node", F.least("label", "hook").alias("label"))
        jumped = store(
            hooked.join(hooked.select(F.col("node").alias("mid"), F.col("label").alias("far")), F.col("label") == F.col("mid"), "left")
            .select("node", F.least("label", "far").alias("label"))
        )
        changed = jumped.join(now.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count()
        now = jumped
        if not changed:
            return now
    raise RuntimeError("components did not settle")

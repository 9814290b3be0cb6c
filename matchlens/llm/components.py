"""Connected components of links, by rounds of contraction.

In a round every node points to the least of itself and its neighbours;
pointers are followed to their ends by doubling; the links then join the nodes
at the ends, and a round begins with those that are left. At most half of the
nodes with links are ends, so rounds and doublings are logarithmic in number,
for chains as well. Minima are combined before the shuffle
and the rest are equi-joins, so a node with very many links is no large group;
links are never gathered by node. The driver sees counts alone. Each round is
written to the shared work folder, which cuts the lineage.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.session import work_folder


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reachable, for each node of ``links`` (columns ``a``, ``b``).

    Links have no direction; repeated links, loops and null ends have no effect
    but that a loop's node is listed. An empty frame gives an empty one.
    """
    spark = links.sparkSession
    folder = f"{work_folder(spark)}/components-{uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    left = kept(links.dropna(subset=["a", "b"]).distinct(), "links")
    known = None  # node and the node it has been contracted to
    level = 0
    while True:
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointed = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), f"nearest-{level}")
        jump = 0
        while True:  # follow the pointers until they end, twice as far each time
            onward = pointed.select(F.col("a").alias("to"), F.col("to").alias("next"))
            pointed = kept(pointed.join(onward, "to").select("a", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), f"pointed-{level}-{jump}")
            if pointed.filter("moved").isEmpty():
                break
            jump += 1
        if known is None:
            known = pointed.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            moved = pointed.select(F.col("a").alias("component"), "to")
            known = kept(known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), f"known-{level}")
        ends = [pointed.select(F.col("a").alias(x), F.col("to").alias(f"{x}2")) for x in "ab"]
        moved_links = left.join(ends[0], "a").join(ends[1], "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).filter("a != b")
        left = kept(moved_links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"left-{level}")
        if left.isEmpty():
            return known
        level += 1

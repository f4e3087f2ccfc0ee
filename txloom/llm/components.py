"""Connected components of a graph of links, by alternating stars.

Kiveris et al. (2014): every node links its larger neighbours to the smallest node it knows (large star),
then its smaller ones (small star), until nothing changes. A round is two aggregations and two joins over
links; no component is ever gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txloom.llm.shared import dropped, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b")
    return others.union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node of a link. Loops and repeated links change nothing.

    Null ends take no part; no links give no rows.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    pairs = stored(pairs, "links")
    state, read = None, []
    while True:
        read.append(pairs)
        pairs = stored(_small_star(_large_star(pairs)).where("a <> b").distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == state:
            break
        state = now
    dropped(*read)
    ends = pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return ends.union(pairs.select("a", "a")).groupBy("node").agg(F.min("component").alias("component"))

"""Reachability over child-parent edges, by joins of distinct pairs: no path is listed, so merges don't multiply rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgate.tables import checkpointed

#: Pairs beyond which reached() stops doubling its hops and walks on with those it has.
HOP_PAIRS = 4_000_000


def _edges(edges: DataFrame) -> DataFrame:
    return edges.where("child is not null and parent is not null").select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct()


def _doubled(up: DataFrame, n: int, rounds: int) -> DataFrame:
    """Least paths of up to 2n edges from those of up to n: one of exactly n and another of up to n."""
    far = up.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_up"), F.col("depth").alias("_more"))
    more = up.where(F.col("depth") == n).join(far, "ancestor").select("node", F.col("_up").alias("ancestor"), (F.col("depth") + F.col("_more")).alias("depth"))
    return checkpointed(up.unionByName(more.where(F.col("depth") <= rounds)).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")))


def closure(edges: DataFrame, rounds: int = 100_000) -> DataFrame:
    """node, ancestor, depth (least, at most `rounds`) of all pairs. Any number of parents; cycles end, as a pair is met once."""
    up, n = checkpointed(_edges(edges).where(F.lit(rounds) >= 1)), 1
    while n < rounds and not up.where(F.col("depth") == n).isEmpty():
        up, n = _doubled(up, n, rounds), 2 * n
    return up


def reached(edges: DataFrame, start: str | int) -> DataFrame:
    """node, depth (least) of all that start reaches, itself included, at any depth. Hops are doubled while their pairs are few;
    then a frontier walks on by the longest hops there are, so a long chain takes some dozens of joins, not one a level."""
    spark, n = edges.sparkSession, 1
    hop = checkpointed(_edges(edges))
    kind = hop.schema["node"].dataType.simpleString()
    seen = spark.createDataFrame([(start, 0)], f"node {kind}, depth int")
    more = not hop.where(F.col("depth") == n).isEmpty()
    while more and hop.count() <= HOP_PAIRS:
        hop, n = _doubled(hop, n, 1 << 30), 2 * n
        more = not hop.where(F.col("depth") == n).isEmpty()
    frontier, done = seen, 0
    while not frontier.isEmpty():
        new = frontier.select("node").join(hop, "node").groupBy(F.col("ancestor").alias("node")).agg((F.min("depth") + done).alias("depth"))
        new = checkpointed(new.join(seen.select("node"), "node", "left_anti"))
        seen = checkpointed(seen.unionByName(new))
        done += n
        frontier = new.where(F.col("depth") == done)
    return seen

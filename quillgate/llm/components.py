"""Connected components of a link table.

Up to ALONE links, a bounded number, are one task's work. More go through alternating large and small stars: each round rewrites the
links as aggregates and joins, until one task can take what is left or nothing changes. Nothing of the graph reaches the driver but two
numbers a round. The rounds are checkpointed, so a lost executor costs one round at most.

A round has a dozen stages, and the driver keeps a record of each of their tasks. That is why few links get no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgate.llm.common import checkpointed

#: Links whose components one task finds (16 bytes each, some ten times that while it works).
ALONE = 1 << 20


def _sum(links: DataFrame) -> tuple:
    x = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return x[0], x[1]


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links that is not its component's smallest, and that smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        lo, hi = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = lo < hi
        if not apart.any():
            own = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[own], nodes[label[own]]
        x, y = x[apart], y[apart]
        np.minimum.at(label, hi[apart], lo[apart])  # labels are smallest nodes so far, so each goes to a smaller one
        while True:
            new = label[label]
            if (new == label).all():
                break
            label = new


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if own:
        node, root = smallest(np.concatenate([a for a, _ in own]), np.concatenate([b for _, b in own]))
        yield pa.record_batch({"node": node, "root": root})


def roots(links: DataFrame) -> DataFrame:
    """node, root for every node of links (a long, b long) that is not its component's smallest."""
    e = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _sum(e)
    while seen[0] > ALONE:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        small = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        e = checkpointed(small.where("a <> b").distinct())
        now = _sum(e)
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    return checkpointed(e.coalesce(1).mapInArrow(_alone, "node long, root long"))

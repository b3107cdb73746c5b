r"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are dealt to blocks by a hash of their id; each block holds its matrix and, for each dimension, the order of its rows
by that component: the sorted lists. A query reads the lists from the end that its component's sign favours, all dimensions
to the same depth, and scores each row when it first meets it. The bound is the score of a vector that had every list's current
component; when the k-th score so far is above it, no row further down can enter, ties included, and the query is done with the
block. Depths double. Once half of a block's rows are met, what its lists still hold is as good as all of the other rows, and these are
scored in one product for all queries that have come so far: the end of the lists, not a way around them.

A first round searches one block for each query; its k-th score is where the bound starts from in all others, as the k-th score of
the whole can't be less. Each (queries, block) pair is a task of bounded size; a block is shipped to its queries' groups, k rows a
pair go on to a window over each query. Queries and blocks both grow with the table, which is what a stated query set against all
rows costs; nothing else does. `reads` tells for each (query, block) how deep the lists were read and how many rows were scored.

Defined cases: a vector that is null, empty or holds a null or non-finite component takes no part, nor does one with a null
id; vectors meet only those of their own length; rows with the query's id are its own; fewer than k candidates are all
returned; ties go to the smaller id; an empty table gives no rows. Components are floor(scale * x), x as double.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.llm.common import stored

BLOCK, QUERIES, FIRST_DEPTH = 8192, 512, 4


def integers(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (array of long) of the vectors that take part."""
    x = F.transform(vector_col, lambda c: c.cast("double"))
    finite = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    v = vectors.where(F.col(id_col).isNotNull() & finite & (F.size(vector_col) > 0))
    return v.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v"))


def _small(a: np.ndarray) -> np.ndarray:
    kind = next(t for t in (np.int16, np.int32, np.int64) if not a.size or abs(a).max() <= np.iinfo(t).max)
    return np.ascontiguousarray(a.astype(kind))


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every product sum is an exact double, else as long."""
    top = float(abs(a).max(initial=0)) * float(abs(b).max(initial=0)) * a.shape[-1]
    kind = np.float64 if top < 2.0**53 else np.int64
    return a.astype(kind), b.astype(kind)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores, ties to the smaller id."""
    rows = np.arange(len(scores))
    if len(scores) > k:
        rows = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return rows[np.lexsort((ids[rows], -scores[rows]))][:k]


@dataclass
class Found:
    """The k best rows of a block for one query; how deep the lists were read, and how many rows were scored for it alone."""

    ids: np.ndarray
    scores: np.ndarray
    depth: int
    scored: int


def threshold_top_k(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, order: np.ndarray, k: int, least: np.ndarray | None = None) -> list[Found]:
    """For each query its k best rows of the block. order[d]: rows by component d, highest first. least: by query a score that the
    k-th of all blocks reaches; rows below it may be missing from the result."""
    n, dims = c.shape
    q, c = _exact(q, c)
    lists = np.take_along_axis(c.T, order.astype(np.int64), axis=1)  # components in list order
    out: list = [None] * len(q)
    rest: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
    for i, x in enumerate(q):
        up, down = np.flatnonzero(x > 0), np.flatnonzero(x < 0)
        met, rows, scores, depth = c_ids == q_ids[i], np.zeros(0, np.int64), np.zeros(0, c.dtype), 0
        known = -np.inf if least is None else least[i]
        to = min(FIRST_DEPTH, n)
        while True:
            new = np.concatenate([order[up, depth:to].ravel(), order[down, n - to : n - depth].ravel()]).astype(np.int64)
            new = np.unique(new[~met[new]])
            met[new] = True
            rows, scores, depth = np.concatenate([rows, new]), np.concatenate([scores, c[new] @ x]), to
            bound = np.where(x > 0, x * lists[:, depth - 1], x * lists[:, n - depth]).sum()
            kth = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf
            if max(kth, known) > bound or depth == n and len(up) + len(down):
                own = _best(scores, c_ids[rows], k)
                out[i] = Found(c_ids[rows[own]], scores[own], depth, len(rows))
                break
            if 2 * len(rows) >= n or depth == n:
                rest[i] = (met, rows, scores, depth)
                break
            to = min(2 * depth, n)
    if rest:
        asked = list(rest)
        s = q[asked] @ c.T
        for row, i in enumerate(asked):
            met, rows, scores, depth = rest[i]
            left = np.flatnonzero(~met)
            rows, scores = np.concatenate([rows, left]), np.concatenate([scores, s[row][left]])
            own = _best(scores, c_ids[rows], k)
            out[i] = Found(c_ids[rows[own]], scores[own], n, len(rows))
    return out


def sorted_lists(vectors: DataFrame, blocks: int) -> DataFrame:
    """dims, block, n, ids, matrix, lists, kinds: the index, a row for each block."""

    def build(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        c = _small(np.stack([np.asarray(x, np.int64) for x in b.v]))
        order = _small(np.argsort(-c.astype(np.int64), axis=0, kind="stable").T)
        return pd.DataFrame({"dims": [key[0]], "block": [key[1]], "n": [len(b)], "ids": [b.id.to_numpy("<i8").tobytes()], "matrix": [c.tobytes()], "lists": [order.tobytes()], "kinds": [f"{c.dtype.str} {order.dtype.str}"]})

    dealt = vectors.select(F.size("v").alias("dims"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    return dealt.groupBy("dims", "block").applyInPandas(build, "dims int, block int, n int, ids binary, matrix binary, lists binary, kinds string")


FOUND = "query_id long, vec_id long, score long, depth int, scored int, n int"


def _searched(q: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The k best rows of each (query, block) that q (dims, part, q_ids, q, least, block) asks for, with what was read."""

    def search(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in b.itertuples():
            c_kind, o_kind = r.kinds.split()
            q_ids, c_ids = np.frombuffer(r.q_ids, "<i8"), np.frombuffer(r.ids, "<i8")
            found = threshold_top_k(np.frombuffer(r.q, "<i8").reshape(-1, r.dims), q_ids, np.frombuffer(r.matrix, c_kind).reshape(-1, r.dims), c_ids, np.frombuffer(r.lists, o_kind).reshape(r.dims, -1), k, np.frombuffer(r.least, "<f8"))
            each = [len(f.ids) for f in found]
            out.append(pd.DataFrame({"query_id": np.repeat(q_ids, each), "vec_id": np.concatenate([f.ids for f in found]), "score": np.concatenate([f.scores for f in found]).astype(np.int64), "depth": np.repeat([f.depth for f in found], each), "scored": np.repeat([f.scored for f in found], each), "n": len(c_ids)}))
        return pd.concat(out)

    return q.join(index, ["dims", "block"]).groupBy("dims", "part", "block").applyInPandas(search, FOUND)


def searched(vectors: DataFrame, is_query: Column, k: int = 20, **columns) -> DataFrame:
    """query_id, vec_id, score, depth, scored, n: of each query and block the rows that may be among the k best."""
    v = stored(integers(vectors, **columns), "vectors")
    blocks = max(1, math.ceil(v.count() / BLOCK))
    index = stored(sorted_lists(v, blocks), "sorted-lists")
    asked = v.where(is_query).select(F.size("v").alias("dims"), "id", "v")
    groups = max(1, math.ceil(asked.count() / QUERIES))

    def pack(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": [key[0]], "part": [key[1]], "q_ids": [b.id.to_numpy("<i8").tobytes()], "q": [np.stack([np.asarray(x, "<i8") for x in b.v]).tobytes()], "least": [b.least.to_numpy("<f8").tobytes()]})

    def packed(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
        return rows.withColumn("part", part).groupBy("dims", "part").applyInPandas(pack, "dims int, part int, q_ids binary, q binary, least binary")

    own = F.pmod(F.col("part"), F.lit(blocks)).cast("int")
    first = packed(asked.withColumn("least", F.lit(float("-inf")))).withColumn("block", own)
    # a block of these dimensions may be empty; its queries then start without a bound
    near = stored(_searched(first, index, k), "first-blocks")
    kth = near.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("least")).where(F.col("c") == k).select(F.col("query_id").alias("id"), F.col("least").cast("double").alias("least"))
    bound = asked.join(kth, "id", "left").fillna(float("-inf"), ["least"]) if blocks > 1 else None
    if bound is None:
        return near
    others = packed(bound).withColumn("own", own).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where("block <> own").drop("own")
    return near.unionByName(_searched(others, index, k))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, **columns) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on id."""
    near = searched(vectors, is_query, k, **columns).select("query_id", "vec_id", "score")
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def reads(found: DataFrame) -> DataFrame:
    """pairs (of query and block), stopped (by the bound, before the lists' end), scored (share of the blocks' rows) of searched()."""
    each = found.select("query_id", "depth", "scored", "n").distinct()
    return each.agg(F.count("*").alias("pairs"), F.count_if(F.col("depth") < F.col("n")).alias("stopped"), (F.sum("scored") / F.sum("n")).alias("scored"))

import math

import numpy as np
from pyspark.sql import functions as F

from quillgate.llm import topk


def brute(data, k):
    v = {i: [math.floor(64 * x) for x in e] for i, e in data if i is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q and len(v[c]) == len(v[q]))[:k]
            out += [(q, n, c, -x) for n, (x, c) in enumerate(s, 1)]
    return sorted(out)


def test_agrees_with_brute_force(spark, monkeypatch):
    r = np.random.default_rng(0)
    data = [(i, [float(x) for x in r.normal(0, 1, 6).round(1)]) for i in range(300)]
    data += [(320, None), (340, []), (360, [1.0, None]), (380, [1.0, float("nan")]), (400, [float("inf")] * 6), (None, [1.0] * 6), (420, [0.0] * 6), (440, [1.0, 2.0]), (461, [3.0, 1.0]), (480, [5.0, 5.0, 5.0])]
    monkeypatch.setattr(topk, "BLOCK", 64)
    df = spark.createDataFrame([(i, e, "l") for i, e in data], "vec_id long, embedding array<double>, label string")
    got = topk.top_k(df, F.col("id") % 20 == 0, 20)
    assert sorted(tuple(x) for x in got.collect()) == brute(data, 20)


def lists_of(c):
    return np.argsort(-c, axis=0, kind="stable").T


def exact(q, c, k):
    s = c @ q
    return np.lexsort((np.arange(len(c)), -s))[:k]


def test_stops_early_where_the_bound_allows():
    """A few rows are large everywhere: the lists end after them."""
    r = np.random.default_rng(1)
    c = r.integers(-3, 4, (4000, 8))
    c[:40] = 60 + r.integers(0, 3, (40, 8))
    found = topk.threshold_top_k(np.ones((1, 8), int), np.array([-1]), c, np.arange(4000), lists_of(c), 20)[0]
    assert (found.ids == exact(np.ones(8, int), c, 20)).all()
    assert found.depth <= 64 and found.scored <= 64 * 8 < 4000 / 4


def test_sparse_queries_stop_early_in_blocks_of_any_size():
    """Queries of few dimensions over skewed components, as learnt sparse vectors have them."""
    r = np.random.default_rng(2)
    for n in (300, 2000, 8192):
        c = np.floor(r.pareto(1.5, (n, 64)) * 10).astype(int)
        q = np.zeros((40, 64), int)
        for row in q:
            row[r.choice(64, 3, replace=False)] = r.integers(1, 20, 3)
        found = topk.threshold_top_k(q, np.full(40, -1), c, np.arange(n), lists_of(c), 10)
        assert all((f.ids == exact(x, c, 10)).all() for f, x in zip(found, q, strict=True))
        assert np.mean([f.depth < n for f in found]) > 0.9 and np.mean([f.scored for f in found]) < n / 2


def test_a_known_score_stops_earlier_and_loses_nothing_above_it():
    r = np.random.default_rng(3)
    c, q = r.integers(-50, 50, (3000, 6)), r.integers(-50, 50, (30, 6))
    free = topk.threshold_top_k(q, np.full(30, -1), c, np.arange(3000), lists_of(c), 5)
    least = np.array([f.scores[1] for f in free], float)  # the second best: all above it must be there
    told = topk.threshold_top_k(q, np.full(30, -1), c, np.arange(3000), lists_of(c), 5, least)
    assert all((t.ids[:1] == f.ids[:1]).all() and t.depth <= f.depth for t, f in zip(told, free, strict=True))


def test_lists_are_read_to_the_end_without_structure():
    r = np.random.default_rng(4)
    c, q = r.integers(-64, 64, (500, 64)), r.integers(-64, 64, (20, 64))
    q[0] = 0
    found = topk.threshold_top_k(q, np.arange(20), c, np.arange(500), lists_of(c), 600)
    for i, f in enumerate(found):
        want = np.lexsort((np.arange(500), -(c @ q[i])))
        assert (f.ids == want[want != i]).all()


def test_reads_are_counted(spark):
    rows = [(i, [float(x) for x in ([9.0 + i % 2] * 4 if i < 30 else [i % 7 / 10] * 4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    told = topk.reads(topk.searched(df, F.col("id") % 20 == 0, 5)).first()
    assert told["pairs"] == 30 and told["stopped"] >= 25 and told["scored"] < 0.5


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("id") % 20 == 0).count() == 0

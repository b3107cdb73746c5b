import random

import pytest
from test_simhash import components

from quillgate.llm import components as C


def linked(r, n, links):
    nodes = [r.randrange(-(1 << 62), 1 << 62) for _ in range(n)]
    return nodes, [tuple(r.sample(nodes, 2)) for _ in range(links)] + [(x, x) for x in nodes[:3]] + list(zip(nodes[:60], nodes[1:60], strict=False))


@pytest.mark.parametrize("alone", [0, 200, 1 << 20])
def test_all_ways_give_the_smallest_node(spark, monkeypatch, alone):
    nodes, links = linked(random.Random(3), 500, 260)
    monkeypatch.setattr(C, "ALONE", alone)
    want = {(n, x) for n, x in components(nodes, links).items() if n != x}
    got = C.roots(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    assert len(got) == len(want) and {(r["node"], r["root"]) for r in got} == want
    assert C.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_links_get_no_rounds(spark):
    """The driver keeps a record of each task, so a graph that one task can take must not cost rounds of jobs."""
    path = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long").repartition(7)
    context = spark.sparkContext
    context.setJobGroup("few-links", "")
    try:
        assert {(r["node"], r["root"]) for r in C.roots(path).collect()} == {(i, 0) for i in range(1, 501)}
        assert len(context.statusTracker().getJobIdsForGroup("few-links")) <= 12
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)

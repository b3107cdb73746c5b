import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from quillgate.functions import statistics
from quillgate.functions.text import word_errors
from quillgate.operators import events as E
from quillgate.operators import governance as G
from quillgate.operators import memory as M
from quillgate.operators import metrics as X

T0 = dt.datetime(2026, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_error_rates(spark, rows):
    p = spark.createDataFrame([("é a b", "e a b", "x"), ("one two three", "one three", "y"), ("", "", "y")], "reference string, said string, g string")
    assert [r[0] for r in p.select(word_errors("reference", "said")).collect()] == [1, 1, 0]
    assert rows(X.error_rate(p, ["g"], strata=True), "g", "errors", "length") == [("x", 1, 5), ("y", 4, 13), (None, 5, 18)]


def test_wilson_and_bootstrap(spark):
    statistics.register(spark)
    assert spark.sql("SELECT round(wilson_lower(9990, 10000), 5)").first()[0] == 0.99816
    rows = spark.range(400).select("id", (F.col("id") % 10 == 0).cast("int").alias("e"), F.lit(1).alias("n"))
    r = X.bootstrap(rows, "e", "n", "id").first()
    assert r["rate"] == 0.1 and 0.06 < r["lower"] < 0.1 < r["upper"] < 0.14


def test_gates(spark, rows):
    gates = spark.createDataFrame([("a", "gte", 0.9, 10), ("b", "lte", 0.1, 1), ("c", "eq", 1.0, 1), ("d", "non_inferior", 0.02, 1), ("e", "gte", 0.5, 1)], "evaluation_id string, operator string, threshold double, sample_count int")
    got = spark.createDataFrame([("a", 0.95, 9), ("b", 0.05, 5), ("c", 1.0, 5), ("d", -0.01, 5)], "evaluation_id string, value double, n int")
    res = X.gate_results(got, gates).cache()
    assert rows(res, "evaluation_id", "passed") == [("a", False), ("b", True), ("c", True), ("d", True), ("e", False)]
    assert dict(rows(X.dependent(res, "b", "a"), "evaluation_id", "passed"))["b"] is False
    caps = spark.createDataFrame([("x", ["b", "c"]), ("y", ["b", "a"]), ("z", []), ("w", ["?"])], "capability_id string, evaluation_id array<string>")
    assert rows(X.capabilities(caps, res), "capability_id", "passed") == [("w", False), ("x", True), ("y", False), ("z", False)]
    before = res.select("evaluation_id", F.lit(True).alias("passed"))
    assert tuple(X.promotion(res, before, ["a"]).first()) == (False, 2, 2, 1)


def test_recall_keeps_namespaces_apart(spark, rows):
    v = spark.createDataFrame([(1, "u", [1.0, 0.0]), (2, "u", [0.9, 0.1]), (3, "w", [1.0, 0.0]), (4, "u", [0.0, 1.0])], "id long, ns string, v array<double>")
    found = X.top_neighbours(v.where("id = 1"), v, 2, ("ns",))
    assert rows(found, "id", "rank") == [(2, 1), (4, 2)]
    truth = spark.createDataFrame([(1, 2), (1, 3)], "query_id long, id long")
    assert tuple(X.recall_at(found, truth).first()) == (1, 0.5)


def test_persona_growth_provenance(spark, rows):
    p = spark.createDataFrame([(1, True, [1.0]), (2, False, [1.0]), (3, False, [-1.0]), (4, None, [1.0]), (5, False, [0.0])], "i int, hard boolean, v array<double>")
    assert [r["stage"] for r in X.persona_filter(p, F.col("hard"), "v", F.array(F.lit(1.0))).orderBy("i").collect()] == ["hard", "kept", "cosine", "hard", "cosine"]
    s = spark.createDataFrame([("a", i, i) for i in range(5)] + [("b", i, i % 2) for i in range(5)], "s string, at int, v int")
    assert rows(X.growth(s, "s", "at", "v", 4), "s", "unbounded") == [("a", True), ("b", False)]
    r = spark.createDataFrame([(1, ["e1"]), (2, ["e1", "?"]), (3, [])], "id int, evidence array<string>")
    assert tuple(X.provenance(r, spark.createDataFrame([("e1",)], "evidence_id string")).first())[:2] == (3, 1)
    a = spark.createDataFrame([("k", "abcd"), ("m", "x")], "k string, text string")
    b = spark.createDataFrame([("k", "abcx"), ("n", "x")], "k string, text string")
    assert rows(X.consensus(a, b, "k", 0.25), "k") == [("k",)]
    assert rows(G.disputed(a, b, "k", 0.3), "k") == [("m",), ("n",)]


def test_sequences(spark, rows):
    e = spark.createDataFrame([("s", i, q) for i, q in enumerate([0, 1, 3, 3, 2, 4])], "k string, arrival int, q int")
    assert [r["fault"] for r in E.sequence_faults(e, "k", "q", ["arrival"], 0).orderBy("arrival").collect()] == [None, None, "gap", "duplicate", "late", None]
    assert rows(E.sequence_summary(e, "k", "q")) == [("s", 6, 0, 0, 1)]
    w = E.replay_window(e, "k", "q", ["arrival"], 2).orderBy("arrival").collect()
    assert [r["verdict"] for r in w] == ["accepted", "accepted", "accepted", "duplicate", "accepted", "accepted"]
    ack = spark.createDataFrame([("s", 1), ("s", 2)], "k string, acknowledged int")
    assert rows(E.resumable(e, ack, "k", "q"), "q") == [(3,), (3,), (4,)]
    cut = spark.createDataFrame([("s", 2)], "k string, last_allowed int")
    assert E.after_cancellation(e, cut, "k", "q").count() == 3


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[::7])
def test_lifecycle_doesnt_depend_on_row_order(spark, rows, order):
    life = ["tool.requested", "tool.started", "tool.progress", "tool.failed"]
    data = [("ok", i, life[i], "t") for i in order] + [("no", 0, "tool.started", "t"), ("mix", 0, "tool.requested", "t"), ("mix", 1, "tool.started", "u"), ("mix", 2, "tool.completed", "t")]
    got = E.tool_lifecycles(spark.createDataFrame(data, "call_id string, sequence int, type string, trace_id string"))
    assert rows(got, "call_id", "valid", "one_trace") == [("mix", True, False), ("no", False, True), ("ok", True, True)]


def test_sessions_asof_pairs(spark, rows):
    e = spark.createDataFrame([(i, "u", at(s), k) for i, (s, k) in enumerate([(0, "a"), (10, "b"), (40, "b"), (41, "a")])], "id int, u string, ts timestamp, kind string")
    assert rows(E.gap_sessions(e, "u", "ts", 30), "session", "n") == [(1, 2), (2, 2)]
    assert rows(E.followed_by(e, "u", "ts", F.col("kind") == "a", F.col("kind") == "b", 40, "id"), "first_id", "then_id") == [(0, 1), (0, 2)]
    got = E.asof(e.where("kind = 'a'"), e.where("kind = 'b'"), "u", "ts", "ts", ["id"], "id")
    assert rows(got, "id", "asof_id") == [(0, None), (3, 2)]
    p = e.withColumn("p", F.col("kind") == "b")
    assert rows(E.coalesced_progress(p, "u", "id", F.col("p")), "id") == [(0,), (2,), (3,)]
    c = E.correlated(e.where("kind = 'a'"), e.where("kind = 'b'"), ["u"], "10 seconds")
    assert rows(c, "id", "r_id") == [(0, 1), (3, 2)]
    f = spark.createDataFrame([("s", at(0), at(0)), ("s", at(9), at(1)), ("s", at(2), at(2)), ("s", at(8), at(3))], "s string, shown timestamp, came timestamp")
    assert [r["late"] for r in E.lateness(f, "s", "shown", "came", 3000).orderBy("came").collect()] == [False, False, True, False]
    h = spark.createDataFrame([("audio", 2, bytearray(b"ab")), ("x", 2, bytearray(b"ab")), ("audio", 9, bytearray(b"a")), ("audio", 1, bytearray(b"ab"))], "kind string, length int, payload binary")
    assert [r["fault"] for r in E.header_faults(h, ("audio",), 4).collect()] == [None, "kind", "length", "payload"]
    q = spark.createDataFrame([(1, "read-only"), (1, "tool-use")], "u int, requested string")
    g = spark.createDataFrame([(1, "tool-use")], "u int, permission string")
    assert rows(E.permitted(q, g, "u"), "requested", "allowed") == [("read-only", False), ("tool-use", True)]


def ops(spark, *steps):
    return spark.createDataFrame([(i, 0, "n", m, o, v, x) for i, (m, o, v, x) in enumerate(steps)], "commit_seq int, op_index int, namespace_id string, memory_id string, operation string, value string, expected_revision int")


def test_memory_fold(spark, rows):
    o = ops(spark, ("a", "create", "1", None), ("a", "replace", "2", 1), ("b", "create", "x", None), ("a", "delete", None, 2), ("b", "supersede", None, 1), ("a", "restore", None, 3), ("b", "replace", "y", 9), ("c", "create", "z", None), ("c", "delete", None, 1))
    assert rows(M.fold(o), "memory_id", "revision", "value") == [("a", 4, "2"), ("b", 3, "y")]
    assert rows(M.snapshot(o, 3), "memory_id") == [("b",)]
    assert rows(M.conflicts(o), "memory_id", "expected_revision", "met") == [("b", 9, 2)]
    assert rows(M.diff(M.snapshot(o, 1), M.fold(o)), "memory_id", "change") == [("a", "changed"), ("b", "added")]
    index = o.select("namespace_id", "memory_id").distinct().withColumn("revision", F.lit(4))
    assert rows(M.without_deleted(index, o), "memory_id") == [("a",), ("b",)]
    assert rows(M.stale(index, o), "memory_id") == [("b",), ("c",)]
    s = ops(spark, ("a", "create", "1", None), ("a", "supersede", None, 1), ("a", "delete", None, 2), ("a", "restore", None, 3))
    assert rows(M.fold(s, live_only=False), "status", "value") == [("superseded", "1")]


def test_trust_access_lineage(spark, rows):
    r = spark.createDataFrame([("k", "user_statement", "a"), ("k", "tool_observation", "b"), ("m", "user_correction", "x"), ("m", "user_correction", "y"), ("z", "nonsense", "q")], "k string, kind string, v string")
    assert rows(M.most_trusted(r, ["k"], "kind", "v")) == [("k", 2, "a", False), ("m", 1, None, True), ("z", 7, "q", False)]
    users, grants = spark.createDataFrame([("s1", 1)], "subject string, user_id int"), spark.createDataFrame([(1, "active", None), (2, "active", None)], "user_id int, status string, expires_at timestamp")
    req = spark.createDataFrame([("s1", True, 1, at(0)), ("s1", True, 2, at(0)), ("s1", False, 1, at(0)), ("s9", True, 1, at(0)), ("s1", None, 1, at(0))], "subject string, token_valid boolean, owner_id int, at timestamp")
    assert rows(M.access(req, users, grants), "allowed") == [(False,)] * 4 + [(True,)]
    ids = spark.createDataFrame([("a@x",), ("b@x",)], "email string")
    assert rows(M.on_allowlist(ids, spark.createDataFrame([("a@x",), ("*@x",)], "email string"))) == [("a@x",)]
    m = spark.createDataFrame([("u", "c"), ("u", "d"), (None, "c")], "user_id string, character_id string")
    assert M.in_namespace(m, "u", "c").count() == 1
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "x"), ("p", "q"), ("q", "p")], "child string, parent string")
    up = rows(M.reachable(e), "node", "ancestor")
    assert ("c", "a") in up and ("c", "x") in up and ("p", "p") in up and ("b", "c") not in up
    assert rows(G.lineage_roots(e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("p", "p"), ("q", "p"), ("x", "a")]


def test_governance(spark, rows):
    src = spark.createDataFrame([(1, "owned", "accepted"), (2, "owned", "quarantine")], "source_id int, rights_status string, status string")
    s = spark.createDataFrame([(1, 1, "owned", "accepted"), (2, 2, "owned", "accepted"), (3, 1, "unknown", "accepted"), (4, 9, "owned", "accepted"), (5, 1, "owned", "rejected")], "i int, source_id int, rights_status string, status string")
    assert [r["route"] for r in G.routed(s, src).orderBy("i").collect()] == ["accepted", "quarantine", "quarantine", "quarantine", "rejected"]
    v = spark.createDataFrame([("speech", 10.0, 0.5, None), ("speech", 10.0, 2.0, 0.5), ("singing", 4.0, 1.0, 1.0)], "kind string, h double, a double, b double")
    assert rows(G.effective_volume(v, ["kind"], "h", [F.col("a"), F.col("b")])) == [("singing", 4.0, 4.0), ("speech", 20.0, 5.0)]
    t = G.split(spark.range(1000), (F.col("id") / 10).cast("int"))
    assert G.leaks(t.withColumn("root", (F.col("id") / 10).cast("int")), ["root"]).count() == 0
    assert 600 < t.where("split = 'train'").count() < 950
    tr = spark.createDataFrame([("h", "t", "1"), ("h", " ", "1"), (None, "t", "1")], "parent_hash string, tool string, version string")
    assert G.untraced(tr).count() == 2
    assert G.push_payload(s, ("i", "status")).columns == ["i", "status"]


def test_adjudication(spark, rows):
    a = spark.createDataFrame([(1, 1, None), (1, 0, 0), (1, 0, None)], "a int, b int, c int")
    assert rows(a.select(X.adjudicated(a, "a", "b", "c"))) == [(0,), (1,), (None,)]
    t = spark.createDataFrame([(1, False), (2, False), (3, True)], "i int, allowed boolean")
    assert rows(X.unaudited(t, t.where("i = 1"), "i"), "i") == [(2,)]
    d = X.paired_delta(spark.createDataFrame([(1, 0.1), (2, 0.2)], "k int, w double"), spark.createDataFrame([(1, 0.2), (2, 0.3), (3, 9.0)], "k int, w double"), "k", "w").first()
    assert d["n"] == 2 and abs(d["delta"] - 0.1) < 1e-9 and d["bound"] >= d["delta"] - 1e-9


def test_reachable_has_no_hidden_depth(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(700)] + [(900, 901), (901, 900)], "child long, parent long")
    up = M.reachable(e)
    far = up.where("node = 0").agg(F.max("depth"), F.count("*"), F.max("ancestor")).first()
    assert tuple(far) == (700, 700, 700) and up.where("node < 800").count() == 700 * 701 // 2
    assert sorted(map(tuple, up.where("node >= 900").collect())) == [(900, 900, 2), (900, 901, 1), (901, 900, 1), (901, 901, 2)]
    assert M.reachable(e, 3).agg(F.max("depth")).first()[0] == 3

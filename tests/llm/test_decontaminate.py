import hashlib
import random
import re

from quillgate.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items):
    win = {}
    for i, t in items:
        w = words(t)
        for s in range(max(len(w) - 9, 1) if w else 0):
            win.setdefault(tuple(w[s : s + 10]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for phrase, own in win.items():
            for s in range(len(w) - len(phrase) + 1):
                if tuple(w[s : s + len(phrase)]) == phrase:
                    hit.update(range(s, s + len(phrase)))
                    ids.update(str(x) for x in own if x is not None)
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, h long")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in D.decontaminate(d, b).collect()), key=str)


def test_agrees_with_brute_force(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Äö", "x9", "the", "the", "the"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 10, 14]))) for i in range(12)] + [(12, None), (13, "!!"), (None, "w1 w2 w3"), (1, "w5 w6")]
    docs = [(i, text(60)) for i in range(15)] + [(20, None), (21, ""), (22, items[3][1]), (22, items[3][1]), (None, "W1, w2. w3"), (23, " ".join(x[1] or "" for x in items[:6]) * 3)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_sides(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, items = [(i, f"a b c d{i} e f") for i in range(9)], [(1, "b c d3"), (2, "e f")]
    want = run(spark, docs, items)
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(D, "BROADCAST_IDS", -1)
    assert run(spark, docs, items) == want == brute(docs, items)


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha x beta"), (2, "alpha beta"), (3, "alpha x x x beta")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    w = D.windows_of(b)
    anchors = D.rarest(w, D.term_counts(d, w.selectExpr("explode(terms) AS term").distinct()))
    index = D.build_index(d, anchors.selectExpr("t1 AS term", "n1 AS n").union(anchors.selectExpr("t2", "n2")))
    assert {r["doc_id"] for r in D.intersect(index, anchors, 0).collect()} == {2}
    assert {r["doc_id"] for r in D.intersect(index, anchors, 1).collect()} == {1, 2}


def test_clean_keeps_other_documents(spark, docs):
    b = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    left = D.clean(docs, b)
    assert left.columns == docs.columns and left.count() == docs.count() - 3
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")

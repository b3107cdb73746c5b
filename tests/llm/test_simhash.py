import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from quillgate.llm import simhash as S

SPACE = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, k=4):
    w = SPACE.findall((text or "").translate(LOW))
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fp = {(i, f"{fingerprint(t):016x}") for i, t in rows}
    assert {(r["doc_id"], f"{r['fp'] % 2**64:016x}") for r in got} == fp
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert S.near_duplicates(no_docs).count() == 0


def near_fingerprints(r, n):
    out = set()
    for _ in range(n // 6):
        x = r.getrandbits(64)
        for _ in range(6):
            out.add(x)
            for b in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << b
    return sorted(out)


def test_links_find_every_pair(spark):
    fps = near_fingerprints(random.Random(4), 300)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = components(signed, [(a, b) for i, a in enumerate(signed) for b in signed[:i] if (a ^ b).bit_count() <= 4 or ((a ^ b) % 2**64).bit_count() <= 4])
    groups = lambda c: sorted(sorted(v) for v in _by_root(c).values())
    for direct in (False, True):
        found = [(r["a"], r["b"]) for r in S.links(df, 4, direct).collect()]
        assert groups(components(signed, found)) == groups(want)
        if direct:
            assert all(((a ^ b) % 2**64).bit_count() <= 4 for a, b in found)


def _by_root(c):
    out = defaultdict(list)
    for n, r in c.items():
        out[r].append(n)
    return out


def test_crowded_prefixes_are_split(monkeypatch):
    r = random.Random(9)
    base = r.getrandbits(64)
    fps = np.unique(np.array([base ^ (1 << r.randrange(20)) ^ (1 << r.randrange(20)) for _ in range(120)], np.uint64))
    left = np.full(len(fps), 2)
    whole = S._meet(fps, left, 64, S._forest)
    monkeypatch.setattr(S, "SORTED", 5000)
    split = S._meet(fps, left, 64, S._forest)
    roots = lambda x: components(fps.tolist(), list(zip(x[0].tolist(), x[1].tolist(), strict=True)))
    assert len(set(roots(whole).values())) == len(set(roots(split).values())) == 1


def test_stage_keeps_one_of_each_group(spark):
    r = random.Random(7)
    base = [" ".join(f"w{r.randrange(4000)}" for _ in range(200)) for _ in range(12)]
    rows, n = [], 0
    for b in base:
        rows.append((n, b))
        w = b.split()
        w[50] = "edited"
        rows += [(n + 1, " ".join(w)), (n + 2, b)]
        n += 3
    rows += [(n, None), (n + 1, ""), (n + 2, "short text"), (n + 2, "short text"), (None, "free")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, key int")
    left = S.deduplicated(df)
    assert left.columns == df.columns
    assert sorted((x["doc_id"] for x in left.collect()), key=str) == sorted([*range(0, 36, 3), 36, 38, None], key=str)
    assert S.deduplicated(df.limit(0)).count() == 0


def kept(spark, texts):
    left = S.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return sorted(x["doc_id"] for x in left.collect())


def brute_kept(texts):
    sets = [set(S.shingle_hashes(t, 5)) for t in texts]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    linked = []
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                common[j] += j < i
        linked += [(i, j) for j, c in common.items() if c and 10 * c >= 8 * (len(s) + len(sets[j]) - c)]
    return sorted(set(components(range(len(texts)), linked).values()))


def test_stage_finds_appended_and_truncated_copies_just_above_the_bound(spark):
    r = random.Random(3)
    words = lambda n: [f"w{int(r.paretovariate(0.7)) % 5000}" for _ in range(n)]
    texts = []
    for _ in range(40):
        b = words(300)
        texts += [" ".join(b), " ".join(b + words(72)), " ".join(words(70) + b), " ".join(b[:245]), " ".join(b + words(80))]
    want = brute_kept(texts)
    assert kept(spark, texts) == want and len(want) < 100


def test_stage_connects_a_family_by_its_base(spark):
    r = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for n in range(400):
        w = list(base)
        for i in r.sample(range(200), 4):
            w[i] = f"e{n}x{i}"
        texts.append(" ".join(w))
    texts.insert(200, " ".join(base))
    assert kept(spark, texts) == brute_kept(texts)


def test_ids_beyond_doubles(spark):
    rows = spark.createDataFrame([(2**53 + 1, "a b c d e"), (None, "a b c d e"), (2**53 + 3, "x y z")], "doc_id long, text string")
    got = S.near_duplicates(rows).collect()
    assert sorted(((r["doc_id"] or 0), r["component_id"]) for r in got) == [(0, 2**53 + 1), (2**53 + 1, 2**53 + 1), (2**53 + 3, 2**53 + 3)]


def test_stage_sends_no_sets_of_texts_that_cannot_be_similar(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join([passage, *(f"t{n}x{i}" for i in range(25 * 2**n))]) for n in range(7)]
    tested, real = [], S._similar
    monkeypatch.setattr(S, "_similar", lambda docs, pairs, *a: tested.extend(pairs.collect()) or real(docs, pairs, *a))
    assert kept(spark, texts) == list(range(7)) and not tested


def test_stage_pairs_no_crowd_whose_texts_are_all_too_far_apart(spark, monkeypatch):
    r, base, texts = random.Random(9), [f"b{i}" for i in range(100)], []
    for n in range(60):  # all share most of a base that isn't there
        w = list(base)
        for i in r.sample(range(0, 100, 5), 6):
            w[i] = f"e{n}x{i}"
        texts.append(" ".join(w))
    tested, real = [], S._similar
    monkeypatch.setattr(S, "_similar", lambda docs, pairs, *a: tested.append(pairs.count()) or real(docs, pairs, *a))
    assert kept(spark, texts) == brute_kept(texts) == list(range(60))
    assert sum(tested[1:]) < 60


def test_stage_pairs_no_texts_that_share_rare_passages_but_too_little(spark, monkeypatch):
    part = lambda name, n: [f"{name}x{i}" for i in range(n)]
    texts = [" ".join([*part(f"r{row}", 120), *part(f"c{column}", 80)]) for row in range(20) for column in range(6)]
    r = random.Random(1)
    r.shuffle(texts)
    tested, real = [], S._similar
    monkeypatch.setattr(S, "_similar", lambda docs, pairs, *a: tested.append(pairs.count()) or real(docs, pairs, *a))
    assert kept(spark, texts) == brute_kept(texts) == list(range(120))
    assert tested[-1] == 0


def test_sketches_differ_no_more_than_texts_do(spark):
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(30 * 4**n)}" for _ in range(5 * 4**n)) for n in range(6)] * 2
    texts += [t + " and one more" for t in texts] + ["", None]
    sets = [set(S.shingle_hashes(t or "", 5)) for t in texts]
    rows = {x["doc"]: x[1:] for x in S._sketches(spark.createDataFrame(list(enumerate(texts)), "doc long, text string"), 5).collect()}
    assert len(rows) == len(texts)
    differ = lambda i, j: sum(((a ^ b) % 2**64).bit_count() for a, b in zip(rows[i], rows[j], strict=True))
    assert all(differ(i, j) <= len(sets[i] ^ sets[j]) for i in rows for j in rows)
    assert differ(0, 5) > 0 == differ(5, 11)

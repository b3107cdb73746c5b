import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from quillgate.llm import attention as A
from quillgate.llm import lm_score

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_each_target_is_scored_once():
    sizes = np.array([1, A.STEP, A.STEP + 1, 40, 3, 0])
    raw, at = A.windows(np.arange(sizes.sum()), sizes)
    assert sorted(at[at >= 0]) == list(range(sizes.sum()))
    assert (raw[:, A.WIDTH + 1 - A.STEP :][at >= 0] == at[at >= 0]).all()  # ids are their own numbers here
    first = raw[at[:, 0] == 0][0]
    assert (first == [*[A.OUTSIDE] * (A.WIDTH - A.STEP), A.BEFORE, 0, *[A.OUTSIDE] * (A.STEP - 1)]).all()


def small(seed, n=3000):
    r = np.random.default_rng(seed)
    counts = np.sort(r.integers(0, 50, n))[::-1].astype(float)
    return r, A.Vocabulary.of(counts, r.integers(0, n, 4000)), counts


def test_gradients():
    r, v, counts = small(0)
    m = A.Model(1, v, counts)
    m.p = {k: x.astype(np.float64) for k, x in m.p.items()}
    raw, _ = A.windows(r.integers(0, 3000, 60), np.array([40, 3, 17]))
    target = raw[:, A.WIDTH + 1 - A.STEP :].ravel()
    mask, target = target >= 0, np.maximum(target, 0)
    args = v.inputs(raw[:, :-1]), v.head[target], v.member[target], mask
    g, _ = m.gradients(*args)
    for k, x in m.p.items():
        flat, i = x.reshape(-1), int(np.abs(g[k]).argmax())
        keep, h = flat[i], 1e-4
        flat[i] = keep + h
        up = m.gradients(*args)[1]
        flat[i] = keep - h
        down = m.gradients(*args)[1]
        flat[i] = keep
        assert (up - down) / (2 * h) == pytest.approx(g[k].reshape(-1)[i], rel=2e-2, abs=1e-6), k


def brute_score(m, ids, v):
    """One token at a time, with exactly the inputs of its window."""
    total, p = 0.0, m.p
    log_p = lambda logits, i: logits[i] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    for t in range(len(ids)):
        begin = t // A.STEP * A.STEP + A.STEP - A.WIDTH
        places = [j for j in range(max(begin, 0), t + 1)]
        x = np.array([p["E"][v.row[ids[j - 1]] if j else A.START] + p["P"][j - begin] for j in places], float)
        s = (x @ p["K"]) @ (x[-1] @ p["Q"]) / math.sqrt(A.DIM)
        a = np.exp(s - s.max())
        y = x[-1] + (a / a.sum()) @ (x @ p["V"]) @ p["O"]
        z = np.append(y + np.maximum(y @ p["A"] + p["a"], 0) @ p["B"], 1)
        own = log_p(z @ p["U"], v.head[ids[t]])
        if v.member[ids[t]] >= 0:
            own += log_p(z @ p["T"][v.head[ids[t]] - A.HEAD], v.member[ids[t]])
        total += own / math.log(10) + v.share[ids[t]]
    return total


def test_scores_agree_with_one_token_at_a_time():
    r, v, counts = small(2)
    ids = r.integers(0, 3000, 101)
    sums = np.bincount(v.head * A.MEMBERS + np.maximum(v.member, 0), 10.0**v.share)
    assert np.allclose(sums[sums > 0], 1)  # shares of a place are a whole
    assert (np.bincount(v.head, minlength=A.HEAD + A.GROUPS) > 0).all()
    m = A.Model(3, v, counts)
    got = m.score(ids, np.array([1, 60, 40]), v)
    want = [brute_score(m, x, v) for x in (ids[:1], ids[1:61], ids[61:])]
    assert np.allclose(got, want, rtol=1e-4)
    again = A.Model().with_flat(m.flat())
    assert (again.score(ids, np.array([1, 60, 40]), v) == got).all()


def test_baseline_and_cases(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm_score.score(docs, PATH).collect()), key=lambda x: (x[0] is None, x[0], x[4]))
    import zlib

    toks = [(i, [*(t or "").lower().split(), None]) for i, t in rows]
    train = Counter(w for i, ws in toks if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(train.values()), len(train)
    want = sorted(((i, len(ws), sum(train[w] > 0 for w in ws), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in toks), key=lambda x: (x[0] is None, x[0], x[4]))
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert lm_score.score(no_docs, PATH).count() == 0


def test_training_helps():
    ids = np.tile(np.arange(100, 140), 60)
    sizes = np.full(60, 40)
    v = A.Vocabulary.of(np.bincount(ids, minlength=200).astype(float), ids)
    m = A.Model(0, v, np.bincount(ids, minlength=200).astype(float))
    before = m.score(ids[:40], sizes[:1], v)[0]
    m.train(A.windows(ids, sizes)[0], v, steps=150)
    assert m.score(ids[:40], sizes[:1], v)[0] > before + 5


@pytest.fixture(scope="module")
def registered(spark):
    import pyarrow.parquet as pq

    from quillgate.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = pq.read_table(f"{sf}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    return rows, QUERIES["op8_lm_scoring"](spark, sf).toPandas().set_index("doc_id")


def test_registered_query_baseline(registered):
    import zlib

    rows, got = registered
    toks = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [None] for r in rows}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    train = Counter(w for i, ws in toks.items() if not out[i] for w in ws)
    n, v = sum(train.values()), len(train)
    assert len(got) == len(rows) and (got.train_tokens == n).all()
    for i, ws in toks.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (out[i], len(ws), sum(train[w] > 0 for w in ws))
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws))


def test_held_out_score_beats_the_unigram_baseline(registered):
    _, got = registered
    held = got[got.held_out]
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() + 0.02


def test_windows_are_drawn_alike_and_rounds_learn_in_groups(spark, monkeypatch):
    """Many groups, whatever the corpus: all windows of the share take part, texts of any length among them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    r = np.random.default_rng(0)
    texts = [r.integers(0, 300, k).astype("<u2") for k in (*[20] * 300, 60_000)]
    rows = spark.createDataFrame([(i, bytearray(t.tobytes())) for i, t in enumerate(texts)], "row long, ids binary")
    drawn = lm_score.draw_windows(rows, 2, 299, 0.25).toPandas()
    long = -(-60_001 // A.STEP)
    assert abs(len(drawn) - 0.25 * (300 + long)) < 5 * math.sqrt(300 + long)
    monkeypatch.setattr(lm_score, "WARM_STEPS", 20)
    monkeypatch.setattr(lm_score, "GROUP_TOKENS", 4000)
    model, v, end = lm_score.train(rows, len(texts), PATH)
    assert np.isfinite(model.flat()).all() and v.share.max() <= 0 and end == 49407
    assert pc.sum(pa.array(v.member >= 0)).as_py() > 0


def test_the_rounds_learn_from_every_window(spark, monkeypatch):
    shares, real = [], lm_score.draw_windows
    monkeypatch.setattr(lm_score, "draw_windows", lambda rows, width, end, share: shares.append(share) or real(rows, width, end, share))
    monkeypatch.setattr(lm_score, "WARM_TOKENS", 20)
    monkeypatch.setattr(lm_score, "WARM_STEPS", 2)
    docs = spark.createDataFrame([(i, f"the cat {i} sat on mat {i % 7} " * 10) for i in range(60)], "doc_id long, text string")
    assert lm_score.score(docs, PATH).count() == 60
    assert max(shares) >= 1


def test_a_copy_learns_from_each_of_its_windows(monkeypatch):
    """As many batches as hold all windows show all of them, not a draw with repetitions."""
    ids = np.random.default_rng(0).integers(0, 200, 24 * 500)
    raw = A.windows(ids, np.full(500, 24))[0]
    counts = np.bincount(ids, minlength=200).astype(float)
    seen, real = [], A.Vocabulary.inputs
    monkeypatch.setattr(A.Vocabulary, "inputs", lambda self, x: seen.append(x.copy()) or real(self, x))
    v = A.Vocabulary.of(counts, ids)
    A.Model(0, v, counts).train(raw, v, -(-len(raw) // 96), 96)
    assert {x.tobytes() for x in np.concatenate(seen)} == {np.ascontiguousarray(x).tobytes() for x in raw[:, :-1]}
    few = raw[:5]  # less than a batch
    seen.clear()
    A.Model(0, v, counts).train(few, v, 1, 96)
    assert len({x.tobytes() for x in np.concatenate(seen)}) == 5


def test_learning_multiplies_as_little_as_the_products_of_matrices_allow():
    """Keys and values of each input aren't made: queries meet inputs as they are. Counted per window, with its ends of groups."""

    class Counted(np.ndarray):
        done = 0

        def __array_ufunc__(self, ufunc, method, *args, out=None, **more):
            plain = [np.asarray(x) if isinstance(x, Counted) else x for x in args]
            if ufunc is np.matmul:
                a, b = plain
                Counted.done += a.size * (b.shape[-1] if b.ndim > 1 else 1)
            if out:
                getattr(ufunc, method)(*plain, out=tuple(x.view(np.ndarray) for x in out), **more)
                return out[0]
            got = getattr(ufunc, method)(*plain, **more)
            return got.view(Counted) if isinstance(got, np.ndarray) else got

    r, v, counts = small(4)
    m = A.Model(0, v, counts)
    raw = A.windows(r.integers(0, 3000, A.STEP * 200), np.full(200, A.STEP))[0]
    target = raw[:, A.WIDTH + 1 - A.STEP :].ravel()
    args = v.inputs(raw[:, :-1]), v.head[target], v.member[target], target >= 0
    want, _ = m.gradients(*args)
    m.p = {k: x.view(Counted) for k, x in m.p.items()}
    got, _ = m.gradients(*args)
    assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)
    square, places = A.DIM * A.DIM, A.STEP * A.DIM
    ways = 3  # a product forward, and what each factor gets of its gradient
    needed = ways * A.STEP * (2 * square + A.DIM * (2 * A.HIDDEN + A.HEAD + A.GROUPS + A.MEMBERS)) + ways * 2 * places * A.WIDTH
    assert Counted.done / len(raw) < 1.1 * needed

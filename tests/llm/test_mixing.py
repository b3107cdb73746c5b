import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgate.llm import mixing as M


def brute(cells, alpha, rounds=200):
    """cells: {(source, lang, topic): tokens} to factors."""
    keys, t = list(cells), np.array(list(cells.values()), float)
    f = np.ones(len(t))
    for _ in range(rounds):
        for d in range(3):
            values = {k[d] for k in keys}
            own = {v: np.array([k[d] == v for k in keys]) for v in values}
            share = {v: t[m].sum() ** alpha for v, m in own.items() if t[m].sum()}
            total = sum(share.values())
            for v, m in own.items():
                if (t * f)[m].sum():
                    f[m] *= share.get(v, 0) / total * t.sum() / (t * f)[m].sum()
    return dict(zip(keys, f, strict=True))


@pytest.fixture
def many(spark):
    r = np.random.default_rng(0)
    kinds = ["plain words only", "SEE THE LICENCE", "1234 5678 90", "x## y$$ |"]
    data = [(i, " ".join([kinds[r.choice(4, p=[0.7, 0.1, 0.1, 0.1])]] * int(r.integers(1, 9))), f"s{r.choice(4, p=[0.4, 0.3, 0.2, 0.1])}", r.choice(["en", "de", None]), 3.0) for i in range(3000)]
    return spark.createDataFrame([(int(i), t, s, None if x is None else str(x), w) for i, t, s, x, w in data], "doc_id long, text string, source string, lang string, weight double")


def cells(docs, **how):
    return M.cells_of(M.with_cells(docs, ["doc_id"], "m"), "m")


def test_topics_follow_the_figures_of_texts(many):
    """Equal texts have one topic, several topics are in use, and tokens are words."""
    rows = M.with_cells(many, ["text"], "m").selectExpr("text", "m.topic", "m.tokens").distinct().collect()
    assert len({r["text"] for r in rows}) == len(rows) and 2 <= len({r["topic"] for r in rows}) <= M.TOPICS
    assert all(r["tokens"] == len(r["text"].split()) for r in rows)


def test_kmeans_against_numpy(spark):
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(c, 0.05, (200, M.FIGURES)) for c in (0.1, 0.5, 0.9)])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "i long, figures array<double>")
    got = {r["i"]: r["t"] for r in df.select("i", M.fitted(df.select("figures"), 3).alias("t")).collect()}
    z = np.clip((x - x.mean(0)) / x.std(0), -4, 4)
    centre = np.array([z[200 * j : 200 * j + 200].mean(0) for j in range(3)])
    for _ in range(20):
        near = ((z[:, None] - centre[None]) ** 2).sum(2).argmin(1)
        centre = np.array([z[near == j].mean(0) for j in range(3)])
    assert all(got[i] == f"topic{near[i]}" for i in range(len(x)))


def test_factors_agree_with_numpy_and_margins_hold(many):
    own = cells(many).cache()
    raked = M.rake(own).collect()
    want = brute({tuple(r[d] for d in M.DIMS): r["tokens"] for r in own.collect()}, M.ALPHA)
    for r in raked:
        assert r["factor"] == pytest.approx(want[tuple(r[d] for d in M.DIMS)], rel=1e-4)


def test_given_targets_and_expected_tokens(spark, many):
    targets = {"lang": spark.createDataFrame([("en", 3.0), ("de", 1.0), ("nowhere", 9.0)], "lang string, share double")}
    raked = M.rake(cells(many), targets).cache()
    by = {r["lang"]: r["w"] for r in raked.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("factor")).alias("w")).collect()}
    assert by["en"] / by["de"] == pytest.approx(3, rel=1e-4) and by[M.NONE] == 0
    p = M.probabilities(raked, 0.1).cache()
    got = p.agg(F.sum(F.col("tokens") * F.col("prob")) / F.sum("tokens")).first()[0]
    assert got == pytest.approx(0.1, rel=1e-3) and p.agg(F.max("prob")).first()[0] <= 1


def test_draws_are_stable_and_near_their_probability(many):
    m, name = M.mix(many, ["doc_id"])
    m = m.select("doc_id", f"{name}.*").cache()
    a = m.where("sampled").agg(F.sum("tokens")).first()[0] / m.agg(F.sum("tokens")).first()[0]
    want = m.agg(F.sum(F.col("tokens") * F.col("prob")) / F.sum("tokens")).first()[0]
    assert a == pytest.approx(want, abs=0.05) and 0.2 < want <= M.KEEP + 1e-3 and m.agg(F.max("off")).first()[0] < M.TOLERANCE
    one, two = (sorted(r["doc_id"] for r in M.sampled(many.repartition(n)).select("doc_id").collect()) for n in (1, 7))
    assert one == two and M.sampled(many).columns == many.columns


def test_cases(docs, no_docs):
    assert M.mix(docs, ["doc_id"])[0].count() == docs.count() and M.mix(no_docs, ["doc_id"])[0].count() == 0
    assert M.mix(docs.where("text is null"), ["doc_id"])[0].count() == 1
    assert M.mix(docs.drop("source", "lang"), ["doc_id"])[0].count() == docs.count()


def test_columns_of_any_name_are_kept(docs, rows):
    odd = docs.withColumns({"mixed": F.lit(1), "kept": F.lit(2), "drawn": F.lit(3), "topic": F.lit("t"), "a.b": F.lit(4), "tokens": F.lit(5), "figures": F.lit(6)})
    got = M.sampled(odd, keep=1.0, alpha=1.0)
    assert got.columns == odd.columns and rows(got) == rows(odd)


def test_targets_that_cannot_be_met_are_told(spark, many):
    """Source s0 has English alone, yet all of the target is on s0 and German."""
    docs = many.where("not (source = 's0' and coalesce(lang, '') <> 'en')")
    targets = {"source": spark.createDataFrame([("s0", 9.0), ("s1", 1.0)], "source string, share double"), "lang": spark.createDataFrame([("en", 1.0), ("de", 9.0)], "lang string, share double")}
    assert M.rake(cells(docs), targets).agg(F.max("off")).first()[0] > 0.1


def test_many_cells_rake_by_joins(many, monkeypatch):
    few = M.rake(cells(many)).collect()
    monkeypatch.setattr(M, "BROADCAST_CELLS", 3)
    monkeypatch.setattr(M, "ROUNDS", 3)
    some = {tuple(r[d] for d in M.DIMS): r["factor"] for r in M.rake(cells(many)).collect()}
    assert all(some[tuple(r[d] for d in M.DIMS)] == pytest.approx(r["factor"], rel=0.05) for r in few)


def worst(p):
    return max(abs(r["share"] - r["target"]) for r in M.margins(p).collect())


def test_margins_hold_for_what_is_drawn_though_cells_are_full(spark, many):
    raked = M.rake(cells(many)).cache()
    assert raked.agg(F.max("factor")).first()[0] * M.KEEP > 1
    p = M.probabilities(raked).cache()
    assert worst(p) < 1e-3 and p.agg(F.max("prob")).first()[0] <= 1
    assert 0.2 < p.agg(F.sum(F.col("tokens") * F.col("prob")) / F.sum("tokens")).first()[0] <= M.KEEP * 1.001


def test_size_shrinks_where_targets_need_more_than_there_is(spark, many):
    targets = {"source": spark.createDataFrame([("s3", 8.0), ("s0", 1.0), ("s1", 1.0)], "source string, share double")}
    p = M.probabilities(M.rake(cells(many), targets)).cache()
    assert worst(p) < 1e-3 and 0 < p.agg(F.sum(F.col("tokens") * F.col("prob")) / F.sum("tokens")).first()[0] < 0.13

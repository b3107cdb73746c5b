import math
import random

import numpy as np

from quillgate.llm import langid

SYLLABLES = {"aa": ["ka", "to", "mi", "re", "the"], "bb": ["sch", "ung", "ver", "ein"], "cc": ["ção", "que", "los", "ñe"]}


def sentence(r, lang, n=40):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


def corpus(spark, n=300):
    r = random.Random(1)
    data = [(i, sentence(r, lang := sorted(SYLLABLES)[i % 3]), lang) for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string"), data


def test_held_out_accuracy_and_rejection(spark):
    df, data = corpus(spark)
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert all(got[i]["lang_pred"] == lang and not got[i]["rejected"] and 0 <= got[i]["score"] <= 1 for i, _, lang in data)
    j = model.judge(["", "123 !!", "Это другой язык, совсем другие буквы и слова", "KA-TO: mi, re?"])
    assert list(j.lang_pred[:2]) == ["und", "und"] and list(j.rejected) == [True, True, True, False] and j.lang_pred[3] == "aa"


def test_nothing_to_learn_from(spark, docs, no_docs):
    model = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0
    own = langid.fit(docs)
    assert langid.predict(docs, own).count() == docs.count() and langid.kept(docs, own).columns == docs.columns


def brute(train: dict[str, list[str]], text: str) -> dict[str, float]:
    """Interpolated Kneser-Ney of order 4 straight from its definition, natural log of the text."""

    def norm(t):
        return "   " + "".join(c if c.isalpha() else " " for c in t.lower())

    def squeeze(t):
        out = t[:3]
        for i, c in enumerate(t[3:]):
            if c != " " or (i > 0 and out[-1] != " "):
                out += c
        return out

    counts = {}
    for lang, texts in train.items():
        g = {}
        for t in texts:
            s = squeeze(norm(t))
            for i in range(3, len(s)):
                g[s[i - 3 : i + 1]] = g.get(s[i - 3 : i + 1], 0) + 1
        levels = [g]
        for _ in range(3):
            low = {}
            for x in levels[0]:
                low[x[1:]] = low.get(x[1:], 0) + 1
            levels.insert(0, low)
        counts[lang] = levels
    size = len({c for lv in counts.values() for x in lv[3] for c in x}) + 1
    out = {}
    for lang, levels in counts.items():
        def p(gram, k, levels=levels):
            if k == 0:
                return 1 / size
            own, n1, n2 = levels[k - 1], sum(v == 1 for v in levels[k - 1].values()), sum(v == 2 for v in levels[k - 1].values())
            d = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
            same = {x: v for x, v in own.items() if x[:-1] == gram[:-1]}
            total = sum(same.values())
            low = p(gram[1:], k - 1)
            return low if not total else max(own.get(gram, 0) - d, 0) / total + d * len(same) / total * low

        s = squeeze(norm(text))
        out[lang] = sum(math.log(p(s[i - 3 : i + 1], 4)) for i in range(3, len(s)))
    return out


def test_probabilities_agree_with_the_definition():
    r = random.Random(3)
    train = {k: [sentence(r, k, 12) for _ in range(3)] for k in SYLLABLES}
    counts = {}
    for k, texts in train.items():
        c, begin = langid.codes_of(texts)
        own = np.ones(len(c), bool)
        own[(begin[:, None] + np.arange(3)).ravel()] = False
        grams = c[np.flatnonzero(own)[:, None] + np.arange(-3, 1)]
        counts[k] = np.unique(grams, axis=0, return_counts=True)
    model = langid.kneser_ney(counts)
    for text in (sentence(r, "aa", 5), sentence(r, "bb", 4) + " 9! x", "ÇÃO zzz", "q"):
        total, n = model.sums([text])
        want = brute(train, text)
        assert np.allclose(total[0], [want[k] for k in model.langs], rtol=1e-4), text
        assert n[0] > 0


def test_long_texts_are_scored_with_the_context_before_each_piece(monkeypatch):
    r = random.Random(4)
    train = {k: [sentence(r, k, 60)] for k in SYLLABLES}
    counts = {}
    for k, texts in train.items():
        c, _ = langid.codes_of(texts)
        counts[k] = np.unique(c[np.arange(3, len(c))[:, None] + np.arange(-3, 1)], axis=0, return_counts=True)
    model = langid.kneser_ney(counts)
    texts = [sentence(r, "aa", 80), "x" * 150, sentence(r, "cc", 3), "", "!" * 99 + " ka", sentence(r, "bb", 50).replace(" ", " -- \n")]
    total, n = model.sums(texts)
    monkeypatch.setattr(langid, "CHARS", 31)
    again, m = model.sums(texts)
    assert np.allclose(total, again) and (n == m).all()


def test_ids_beyond_doubles_and_draws_of_any_share(spark):
    df, data = corpus(spark)
    big = spark.createDataFrame([(2**53 + 1, data[0][1], None), (None, data[1][1], "bb"), (None, data[4][1], "bb")], "doc_id long, text string, lang string")
    got = langid.predict(df.unionByName(big), langid.fit(df.unionByName(big))).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] == 2**53 + 1] == ["aa"] and sum(r["doc_id"] is None for r in got) == 2
    from quillgate.llm.common import drawn

    n = 200_000
    for share in (1e-4, 1e-2):
        k = spark.range(n).where(drawn(__import__("pyspark").sql.functions.lit(share), "id")).count()
        assert abs(k - n * share) < 6 * math.sqrt(n * share)


def test_too_many_languages_are_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(langid, "MOST_LANGS", 2)
    with pytest.raises(ValueError, match="values of lang"):
        langid.fit(corpus(spark, 30)[0])


def test_registered_query_held_out_accuracy(spark):
    import zlib

    import pyarrow.parquet as pq

    from quillgate.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet").select(["doc_id", "lang"]).to_pylist()}
    got = QUERIES["op2_language_id"](spark, sf).collect()
    assert len(got) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98

import hashlib
import math
import random
import re
import string

import pytest

from quillgate.llm import secrets as S


def base(t):
    """The fixed patterns, read from their words."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m.group(2)) >= 8:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
    return sorted(out, key=lambda x: (x[0], S.KINDS.index(x[2])))


PIECES = ["token=", "secret: ", "Api_Key = '", "abcdefgh12", "token=token:abcdefghij", "AKIA" + "A" * 12, "AKIA", "0" * 31, "deadbeef" * 4, "password", " ", "é", "ſecret=abcdefghij", "\n", '"']


def test_patterns_agree():
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choices(PIECES, k=12))
        assert S.base_spans(t) == base(t), t


def plain_battery(core, alphabet):
    """The three tests, one character at a time."""
    n, size = len(core), len(alphabet)
    v = [alphabet.index(c) for c in core]
    bins = max(2, min(16, size, n // 5))
    chi = 0.0
    for b in range(bins):
        want = n * sum(x * bins // size == b for x in range(size)) / size
        chi += (sum(x * bins // size == b for x in v) - want) ** 2 / want
    k = bins - 1
    p = [0.5 * math.erfc(((chi / k) ** (1 / 3) - 1 + 2 / (9 * k)) / math.sqrt(2 / (9 * k)) / math.sqrt(2))]
    up = [x >= size / 2 for x in v]
    n1, n2 = sum(up), n - sum(up)
    if n1 and n2:
        mean = 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p.append(math.erfc(abs(1 + sum(a != b for a, b in zip(up, up[1:], strict=False)) - mean) / math.sqrt(2 * var)) if var > 0 else 1)
    else:
        p.append(2.0 ** (1 - n))
    m = sum(v) / n
    square = sum((x - m) ** 2 for x in v)
    r = sum((a - m) * (b - m) for a, b in zip(v, v[1:], strict=False)) / square if square else 1.0
    p.append(math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2)))
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return math.exp(-half) * (1 + half + half * half / 2)


def test_battery_agrees_with_its_definition():
    r = random.Random(5)
    for name, alphabet in S.ALPHABETS.items():
        for n in (20, 33, 90):
            for token in ("".join(r.choices(alphabet, k=n)), "".join(r.choices(alphabet[: len(alphabet) // 2], k=n)), alphabet[0] * n):
                assert S.uniform_p(token, name) == pytest.approx(plain_battery(token, alphabet), rel=1e-6, abs=1e-290)


def test_encodings():
    assert S.core_of("550e8400-e29b-41d4-a716-446655440000") == ("550e8400e29b41d4a716446655440000", "hex")
    assert S.core_of("ABCDEF0123456789ABCDEF==") == ("abcdef0123456789abcdef", "hex")
    assert [S.core_of(t)[1] for t in ("12345678901234567890", "abcxyzabcxyzabcxyzabc", "ABCXYZABCXYZABCXYZABC", "ABCXYZ234567ABCXYZ22", "aZ9aZ9aZ9aZ9aZ9aZ9aZ", "a+Z/9a-Z_9a+Z/9a+Z/9")] == ["digits", "lower", "upper", "base32", "base62", "base64"]


SYLLABLES = ["the", "an", "er", "ing", "tion", "re", "on", "st", "ed", "ly", "ha", "ou"]


def ordinary(r, n):
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(n))


def test_battery_finds_random_tokens_and_leaves_text(spark):
    r = random.Random(2)
    mixed, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    keys = ["".join(r.choices(mixed, k=40)) for _ in range(20)] + ["-".join("".join(r.choices(hexes, k=k)) for k in (8, 4, 4, 4, 12)) for _ in range(20)]
    keys += ["".join(r.choices(string.ascii_lowercase, k=100)) for _ in range(20)] + ["".join(r.choices(string.digits, k=30)) for _ in range(20)]
    rows = [(i, "the key is " + k + " as said") for i, k in enumerate(keys)]
    words = ["internationalization", "counterrevolutionaries", "https_example_com_path_page", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "getElementByIdentifierName", "--------------------------", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    rows += [(100 + i, f"see {w} and more") for i, w in enumerate(words * 6)] + [(900, None), (901, ""), (None, "x"), (902, "+" * 300 + " " + "=" * 30)]
    rows += [(2**53 + 1, ordinary(r, 400))] + [(1000 + i, ordinary(r, 400)) for i in range(1500)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, spans string, base int")
    got = {r["doc_id"]: r for r in S.find_secrets(df).collect()}
    assert 2**53 + 1 in got and len(got) == len(rows)
    for kind in range(4):
        assert sum(any(x["kind"] == "random" for x in got[i]["spans"]) for i in range(20 * kind, 20 * kind + 20)) >= 18, kind
    assert not any(got[i]["spans"] for i in got if i is None or i >= 100)
    assert S.find_secrets(df.limit(0)).count() == 0


def test_spans_agree_with_brute_force(spark):
    """All tokens' p-values in one list for each stratum, the step-up rule by its definition."""
    r = random.Random(7)
    alphabet = string.ascii_letters + string.digits
    texts = [ordinary(r, 300) + (" " + "".join(r.choices(alphabet, k=r.choice([22, 40, 70]))) if i % 9 == 0 else "") + (" internationalisationally" if i % 4 == 0 else "") for i in range(700)]
    got = {x["doc_id"]: [(y["start"], y["end"]) for y in x["spans"] if y["kind"] == "random"] for x in S.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    null = [c for t in texts for c in S.null_cells(t)]
    found = [(i, a, b, (s, e, k)) for i, t in enumerate(texts) for a, b, s, e, k in S.candidates(t, base(t))]
    want = {i: [] for i in range(len(texts))}
    for s in range(S.STRATA):
        own, n = [x for x in found if x[3][0] == s], [c for c in null if c[0] == s]
        p = [1.0 if c[2] == S.P_BINS - 1 else (1 + sum(x[1] == c[1] and x[2] <= c[2] for x in n)) / (1 + len(n)) for *_, c in own]
        ranks = [k for k in range(1, len(p) + 1) if sorted(p)[k - 1] <= S.Q * k / len(p)]
        limit = sorted(p)[max(ranks) - 1] if ranks else -1
        for (i, a, b, _), x in zip(own, p, strict=True):
            if x <= limit:
                want[i].append((a, b))
    assert got == want and sum(map(len, want.values())) > 50


def test_random_tokens_look_uniform_and_text_does_not():
    r = random.Random(3)
    tokens = ["".join(r.choices("0123456789abcdef", k=64)) for _ in range(200)]
    passed = sum(S.uniform_p(t, "hex") >= 0.01 for t in tokens)
    assert passed >= 190
    assert S.uniform_p("a" * 40, "base62") < 1e-6 and S.uniform_p("abcdefghijklmnopqrstuvwxyz" * 2, "lower") < 1e-3


def test_registered_query(spark):
    """Counts, digest and spans read from the patterns' words."""
    import pyarrow.parquet as pq

    from quillgate.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{sf}/documents.parquet").select(["doc_id", "text"]).to_pylist()}
    got = QUERIES["op6_secret_scans"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        own = base(texts[r["doc_id"]])
        told = [f"{k}:{a}:{b}" for a, b, k in own]
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[2] == k for x in own) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        spans = [x for x in r["spans"].split(",") if x]
        assert [x for x in spans if not x.startswith("random")] == told
        at = [(int(x.split(":")[1]), S.KINDS.index(x.split(":")[0])) for x in spans]
        assert at == sorted(at)

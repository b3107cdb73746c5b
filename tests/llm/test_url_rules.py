import random

from quillgate.llm import url_rules as U


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = [(len(h + p), len(U_key(h)), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best and best[3], best[4] if best else "allow"


def U_key(h):  # noqa: N802
    return ".".join(reversed(h.split("."))) + "."


def test_agrees_with_brute_force(spark):
    r = random.Random(2)
    hosts = ["com", "example.com", "a.example.com", "example-x.com", "xample.com", "b.net", "net", "a.b.net", "n\0et", ""]
    paths = ["", "/", "/en", "/en/", "/en/7", "/en/71?x=/de/", "/de/#/en/", "//"]
    rules = [(h, p, r.choice(["allow", "block"])) for h in hosts[:8] for p in r.sample(paths[:5], 2)]
    pages = [(i, f"{r.choice(['http', 'HTTPS'])}://{r.choice(hosts).upper() if i % 3 else r.choice(hosts)}{r.choice(paths)}") for i in range(400)]
    pages += [(900, None), (901, ""), (902, "no scheme.com/en/"), (903, "http://com"), (903, "http://com"), (904, "x://y://com/en/")]
    df = spark.createDataFrame([(i, u, "html", "k") for i, u in pages], "page_id long, url string, html string, key string")
    got = U.classify(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(((i, *brute(u, rules)) for i, u in pages), key=str)


def test_empty_tables(spark):
    pages, rules = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(x) for x in U.classify(pages, rules).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert U.classify(pages.limit(0), rules).count() == 0
    null_id = spark.createDataFrame([(None, "http://a.b/c")], "page_id long, url string")
    assert U.classify(null_id, rules).count() == 1


def test_ids_beyond_doubles(spark):
    pages = spark.createDataFrame([(2**53 + 1, "http://a.b/c"), (None, "http://a.b/c"), (2**53 + 3, "http://b/")], "page_id long, url string")
    rules = spark.createDataFrame([("b", "/c", "block")], "host string, path string, verdict string")
    assert sorted(((r["page_id"] or 0), r["verdict"]) for r in U.classify(pages, rules).collect()) == [(0, "block"), (2**53 + 1, "block"), (2**53 + 3, "allow")]

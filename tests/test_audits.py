from pyspark.sql import functions as F

from quillgate.operators import audits as A
from quillgate.operators import contracts as C
from quillgate.plans import release as R
from quillgate.sources import documents as D
from quillgate.sources import reports


def test_sets_and_keys(spark, rows):
    have, want = A.values(spark, ["a", "b"]), A.values(spark, ["b", "c"])
    assert rows(A.set_difference(have, want)) == [("a", "unexpected"), ("c", "missing")]
    assert rows(A.without_match(have, want), "what") == [("a",)]
    caps = spark.createDataFrame([("c1", ["g1", "g2"]), ("c2", [])], "id string, gates array<string>")
    assert rows(A.unresolved(caps, "gates", spark.createDataFrame([("g1",)], "g string"), "g"), "what") == [("g2",)]


def test_truthiness(spark, rows):
    df = spark.createDataFrame([(1, "x", 1, [1], True), (2, "", 0, [], False), (3, None, None, None, None)], "i int, s string, n int, a array<int>, b boolean")
    assert rows(A.incomplete(df, "i", ["s", "n", "a", "b"])) == sorted((str(i), c) for i in (2, 3) for c in "snab")


def test_texts_links_and_paths(spark, rows):
    texts = spark.createDataFrame([("docs/a.md", "See [x](../b.md#top) and [y](c.md), [z](https://h/p) [t](#f). TODO"), ("b.md", "Fine")], "path string, raw string")
    paths = spark.createDataFrame([("b.md",), ("docs/a.md",), (".envrc",), ("m/x.PT",), ("secrets/k",), (".key",)], "path string")
    assert rows(A.dead_links(texts, paths)) == [("docs/a.md", "c.md")]
    assert rows(A.open_marks(texts)) == [("docs/a.md", "TODO")]
    assert rows(A.open_marks(texts, "a.md")) == []
    assert rows(A.forbidden_paths(paths), "what") == [(".envrc",), ("m/x.PT",), ("secrets/k",)]
    parts = spark.createDataFrame([("b.md", "FINE"), ("b.md", "no"), (None, "e")], "path string, part string")
    assert rows(A.lacking(texts, parts, fold=True)) == [("b.md", "no")]


def test_markdown_table(spark, rows):
    t = spark.createDataFrame([("t.md", "| ID | a |\n| D-1 | ok | x |\n| D-2 | | x |\n| D-3 | ok |")], "path string, raw string")
    table = D.markdown_table(t, r"^\| D-", ["id", "state", "note"])
    assert rows(table, "id", "n_cells") == [("D-1", 3), ("D-2", 3), ("D-3", 2)]
    assert rows(A.table_rows(table, 3, ["state"], {"note": "x"}), "detail") == [("D-2",), ("D-3",)]


def test_secrets(spark, rows):
    key = "-----BEGIN " + "PRIVATE KEY-----"
    files = spark.createDataFrame([("a", bytearray(key.encode())), ("b", bytearray(b"\xff\xfe" + key.encode())), ("c", bytearray(key.encode() + b" " * 2_000_000)), ("d", bytearray(b"fine"))], "path string, content binary")
    assert rows(A.secrets(files)) == [("a", "private key")]


def test_forbidden_keys_at_any_depth(spark, rows):
    docs = spark.createDataFrame([("m", '{"a":[{"b":{"bad":1}}],"bad":2}'), ("n", '{"a":1}')], "name string, raw string")
    assert rows(A.forbidden_keys(docs, ["bad"])) == [("m", "root.a[0].b.bad"), ("m", "root.bad")]


def test_forbidden_keys_of_more_rows_and_levels_than_a_recursion_may_have(spark, rows):
    limits = {"spark.sql.cteRecursionRowLimit": "20", "spark.sql.cteRecursionLevelLimit": "3"}
    docs = spark.createDataFrame([(str(i), '{"a":[{"b":{"c":{"bad":[{"bad":{}}],"e":{},"f":[]}}}]}') for i in range(30)], "name string, raw string")
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        found = rows(A.forbidden_keys(docs, ["bad"]))
    finally:
        for k in limits:
            spark.conf.unset(k)
    assert found == sorted((str(i), f"root.a[0].b.c.bad{rest}") for i in range(30) for rest in ("", "[0].bad"))


COMMITS = [("c1", None), ("c2", "c1"), ("c3", "c2"), ("x1", None)]


def bound(spark, definition, release, **how):
    r = A.binding(spark.createDataFrame(COMMITS, "sha string, parent string"), definition, release, **how).first()
    return r["mode"] or (r["fault"], r["parent"])


def test_binding(spark, rows):
    assert bound(spark, "c2", "c3") == A.RELEASE
    assert bound(spark, "c3", "c3") == A.PREPARATION
    assert bound(spark, "c3", "c3", allow_preparation=False) == ("not the parent", "c2")
    assert bound(spark, "c1", "c3") == ("not the parent", "c2")
    assert bound(spark, "0" * 40, "c3")[0] == "unknown"
    assert bound(spark, "x1", "c3")[0] == "unreached"
    merges = spark.createDataFrame([("a", None, 0), ("b", None, 0), ("m", "a", 0), ("m", "b", 1)], "sha string, parent string, nth int")
    assert A.binding(merges, "a", "m").first()["mode"] == A.RELEASE and A.binding(merges, "b", "m").first()["fault"] == "not the parent"
    assert rows(A.binding_failures(A.binding(merges, "b", "m")))[0][0] == "not the parent"


def test_ancestors_of_merges_and_long_chains(spark, monkeypatch):
    diamonds = [e for i in range(60) for e in ((f"m{i + 1}", f"l{i}"), (f"m{i + 1}", f"r{i}"), (f"l{i}", f"m{i}"), (f"r{i}", f"m{i}"))]
    found = {r["sha"]: r["depth"] for r in D.ancestors(spark.createDataFrame([*diamonds, ("m0", None)], "sha string, parent string"), "m60").collect()}
    assert len(found) == 181 and found["m0"] == 120
    chain = spark.createDataFrame([(f"c{i}", f"c{i - 1}" if i else None) for i in range(2001)], "sha string, parent string")
    assert D.ancestors(chain, "c2000").count() == 2001
    monkeypatch.setattr("quillgate.operators.graphs.HOP_PAIRS", 300)
    found = {r["sha"]: r["depth"] for r in D.ancestors(spark.createDataFrame([*diamonds, ("m0", None)], "sha string, parent string"), "m60").collect()}
    assert len(found) == 181 and found["m0"] == 120


def test_hashes(spark, rows):
    blobs = spark.createDataFrame([("c2", "a", bytearray(b"old")), ("c3", "a", bytearray(b"new"))], "commit string, path string, content binary")
    old = blobs.where("commit = 'c2'").select(F.sha2("content", 256)).first()[0]
    recorded = spark.createDataFrame([("a", old), ("b", "0" * 64)], "path string, sha256 string")
    assert rows(A.hash_mismatches(recorded, blobs, "c2")) == [("b", "missing")]
    assert rows(A.hash_mismatches(recorded, blobs, "c3")) == [("a", "hash mismatch"), ("b", "missing")]


def test_refs_and_tags(spark, rows):
    listing = ["o1\trefs/tags/v1", "p1\trefs/tags/v1^{}", "x\trefs/heads/main", "o9\trefs/tags/v2", "o2\trefs/tags/v2", "junk"]
    tags = D.tags(D.refs(spark.createDataFrame(list(enumerate(listing)), "n int, value string")))
    assert rows(tags) == [("refs/tags/v1", "o1", "p1"), ("refs/tags/v2", "o2", None)]
    local = spark.createDataFrame([("refs/tags/v1", "o1", "p1"), ("refs/tags/v2", "o3", None), ("refs/tags/v3", "o4", "p")], "name string, object string, peeled string")
    assert rows(A.tag_states(local, tags)) == [("refs/tags/v1", "equal"), ("refs/tags/v2", "different"), ("refs/tags/v3", "local only")]
    assert rows(A.tag_failures(local, tags, {"refs/tags/v1": {"equal"}, "refs/tags/v9": {"absent"}, "refs/tags/v3": {"equal"}})) == [("refs/tags/v3", "local only")]


def test_small_sources(spark, rows, tmp_path):
    urls = spark.createDataFrame([("git@host.org:o/n.git",), ("https://host.org/o/n",), ("other",)], "u string")
    assert rows(urls.select(D.repository_of("u"))) == [("o/n",), ("o/n",), ("other",)]
    names = spark.createDataFrame([("a/b.TAR.Gz",), (".key",), ("x",), ("d.e/f",)], "p string")
    assert [r[0] for r in names.select(D.suffix("p")).collect()] == [".gz", "", "", ""]
    (tmp_path / "a.b.json").write_text('{"k": 1}')
    assert rows(D.json_documents(spark, str(tmp_path)), "name", "raw") == [("a.b", '{"k": 1}')]
    (tmp_path / "c.yaml").write_text("k: [1, x]\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    assert rows(D.documents(spark, str(tmp_path)), "name", "raw") == [("a.b", '{"k": 1}'), ("c", '{"k": [1, "x"]}')]
    assert D.files(spark, str(tmp_path), ignored=r"\.yaml$").count() == 1


def snapshot(spark):
    docs = [("good", "doc", "p", '{"k": 1}', True), ("bad", "doc", "q", '{"k": 1, "z": 2}', False)]
    texts = spark.createDataFrame([("d/a.md", "Anchor. [x](b.md)"), ("d/b.md", "b")], "path string, raw string")
    return R.Snapshot(
        documents=spark.createDataFrame(docs, "name string, contract string, path string, raw string, valid boolean"), texts=texts, paths=texts.select("path"),
        files=texts.select("path", F.encode("raw", "UTF-8").alias("content")),
        blobs=spark.createDataFrame([("c2", "d/b.md", bytearray(b"b"))], "commit string, path string, content binary"),
        commits=spark.createDataFrame(COMMITS, "sha string, parent string"),
        local_tags=spark.createDataFrame([("refs/tags/v1", "o", "c3")], "name string, object string, peeled string"),
        remote_tags=spark.createDataFrame([("refs/tags/v1", "o", "c3")], "name string, object string, peeled string"),
        history=spark.createDataFrame([(0, "1", "o", "c3")], "n int, version string, tag_object string, peeled_commit string"),
        repo=spark.createDataFrame([("o/n", "private", "main", None)], "repository string, visibility string, default_branch string, has_wiki boolean"),
        status=spark.createDataFrame([("pages", 200)], "what string, code int"), runs=spark.createDataFrame([], "id string"),
        tag_message=spark.createDataFrame([("definition c2",)], "text string"),
        capabilities=spark.createDataFrame([("c", ["g"])], "capability_id string, evaluation_id array<string>"),
        gates=spark.createDataFrame([("g", "m", 1)], "evaluation_id string, metric string, sample_count int"),
    )


def policy():
    shape = C.Record(fields={"k": C.Integer()})
    sha = "3e23e8160039594a33894f6564e1b1348bbd7a0088d42c4acb73eeaed59c009d"
    return R.Policy(contracts={"doc": shape}, reasons={"bad": "additionalProperties"}, anchors=[("d/a.md", "anchor")], prohibited_keys=["self"], hashes={"d/b.md": sha}, definition="c2", release="c3", repository="o/n", baseline={"1": {"tag_object": "o", "peeled_commit": "c3"}}, tags={"refs/tags/v1": {"equal"}}, message_parts=["c2"])


def test_validate_covers_roots_locks_decisions_ledger_and_tags(spark, rows):
    s, p = snapshot(spark), policy()
    records = [(f"adr/{i:04}-x.md", "# T\n## Status\nAccepted\n## Why") for i in range(1, 4)]
    trace = "| ID | t |\n" + "\n".join(f"| D-{i} | ADR-{i:04} | a | b | c | d | e | accepted | z |" for i in range(1, 4))
    s.texts = spark.createDataFrame([*records, ("trace.md", trace), ("d/a.md", "Anchor."), ("d/b.md", "b")], "path string, raw string")
    s.paths = s.texts.select("path")
    p.roots, p.locked, p.decisions, p.decision_count = ["good"], {"k is one": ("good", "$.k", 1)}, "adr/", 3
    p.decision_headings, p.trace, p.trace_row, p.trace_least = ["## Status", "## Why"], "trace.md", r"^\| D-", 3
    p.historical = ("v1", "c3")
    found = R.validate(s, p).cache()
    assert reports.exit_code(found) == 0, reports.lines(found)
    p.roots, p.locked, p.decision_count, p.trace_least, p.historical = ["good", "gone"], {"k is two": ("good", "$.k", 2), "no such": ("nope", "$.k", 1)}, 4, 4, ("v1", "c2")
    p.decision_headings, p.trace_cells, p.release = ["## Risks"], 8, "c9"
    bad = {r["name"] for r in R.validate(s, p).where("status = 'FAIL'").collect()}
    assert bad == {"root documents", "locked values", "decision records", "decision headings", "trace rows", "trace cells", "historical tag", "release commit", "definition binding"}
    p.legacy = ["gone"]
    assert "root documents" not in {r["name"] for r in R.validate(s, p).where("status = 'FAIL'").collect()}
    s.manifest = spark.createDataFrame([("m", '{"a": [{"self": 1}]}')], "name string, raw string")
    p = policy()
    assert {r["name"] for r in R.audit_release(s, p, "v1").where("status = 'FAIL'").collect()} == {"tagged manifest"}


POLICY = policy()


def test_command_line(spark, tmp_path, capsys):
    from quillgate.__main__ import main

    s = snapshot(spark)
    for k, df in vars(s).items():
        if df is not None:
            df.write.parquet(str(tmp_path / "snap" / k))
    args = ["--snapshot", str(tmp_path / "snap"), "--policy", f"{__name__}:POLICY"]
    assert main(["validate", *args, "--report", str(tmp_path / "report")], spark) == 0
    assert "PASS: open marks: none" in capsys.readouterr().out
    assert main(["audit-remote", *args], spark) == 1
    assert main(["audit-release", *args, "--tag", "v1"], spark) == 0
    assert spark.read.text(str(tmp_path / "report")).count() > 6


def test_runs_and_reports(spark, tmp_path):
    s, p = snapshot(spark), policy()
    offline = R.validate(s, p).cache()
    assert reports.exit_code(offline) == 0, reports.lines(offline)
    remote = R.audit_remote(s, p).cache()
    assert {r["name"] for r in remote.where("status = 'FAIL'").collect()} == {"hosting policy", "pages"}
    assert reports.first_failure(remote).first()["name"] == "hosting policy"
    tag = R.audit_release(s, p, "v1").cache()
    assert reports.exit_code(tag) == 0, reports.lines(tag)
    p.baseline["1"]["peeled_commit"] = "other"
    assert reports.exit_code(R.audit_release(s, p, "v1")) == 1
    text = reports.markdown(remote, "Audit", {"release": "c3"})
    assert "Result: FAIL (6 checks, 2 failed)" in text and text.count("| PASS |") == 4
    reports.write_markdown(remote, str(tmp_path / "r"), "Audit", {})
    assert spark.read.text(str(tmp_path / "r")).count() > 6


def test_self_references_beyond_the_recursion_limit(spark):
    from quillgate.queries_release import self_references

    spark.conf.set("spark.sql.cteRecursionRowLimit", "100")
    try:
        found = self_references(spark, "/root/testdata/sf0.001")
        keys = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey").collect()]
        wanted = {(str(k), p) for k in keys for n, p in ((3, "root.a[0].b.self"), (4, "root.self"), (5, "root.x.y.commit")) if k % n == 0}
        assert {tuple(r) for r in found.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")

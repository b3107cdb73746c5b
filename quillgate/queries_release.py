"""Queries of contracts, sources, audits and the release runs on the test tables by analogy (documents as files and blobs, customers
as commits, orders as refs, parts as records), and the same in DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.operators import audits as A
from quillgate.operators import contract_shapes as S
from quillgate.operators import contracts as C
from quillgate.plans import release as R
from quillgate.registry import HREF, query
from quillgate.sources import documents as D
from quillgate.sources import reports
from quillgate.tables import shared_dir, table

# Contracts: every keyword, over a JSON document for each document of the corpus

KEYWORDS = C.Record(
    fields={
        "id": C.Text(format="uuid"), "kind": C.Const(value="document"), "lang": C.Enum(values=("en", "de", "fr")), "title": C.Text(pattern="^[A-Z]", least=3),
        "at": C.Text(format="date-time"), "mail": C.Text(format="email", nullable=True), "tags": C.List(item=C.Text(), least=2, unique=True, contains=("base",)),
        "scores": C.Map(value=C.Number(0, 1), least=2), "n": C.Integer(1, 4), "flag": C.Flag(), "status": C.Enum(values=("accepted", "rejected")), "rights": C.Text(), "review": C.Text(),
        "payload": C.OneOf(branches=(C.Record(fields={"a": C.Integer()}), C.Record(fields={"b": C.Text()}))),
    },
    optional=("mail", "review"),
    rules=(C.When("status", "accepted", required=("review",), then={"rights": C.Enum(values=("owned", "licensed"))}), C.When("status", "rejected", then={"n": C.Integer(most=3)})),
)
#: Members of each document as JSON text, by i = doc_id; null: absent.
MEMBERS = {
    "id": "CASE WHEN i % 13 = 0 THEN concat('\"x-', i, '\"') ELSE concat('\"00000000-0000-4000-8000-', lpad(CAST(i AS STRING), 12, '0'), '\"') END",
    "kind": "CASE WHEN i % 11 = 0 THEN '\"other\"' ELSE '\"document\"' END",
    "lang": "concat('\"', lang, '\"')",
    "title": "CASE WHEN i % 17 = 0 THEN '\"a title\"' WHEN i % 19 = 0 THEN '\"Ab\"' ELSE '\"A title\"' END",
    "at": "CASE WHEN i % 7 = 0 THEN '\"2026-13-01T00:00:00Z\"' ELSE '\"2026-01-02T03:04:05Z\"' END",
    "mail": "CASE WHEN i % 5 = 0 THEN 'null' WHEN i % 23 = 0 THEN '\"nobody\"' WHEN i % 3 = 0 THEN NULL ELSE '\"a@b.c\"' END",
    "tags": "CASE i % 6 WHEN 0 THEN '[\"base\"]' WHEN 1 THEN '[\"base\",\"base\"]' WHEN 2 THEN '[\"x\",\"y\"]' WHEN 3 THEN '[\"base\",1]' ELSE '[\"base\",\"x\"]' END",
    "scores": "CASE i % 8 WHEN 0 THEN '{\"x\":0.5}' WHEN 1 THEN '{\"x\":0.5,\"y\":1.5}' WHEN 2 THEN '{\"x\":-1,\"y\":0}' WHEN 3 THEN '{\"x\":\"a\",\"y\":0}' ELSE '{\"x\":0,\"y\":1}' END",
    "n": "CASE i % 9 WHEN 0 THEN '0' WHEN 1 THEN '1.5' WHEN 2 THEN '\"1\"' WHEN 3 THEN '1.0' WHEN 4 THEN '5' ELSE '4' END",
    "flag": "CASE WHEN i % 37 = 0 THEN NULL WHEN i % 41 = 0 THEN '1' ELSE 'true' END",
    "status": "CASE WHEN i % 4 = 0 THEN '\"accepted\"' ELSE '\"rejected\"' END",
    "rights": "CASE WHEN i % 3 = 0 THEN '\"unknown\"' ELSE '\"owned\"' END",
    "review": "CASE WHEN i % 8 = 0 THEN NULL ELSE '\"r\"' END",
    "payload": "CASE i % 10 WHEN 0 THEN '{\"a\":1,\"b\":\"x\"}' WHEN 1 THEN '{\"c\":1}' WHEN 2 THEN '{\"b\":\"x\"}' ELSE '{\"a\":1}' END",
    "extra": "CASE WHEN i % 29 = 0 THEN '1' END",
}
#: What each rule of KEYWORDS finds wrong, by i; documents with i % 31 = 0 repeat a key and are malformed.
BROKEN = {
    "malformed": None, "id.format": "i % 13 = 0", "kind.const": "i % 11 = 0", "lang.enum": "lang NOT IN ('en', 'de', 'fr')", "title.pattern": "i % 17 = 0", "title.minLength": "i % 17 <> 0 AND i % 19 = 0",
    "at.format": "i % 7 = 0", "mail.format": "i % 5 <> 0 AND i % 23 = 0", "tags.minItems": "i % 6 = 0", "tags.uniqueItems": "i % 6 = 1", "tags.contains base": "i % 6 = 2", "tags.items.type": "i % 6 = 3",
    "scores.minProperties": "i % 8 = 0", "scores.values.maximum": "i % 8 = 1", "scores.values.minimum": "i % 8 = 2", "scores.values.type": "i % 8 = 3",
    "n.minimum": "i % 9 = 0", "n.type": "i % 9 IN (1, 2)", "n.maximum": "i % 9 = 4", "required flag": "i % 37 = 0", "flag.type": "i % 37 <> 0 AND i % 41 = 0", "payload.oneOf": "i % 10 IN (0, 1)",
    "if status=accepted: required review": "i % 8 = 0", "if status=accepted: rights.enum": "i % 12 = 0", "if status=rejected: n.type": "i % 4 <> 0 AND i % 9 IN (1, 2)", "if status=rejected: n.maximum": "i % 4 <> 0 AND i % 9 NOT IN (0, 1, 2, 3)", "additionalProperties": "i % 29 = 0",
}


def _json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("i"), "lang")
    raw = "concat('{', concat_ws(',', " + ", ".join(f"concat('\"{k}\":', {v})" for k, v in MEMBERS.items()) + "), '}')"
    return d.selectExpr("CAST(i AS STRING) AS name", f"CASE WHEN i % 31 = 0 THEN '{{\"id\":1,\"id\":2}}' ELSE {raw} END AS raw")


WRONG = " UNION ALL ".join(f"SELECT i, '{k}' AS rule FROM d WHERE " + (f"i % 31 <> 0 AND ({v})" if v else "i % 31 = 0") for k, v in BROKEN.items())


@query(f"WITH d AS (SELECT doc_id AS i, lang FROM documents), w AS ({WRONG}) SELECT rule, count(*) AS violations FROM w GROUP BY rule")
def contract_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, const, required, closed objects, maps, patterns, formats, enumerations, lengths, bounds, arrays, oneOf, several
    conditionals: each keyword is broken by some documents."""
    return C.violations(C.parsed(_json_documents(spark, sf_dir)), KEYWORDS).groupBy("rule").agg(F.count("*").alias("violations"))


@query(f"""
WITH d AS (SELECT doc_id AS i, lang FROM documents), w AS ({WRONG})
SELECT CAST(i AS VARCHAR) AS id, rule, row_number() OVER (PARTITION BY i ORDER BY regexp_extract(rule, '^(.*)\\.[^.]*$', 1), rule) AS position FROM w
""")
def contract_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations in report order: by document, path as text, rule."""
    from pyspark.sql import Window as W

    found = C.ordered(C.violations(C.parsed(_json_documents(spark, sf_dir)), KEYWORDS)).withColumn("at", F.monotonically_increasing_id())
    return found.select("id", "rule", F.row_number().over(W.partitionBy("id").orderBy("at")).alias("position"))


@query("""
SELECT * FROM (VALUES ('agent_event', 'sound'), ('agent_tool_call', 'sound'), ('keywords', 'sound'), ('open', 'refused'), ('unknown field', 'refused'), ('unknown format', 'refused')) t(contract, verdict)
""")
def contract_soundness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract's own check: shapes and KEYWORDS are sound, an open record or one with unknown names isn't."""
    tried = {
        "agent_event": S.agent_event(("x",)), "agent_tool_call": S.agent_tool_call(), "keywords": KEYWORDS, "open": C.Record(fields={"a": C.Text()}, closed=False),
        "unknown field": C.Record(fields={"a": C.Text()}, optional=("b",)), "unknown format": C.Record(fields={"a": C.Map(value=C.Text(format="none"))}),
    }
    out = []
    for name, contract in tried.items():
        try:
            C.check_contract(name, contract)
            out.append((name, "sound"))
        except ValueError:
            out.append((name, "refused"))
    return spark.createDataFrame(out, "contract string, verdict string")


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 5 = 0 THEN 'type.enum' ELSE 'sequence.minimum' END AS rule FROM events WHERE event_id % 5 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'sequence.minimum' FROM events WHERE event_id % 7 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'event_id.format' FROM events WHERE event_id % 11 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'additionalProperties' FROM events WHERE event_id % 13 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'required trace_id' FROM events WHERE event_id % 17 = 0
""")
def event_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the agent event's shape, some of them broken."""
    u = lambda n: F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(n.cast("string"), 12, "0"))
    i = F.col("event_id")
    fields = {
        "protocol_version": F.lit("1.0.0"), "event_id": F.when(i % 11 == 0, "x").otherwise(u(i)), "session_id": u(F.col("user_id")), "sequence": F.when(i % 7 == 0, -1).otherwise(i),
        "timestamp": F.lit("2026-01-02T03:04:05Z"), "type": F.when(i % 5 == 0, "unheard").otherwise(F.col("event_type")), "source": F.lit("backend"), "trace_id": F.when(i % 17 != 0, u(i)),
        "payload": F.create_map(F.lit("k"), F.col("value")), "extra": F.when(i % 13 == 0, 1),
    }
    rows = table(spark, sf_dir, "events").select(i.cast("string").alias("name"), F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("raw"))
    shape = S.agent_event(("click", "error", "purchase", "signup", "view"))
    return C.violations(C.parsed(rows), shape).select("id", "rule")


# Sources


def _put(spark: SparkSession, folder: str, files: dict[str, str]) -> None:
    """Writes small files through Spark's file systems, so that any store will do."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, text in files.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytearray(text.encode()))
        out.close()


@query("""
SELECT n_name AS name, 'json' AS kind, n_regionkey AS region, 2 + n_nationkey % 3 AS tags FROM nation
UNION ALL SELECT r_name, 'yaml', r_regionkey, 1 FROM region UNION ALL SELECT 'all files', 'files', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region), 0
""")
def captured_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as JSON files and regions as YAML files, written and read back: documents by suffix, files without the ignored."""
    folder, files = f"{shared_dir(spark)}/captured-{uuid.uuid4().hex}", {}
    for r in table(spark, sf_dir, "nation").collect():  # 25 rows
        files[f"a/{r.n_name}.json"] = f'{{"region": {r.n_regionkey}, "tags": [{", ".join(["1"] * (2 + r.n_nationkey % 3))}]}}'
    for r in table(spark, sf_dir, "region").collect():  # 5 rows
        files[f"b/{r.r_name}.yaml"] = f"# a region\nregion: {r.r_regionkey}\ntags:\n  - one\n"
    files["b/notes.txt"] = "neither"
    _put(spark, folder, files)
    doc = F.try_parse_json("raw")
    region, tags = F.try_variant_get(doc, "$.region", "long"), F.size(F.try_variant_get(doc, "$.tags", "variant").try_cast("array<variant>"))
    read = D.documents(spark, folder).select("name", D.suffix("path").substr(2, 9).alias("kind"), region.cast("long").alias("region"), tags.cast("long").alias("tags"))
    n = D.files(spark, folder, ignored=r"\.txt$").agg(F.count("*").alias("region"))
    return read.unionByName(n.select(F.lit("all files").alias("name"), F.lit("files").alias("kind"), "region", F.lit(0).cast("long").alias("tags")))


BLOBS = "SELECT 'c' || (doc_id % 3) AS c, source || '/' || doc_id || '.md' AS path, text, doc_id FROM documents"


def _blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("c"), F.col("doc_id") % 3).alias("commit"), F.concat_ws("/", "source", F.concat("doc_id", F.lit(".md"))).alias("path"), F.encode("text", "UTF-8").alias("content"), "doc_id")


@query(f"""
WITH b AS ({BLOBS})
SELECT path AS what, CASE WHEN c <> 'c1' THEN 'missing' ELSE 'hash mismatch' END AS detail FROM b WHERE c <> 'c1' OR doc_id % 7 = 0
UNION ALL SELECT 'blob', sha256(text) FROM b WHERE path = 'src1/1.md' AND c = 'c1'
""")
def blob_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as blobs of three commits, against recorded hashes, of which every seventh is wrong; and one blob's hash."""
    blobs = _blobs(spark, sf_dir)
    recorded = D.hashed(blobs).select("path", F.when(F.col("doc_id") % 7 == 0, F.lit("0" * 64)).otherwise(F.col("sha256")).alias("sha256"))
    one = A.failures(D.hashed(D.blob(blobs, "c1", "src1/1.md")), F.lit("blob"), "sha256")
    return A.hash_mismatches(recorded, blobs.drop("doc_id"), "c1").unionByName(one)


@query("SELECT source AS name, min(doc_id) AS least, count(*) AS n FROM documents WHERE lang = 'de' GROUP BY source")
def yaml_at_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest for each source as YAML in a commit, read as JSON."""
    d = table(spark, sf_dir, "documents").where("lang = 'de'").groupBy("source").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    text = F.format_string("name: '%s' # quoted\nfacts:\n  least: %d\n  list: [%d, 2]\n", "source", "least", "n")
    blobs = d.select(F.lit("c1").alias("commit"), F.lit("m.yaml").alias("path"), F.encode(text, "UTF-8").alias("content")).union(d.select(F.lit("c2"), F.lit("m.yaml"), F.encode(F.lit("x: 1"), "UTF-8")))
    doc = F.try_parse_json("raw")
    return D.yaml_at(blobs, "c1", "m.yaml").select(*[F.try_variant_get(doc, p, t).alias(n) for n, p, t in (("name", "$.name", "string"), ("least", "$.facts.least", "long"), ("n", "$.facts.list[0]", "long"))])


LISTED = """
l AS (SELECT o_orderkey AS n, 'refs/tags/v' || (o_orderkey % 400) AS tag, 'o' || o_custkey AS object, o_orderkey % 5 AS k FROM orders),
own AS (SELECT tag AS name, max_by(object, n) AS object FROM l WHERE k NOT IN (0, 1, 2) GROUP BY tag),
peel AS (SELECT tag AS name, max_by(object, n) AS peeled FROM l WHERE k = 1 GROUP BY tag)
"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 5
    tag = F.concat(F.lit("refs/tags/v"), F.col("o_orderkey") % 400)
    line = F.when(k == 0, "junk").when(k == 2, F.concat(F.lit("x\trefs/heads/b"), F.col("o_orderkey"))).otherwise(F.concat(F.lit("o"), "o_custkey", F.lit("\t"), tag, F.when(k == 1, "^{}").otherwise("")))
    return D.tags(D.refs(o.select(F.col("o_orderkey").alias("n"), line.alias("value"))))


@query(f"WITH {LISTED} SELECT name, object, peeled FROM own LEFT JOIN peel USING (name)")
def captured_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a listing of remote refs, the last line of a name counting, as tags."""
    return _listed(spark, sf_dir)


TAG_STATES = """
r AS (SELECT name, object, peeled FROM own LEFT JOIN peel USING (name)),
here AS (SELECT name, CASE WHEN CAST(substr(name, 12) AS BIGINT) % 4 = 1 THEN 'moved' ELSE object END AS object, peeled FROM r WHERE CAST(substr(name, 12) AS BIGINT) % 4 <> 0 UNION ALL SELECT 'refs/tags/own', 'o', NULL),
state AS (SELECT coalesce(h.name, r.name) AS name, CASE WHEN h.name IS NULL THEN 'remote only' WHEN r.name IS NULL THEN 'local only'
  WHEN h.object = r.object AND h.peeled IS NOT DISTINCT FROM r.peeled THEN 'equal' ELSE 'different' END AS state FROM here h FULL JOIN r ON h.name = r.name)
"""
ALLOWED = {"refs/tags/v3": {"equal"}, "refs/tags/v8": {"equal"}, "refs/tags/own": {"remote only"}, "refs/tags/none": {"absent"}, "refs/tags/none2": {"equal"}, "refs/tags/v4": {"remote only", "equal"}}


@query(f"""
WITH {LISTED}, {TAG_STATES}, a AS (SELECT * FROM (VALUES {", ".join(f"('{k}', [{', '.join(repr(x) for x in sorted(v))}])" for k, v in ALLOWED.items())}) t(name, fine))
SELECT name, state, 'state' AS kind FROM state
UNION ALL SELECT a.name, coalesce(state, 'absent'), 'not allowed' FROM a LEFT JOIN state USING (name) WHERE NOT list_contains(fine, coalesce(state, 'absent'))
""")
def tag_state_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each tag on both sides, and those that aren't as allowed."""
    remote = _listed(spark, sf_dir)
    k = F.substring("name", 12, 20).cast("long") % 4
    local = remote.where(k != 0).withColumn("object", F.when(k == 1, "moved").otherwise(F.col("object"))).union(spark.createDataFrame([("refs/tags/own", "o", None)], remote.schema))
    states = A.tag_states(local, remote).withColumn("kind", F.lit("state"))
    return states.unionByName(A.tag_failures(local, remote, ALLOWED).select(F.col("what").alias("name"), F.col("detail").alias("state"), F.lit("not allowed").alias("kind")))


COMMITS = """
edge AS (SELECT 'c' || c_custkey AS sha, 'c' || (c_custkey // 7) AS parent FROM customer WHERE c_custkey > 0 UNION SELECT 'c' || c_custkey, 'c' || (c_custkey // 3) FROM customer WHERE c_custkey > 0 AND c_custkey % 5 = 0),
up AS (SELECT 'c149' AS sha, 0 AS depth UNION SELECT e.parent, up.depth + 1 FROM up JOIN edge e ON e.sha = up.sha)
"""


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    name = lambda x: F.concat(F.lit("c"), x.cast("long"))
    first = c.select(name(k).alias("sha"), F.when(k > 0, name(F.floor(k / 7))).alias("parent"), F.lit(0).alias("nth"))
    return first.unionByName(c.where((k > 0) & (k % 5 == 0)).select(name(k).alias("sha"), name(F.floor(k / 3)).alias("parent"), F.lit(1).alias("nth")))


@query(f"WITH RECURSIVE {COMMITS} SELECT sha, min(depth) AS depth FROM up GROUP BY sha")
def commit_ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as commits with merges: all that one of them reaches, and how far off."""
    return D.ancestors(_commits(spark, sf_dir), "c149")


BOUND = [("c21", "c149", True), ("c21", "c149", False), ("c149", "c149", True), ("c149", "c149", False), ("c3", "c149", True), ("c4", "c149", True), ("none", "c149", True), ("c28", "c140", False), ("c20", "c140", True)]


@query(f"""
WITH RECURSIVE edge AS (SELECT c_custkey AS k, c_custkey // 7 AS p FROM customer WHERE c_custkey > 0 UNION SELECT c_custkey, c_custkey // 3 FROM customer WHERE c_custkey > 0 AND c_custkey % 5 = 0),
t AS (SELECT * FROM (VALUES {", ".join(f"('{d}', '{r}', {str(a).lower()})" for d, r, a in BOUND)}) t(definition, release, preparation)),
up AS (SELECT release AS tip, CAST(substr(release, 2) AS BIGINT) AS k FROM t UNION SELECT tip, p FROM up JOIN edge USING (k))
SELECT definition, release, preparation, CASE WHEN substr(definition, 2) NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) THEN 'unknown'
  WHEN NOT EXISTS (SELECT 1 FROM up WHERE tip = release AND 'c' || k = definition) THEN 'unreached'
  WHEN preparation AND definition = release THEN 'release-preparation' WHEN 'c' || (CAST(substr(release, 2) AS BIGINT) // 7) = definition THEN 'release-commit' ELSE 'not the parent' END AS verdict FROM t
""")
def definition_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition commits against release commits: unknown, unreached, not the first parent, or sound."""
    c = _commits(spark, sf_dir)
    return A.run([A.binding(c, d, r, p).select(F.lit(d).alias("definition"), F.lit(r).alias("release"), F.lit(p).alias("preparation"), F.coalesce("fault", "mode").alias("verdict")) for d, r, p in BOUND])


@query(f"""
WITH RECURSIVE {COMMITS} SELECT w AS what, 'isn''t reached from c149' AS detail FROM (VALUES ('c0'), ('c21'), ('c4')) t(w) WHERE w NOT IN (SELECT sha FROM up)
""")
def unreached_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _commits(spark, sf_dir)
    return A.run([A.unreachable(c, "c149", w) for w in ("c0", "c21", "c4")])


@query("""
SELECT c_custkey AS k, 'o' || c_nationkey || '/n' || c_custkey AS repository, c_mktsegment AS visibility, c_custkey % 2 = 0 AS wiki, 'Title ' || c_custkey AS line FROM customer
""")
def hosting_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as captured remotes, hosting answers and command output."""
    k, name = F.col("c_custkey"), F.concat(F.lit("o"), "c_nationkey", F.lit("/n"), "c_custkey")
    url = F.when(k % 3 == 0, F.concat(F.lit("git@host.org:"), name, F.lit(".git"))).when(k % 3 == 1, F.concat(F.lit("https://host.org/"), name, F.lit(".git"))).otherwise(F.concat(F.lit("https://host.org/"), name))
    raw = F.to_json(F.struct(F.col("c_mktsegment").alias("visibility"), (k % 2 == 0).alias("has_wiki"), k.alias("id")))
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), url.alias("url"), raw.alias("raw"), F.concat(F.lit("  Title "), k, F.lit("\nmore\n")).alias("out"))
    told = D.policy(rows, "id", "visibility", "has_wiki")
    told = told.select(told.id.try_cast("long").alias("k"), told.visibility.try_cast("string").alias("visibility"), told.has_wiki.try_cast("boolean").alias("wiki"))
    return rows.select("k", D.repository_of("url").alias("repository"), D.first_line("out").alias("line")).join(told, "k")


# Audits of texts, files and keys


@query("""
WITH p AS (SELECT *, p_partkey % 7 = 0 AS short, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS brand FROM part)
SELECT 'P-' || p_partkey AS row, CASE WHEN short THEN 3 ELSE 4 END AS cells, short OR brand = '' OR p_size % 2 = 1 AS bad FROM p
""")
def trace_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows of Markdown tables, a document for each size: cells of each row, and which rows fail."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    cells = [F.concat(F.lit("P-"), k), F.col("p_name"), F.when(k % 5 == 0, "").otherwise(F.col("p_brand")), F.when(F.col("p_size") % 2 == 0, "accepted").otherwise("open")]
    line = F.concat(F.lit("| "), F.when(k % 7 == 0, F.concat_ws(" | ", *cells[:3])).otherwise(F.concat_ws(" | ", *cells)), F.lit(" |"))
    texts = p.groupBy("p_size").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("t")).select(F.concat(F.lit("size"), "p_size", F.lit(".md")).alias("path"), F.concat(F.lit("| id | name |\n|---|---|\n"), "t").alias("raw"))
    rows = D.markdown_table(texts, r"^\| P-[0-9]+ \|", ["id", "name", "brand", "status"])
    bad = A.table_rows(rows, 4, ["brand"], {"status": "accepted"}).select(F.col("detail").alias("id"), F.lit(True).alias("bad"))
    return rows.join(bad, "id", "left").select(F.col("id").alias("row"), F.col("n_cells").alias("cells"), F.coalesce("bad", F.lit(False)).alias("bad"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS what, 'licence' AS detail FROM documents WHERE NOT contains(lower(text), 'licence')
UNION ALL SELECT CAST(doc_id AS VARCHAR), source FROM documents WHERE doc_id % 10 = 0 AND NOT contains(lower(text), lower(source))
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'the' FROM documents WHERE doc_id % 10 = 0 AND NOT contains(lower(text), 'the')
UNION ALL SELECT 'nowhere', 'x' UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM documents
""")
def required_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that every document must hold, or some of them, whatever the case; and a count of rows that is wrong."""
    d = table(spark, sf_dir, "documents")
    texts = d.select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("raw"))
    some = d.where(F.col("doc_id") % 10 == 0)
    parts = some.select(F.col("doc_id").cast("string").alias("path"), F.col("source").alias("part")).union(some.select(F.col("doc_id").cast("string"), F.lit("THE")))
    parts = parts.union(spark.createDataFrame([(None, "licence"), ("nowhere", "x")], "path string, part string"))
    found = A.lacking(texts, parts, fold=True).withColumn("detail", F.when(F.col("detail") == "THE", "the").otherwise(F.col("detail")))
    return found.unionByName(A.count_is(d, 1, 2))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS what, 'root.a[0].b.self' AS detail FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'root.self' FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'root.x.y.commit' FROM customer WHERE c_custkey % 5 = 0
""")
def self_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forbidden keys at any depth of nested documents."""
    k = F.col("c_custkey")
    inner = F.when(k % 3 == 0, F.concat(F.lit('"a":[{"b":{"self":'), k, F.lit("}}]"))).otherwise('"a":[{"b":"self"}]')
    raw = F.concat(F.lit("{"), F.concat_ws(",", inner, F.when(k % 4 == 0, '"self":1'), F.when(k % 5 == 0, '"x":{"y":{"commit":null}}')), F.lit("}"))
    return A.forbidden_keys(table(spark, sf_dir, "customer").select(k.cast("string").alias("name"), raw.alias("raw")), ["self", "commit"])


@query("""
SELECT DISTINCT CAST(l_partkey + 5 AS VARCHAR) AS what, 'isn''t defined' AS detail FROM lineitem WHERE l_partkey + 5 NOT IN (SELECT p_partkey FROM part)
""")
def undefined_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in arrays that the other table doesn't define: the parts of orders, five further on."""
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_partkey") + 5).alias("parts"))
    return A.unresolved(o, "parts", table(spark, sf_dir, "part"), "p_partkey")


@query("""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN text || ' fixme' WHEN doc_id % 11 = 0 THEN 'TBD: ' || text ELSE text END AS t FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS what, CASE WHEN doc_id % 9 = 0 THEN 'fixme' ELSE 'TBD' END AS detail FROM d WHERE regexp_matches(t, '(?i)\\b(TBD|TODO|FIXME)\\b')
""")
def open_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("doc_id"), F.col("text")
    raw = F.when(k % 9 == 0, F.concat(t, F.lit(" fixme"))).when(k % 11 == 0, F.concat(F.lit("TBD: "), t)).otherwise(t)
    return A.open_marks(table(spark, sf_dir, "documents").select(k.cast("string").alias("path"), raw.alias("raw")))


@query(f"""
WITH l AS (SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, '{HREF}', 1)), '#.*$', '') AS target FROM pages),
r AS (SELECT * FROM l WHERE target <> '' AND NOT regexp_matches(target, '^([A-Za-z][A-Za-z0-9+.-]*:|//)'))
SELECT CAST(page_id AS VARCHAR) AS what, target AS detail, count(*) AS n FROM r WHERE list_aggregate(list_filter(string_split(target, '/'), lambda x: x NOT IN ('', '.')), 'string_agg', '/') NOT IN ('the', 'The', 'and', 'of', 'de') GROUP BY ALL
""")
def dead_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages that lead to none of a few known paths."""
    texts = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").alias("raw"))
    return A.dead_links(texts, A.values(spark, ["the", "The", "and", "of", "de"], "path"), HREF).groupBy("what", "detail").agg(F.count("*").alias("n"))


@query("""
WITH p AS (SELECT CASE p_partkey % 6 WHEN 0 THEN 'secrets/' || p_partkey WHEN 1 THEN 'm/' || p_partkey || '.PT' WHEN 2 THEN '.env' || p_partkey WHEN 3 THEN 'a/.key' || p_partkey ELSE 'docs/' || p_partkey || '.md' END AS path, p_partkey FROM part)
SELECT path AS what, 'is forbidden' AS detail FROM p WHERE p_partkey % 6 IN (0, 1, 2)
""")
def forbidden_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    path = F.when(k % 6 == 0, F.concat(F.lit("secrets/"), k)).when(k % 6 == 1, F.concat(F.lit("m/"), k, F.lit(".PT"))).when(k % 6 == 2, F.concat(F.lit(".env"), k)).when(k % 6 == 3, F.concat(F.lit("a/.key"), k)).otherwise(F.concat(F.lit("docs/"), k, F.lit(".md")))
    return A.forbidden_paths(table(spark, sf_dir, "part").select(path.alias("path")))


@query("""
WITH h AS (SELECT 'v' || (o_orderkey % 50) AS version, min_by(o_custkey, o_orderkey) AS c, min_by(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY 1)
SELECT 'status' AS what, 'doesn''t hold' AS detail, version FROM h WHERE version IN ('v1', 'v2', 'v3') AND s <> 'F'
UNION ALL SELECT 'tag', 'doesn''t hold', version FROM h WHERE version IN ('v1', 'v2', 'v3') AND c % 2 = 1
UNION ALL SELECT 'v77', 'has no entry', 'v77'
""")
def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as entries of a release ledger, of which a version's first counts."""
    o = table(spark, sf_dir, "orders")
    h = o.select(F.col("o_orderkey").alias("n"), F.concat(F.lit("v"), F.col("o_orderkey") % 50).alias("version"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 2).alias("tag"))
    out = [A.history_entry(h, v, {"status": "F", "tag": 0}).withColumn("version", F.lit(v)) for v in ("v1", "v2", "v3")]
    # an unknown version has no entry, and then nothing else to say
    return A.run([*out, A.history_entry(h, "v77", {"status": "F"}).withColumn("version", F.lit("v77"))])


@query("""
SELECT 'proven' AS audit, CAST(s_suppkey AS VARCHAR) AS what, CASE WHEN s_nationkey < 10 THEN 'is there' ELSE 'isn''t known' END AS detail FROM supplier WHERE s_nationkey < 10 OR s_nationkey >= 20
UNION ALL SELECT 'message', 'message', p FROM (VALUES ('small'), ('c2'), ('v9')) t(p) WHERE p <> 'c2'
UNION ALL SELECT 'locked', w, 'doesn''t hold' FROM (VALUES ('none'), ('wrong')) t(w)
UNION ALL SELECT 'tag', 'resolves', 'doesn''t hold' UNION ALL SELECT 'gone', w, 'doesn''t hold' FROM (VALUES ('annotated'), ('exists'), ('resolves')) t(w)
UNION ALL SELECT 'policy', 'default branch', 'doesn''t hold'
""")
def single_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absence proven by 404 alone, values that a message lacks, locked values, a tag's facts, a hosting policy."""
    k = F.col("s_nationkey")
    status = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("what"), F.when(k < 10, 200).when(k < 20, 404).alias("code"))
    message = spark.createDataFrame([("Release v1, definition c2",)], "text string")
    docs = spark.createDataFrame([("lock", '{"a": {"b": [1, "x"]}, "c": true}')], "name string, raw string")
    locked = {"right": ("lock", "$.a.b", [1, "x"]), "also": ("lock", "$.c", True), "wrong": ("lock", "$.c", 1), "none": ("nothing", "$.c", True)}
    tags = spark.createDataFrame([("t", "o", "c1")], "name string, object string, peeled string")
    repo = spark.createDataFrame([("PRIVATE", "trunk")], "visibility string, default_branch string")
    closed = A.invariants(repo, {"visibility": F.col("visibility") == "PRIVATE", "default branch": F.col("default_branch") == "main"})
    out = {"proven": A.proven_absent(status), "message": A.lacking_values(message, ["small", "c2", "v9"]), "locked": A.locked_values(docs, locked), "tag": A.tag_facts(tags, "t", "c2"), "gone": A.tag_facts(tags, "u", "c2"), "policy": closed}
    return A.run([df.select(F.lit(k).alias("audit"), "what", "detail") for k, df in out.items()])


# The composed runs and their reports


def _snapshot(spark: SparkSession, sf_dir: str) -> R.Snapshot:
    """Parts as documents (every tenth broken on purpose), the corpus as texts and blobs, customers as commits."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    raw = F.to_json(F.struct(k.alias("key"), F.col("p_brand").alias("brand"), F.when(k % 10 != 0, F.col("p_size")).alias("size")))
    docs = p.select(F.concat(F.lit("part-"), k).alias("name"), F.lit("part").alias("contract"), F.lit("p").alias("path"), raw.alias("raw"), (k % 10 != 0).alias("valid"))
    d = table(spark, sf_dir, "documents")
    texts = d.select(F.concat_ws("/", "source", F.concat("doc_id", F.lit(".md"))).alias("path"), F.col("text").alias("raw"))
    tags = spark.createDataFrame([("refs/tags/v1", "o1", "c149"), ("refs/tags/v0", "o0", "c3")], "name string, object string, peeled string")
    return R.Snapshot(
        documents=docs, texts=texts, files=texts.select("path", F.encode("raw", "UTF-8").alias("content")), paths=texts.select("path"), blobs=_blobs(spark, sf_dir).drop("doc_id"), commits=_commits(spark, sf_dir),
        local_tags=tags, remote_tags=tags, history=spark.createDataFrame([(0, "0", "o0"), (1, "1", "o1")], "n int, version string, tag_object string"),
        repo=spark.createDataFrame([("o/n", "private", "main", False)], "repository string, visibility string, default_branch string, has_wiki boolean"),
        status=spark.createDataFrame([("pages", 404)], "what string, code int"), runs=spark.createDataFrame([("run1",)], "id string"), tag_message=spark.createDataFrame([("definition c21",)], "text string"),
        capabilities=table(spark, sf_dir, "nation").select(F.col("n_name").alias("capability_id"), F.array(F.col("n_regionkey").cast("string")).alias("evaluation_id")),
        gates=table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("evaluation_id"), F.col("r_name").alias("metric")),
        manifest=spark.createDataFrame([("m", '{"release": {"tag": "v1"}}')], "name string, raw string"),
    )


def _policy(spark: SparkSession, sf_dir: str) -> R.Policy:
    broken = [r[0] for r in table(spark, sf_dir, "part").where("p_partkey % 10 = 0").select(F.concat(F.lit("part-"), "p_partkey")).collect()]  # the invalid examples, a short list
    shape = C.Record(fields={"key": C.Integer(0), "brand": C.Text(pattern="^Brand#"), "size": C.Integer(1)})
    return R.Policy(
        contracts={"part": shape}, reasons=dict.fromkeys(broken, "required size"), anchors=[("src1/1.md", "e"), ("src2/2.md", "no such text")], prohibited_keys=["self"], definition="c21", release="c149",
        repository="o/n", baseline={"0": {"tag_object": "o0"}, "1": {"tag_object": "o1"}}, tags={"refs/tags/v1": {"equal"}, "refs/tags/v9": {"absent"}}, message_parts=["c21", "v1"],
        roots=["part-1", "part-0"], locked={"first": ("part-1", "$.key", 1), "brand": ("part-2", "$.brand", "none")}, historical=("v0", "c3"),
        decisions="src3/", decision_count=1, decision_headings=["a"], trace="src1/1.md", trace_least=1, hashes={"src1/1.md": "0" * 64},
    )


@query("""
WITH n AS (SELECT count(*) FILTER (source = 'src3') AS records, count(*) FILTER (source = 'src3' AND NOT contains(text, 'a')) AS bare, bool_or(source || '/' || doc_id = 'src1/1' AND regexp_matches(text, '(^|\\n)\\| *[A-Z]+-?[0-9]')) AS rows,
  count(*) FILTER (regexp_matches(text, '(?i)\\b(TBD|TODO|FIXME)\\b')) AS marks, count(*) FILTER (regexp_matches(text, '\\[[^\\]]*\\]\\([^)]+\\)')) AS links,
  count(*) FILTER (regexp_matches(text, '-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----|\\b(ghp|github_pat)_[A-Za-z0-9_]{20,}|\\b(sk_live|sk-[A-Za-z0-9]{20,})')) AS secrets FROM documents)
SELECT name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM n, LATERAL (VALUES ('contract inventory', true), ('valid documents', (SELECT min(p_size) >= 1 FROM part WHERE p_partkey % 10 <> 0)), ('every contract has a valid document', true),
  ('invalid inventory', true), ('invalid documents fail', true), ('invalid documents fail as intended', true), ('anchors', false), ('root documents', false), ('locked values', false),
  ('decision records', records = 1), ('decision headings', bare = 0), ('decisions are traced', records = 0), ('trace rows', rows), ('trace cells', NOT rows), ('ledger', true), ('self-reference', true),
  ('definition binding', true), ('document hashes', false), ('capability gates', true), ('gate fields', true), ('open marks', marks = 0), ('links', links = 0), ('forbidden paths', true), ('secrets', secrets = 0), ('release commit', true), ('historical tag', true)) t(name, ok)
""")
def offline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.validate(_snapshot(spark, sf_dir), _policy(spark, sf_dir)).select("name", "status")


@query("""
SELECT * FROM (VALUES ('remote', 1, 'origin', 'PASS'), ('remote', 2, 'hosting policy', 'PASS'), ('remote', 3, 'pages', 'PASS'), ('remote', 4, 'workflows', 'FAIL'), ('remote', 5, 'tags', 'PASS'), ('remote', 6, 'main is reached', 'PASS'),
  ('release', 1, 'tag', 'PASS'), ('release', 2, 'local and remote tag', 'PASS'), ('release', 3, 'definition binding', 'PASS'), ('release', 4, 'document hashes', 'FAIL'), ('release', 5, 'tagged manifest', 'PASS'), ('release', 6, 'ledger', 'PASS'), ('release', 7, 'tag message', 'FAIL')) t(run, n, name, status)
""")
def remote_and_release_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, p = _snapshot(spark, sf_dir), _policy(spark, sf_dir)
    runs = {"remote": R.audit_remote(s, p), "release": R.audit_release(s, p, "v1")}
    return A.run([df.select(F.lit(k).alias("run"), "n", "name", "status") for k, df in runs.items()])


@query("""
SELECT * FROM (VALUES ('line', 'PASS: origin: o/n'), ('line', 'PASS: hosting policy: closed'), ('line', 'PASS: pages: absent'), ('line', 'FAIL: workflows: 1 failed, first: run1: ran'), ('line', 'PASS: tags: as allowed'), ('line', 'PASS: main is reached: yes'),
  ('first failure', 'workflows'), ('exit code', '1'), ('report', '# Audit'), ('report', 'Result: FAIL (6 checks, 1 failed)'), ('report', '- tag: v1'), ('report', '| check | status | detail |'), ('report', '|---|---|---|'),
  ('report', '| origin | PASS | o/n |'), ('report', '| hosting policy | PASS | closed |'), ('report', '| pages | PASS | absent |'), ('report', '| workflows | FAIL | 1 failed, first: run1: ran |'), ('report', '| tags | PASS | as allowed |'), ('report', '| main is reached | PASS | yes |')) t(kind, value)
""")
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Console lines, first failure and exit code of a run, and its Markdown report as it was written."""
    rows = R.audit_remote(_snapshot(spark, sf_dir), _policy(spark, sf_dir)).collect()  # a row for each check
    checks = spark.createDataFrame(rows, "n int, name string, status string, detail string")
    said = [("line", x) for x in reports.lines(checks)] + [("first failure", reports.first_failure(checks).first()["name"]), ("exit code", str(reports.exit_code(checks)))]
    at = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    reports.write_markdown(checks, at, "Audit", {"tag": "v1"})
    written = spark.read.text(at).where("value <> ''").select(F.lit("report").alias("kind"), "value")
    return spark.createDataFrame(said, "kind string, value string").unionByName(written)

"""Queries that apply the operators to the test tables by analogy (events as agent events, conversations as session turns,
documents as samples, labels as adjudicated outcomes, embeddings as persona vectors), and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.operators import audits, contracts, events, governance, memory, metrics
from quillgate.operators.contracts import child, keys, type_of
from quillgate.sources.documents import hashed
from quillgate.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def vector(c: Column | str) -> Column:
    return F.transform(c, lambda x: x.cast("double"))


# Contracts


@query("""
WITH e AS (SELECT *, CAST(props->>'k' AS BIGINT) AS k FROM events)
SELECT 'event_id.required' AS rule_id, count(*) FILTER (event_id IS NULL) AS violations FROM e
UNION ALL SELECT 'event_type.enum', count(*) FILTER (event_type NOT IN ('click', 'purchase', 'signup', 'view')) FROM e
UNION ALL SELECT 'value.minimum', count(*) FILTER (value < 0) FROM e
UNION ALL SELECT 'props.type', count(*) FILTER (json_type(props) <> 'OBJECT') FROM e
UNION ALL SELECT 'props.required k', count(*) FILTER (NOT list_contains(json_keys(props), 'k')) FROM e
UNION ALL SELECT 'props.additionalProperties', count(*) FILTER (len(json_keys(props)) > 1) FROM e
UNION ALL SELECT 'props.k.type', count(*) FILTER (json_type(props, '$.k') NOT IN ('BIGINT', 'UBIGINT')) FROM e
UNION ALL SELECT 'props.k.maximum', count(*) FILTER (k > 90) FROM e
""")
def contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.try_parse_json("props").alias("doc"))
    shape = contracts.Record(fields={"k": contracts.Integer(most=90)})
    own = [("event_id.required", F.col("event_id").isNull()), ("event_type.enum", ~F.col("event_type").isin("click", "purchase", "signup", "view")), ("value.minimum", F.col("value") < 0)]
    return contracts.rule_counts(e, own + [(f"props.{r}", bad) for r, bad in contracts.rules(shape, F.col("doc"))]).drop("n")


@query("""
SELECT 'if returned: finished' AS rule_id, count(*) FILTER (l_returnflag = 'R' AND l_linestatus <> 'F') AS violations FROM lineitem
UNION ALL SELECT 'if open: taxed', count(*) FILTER (l_linestatus = 'O' AND l_tax = 0) FROM lineitem
UNION ALL SELECT 'if none: discount at most 0.08', count(*) FILTER (l_returnflag = 'N' AND l_discount > 0.08) FROM lineitem
""")
def contract_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as documents, whose conditions are rules of their contract."""
    rules = (contracts.When("flag", "R", then={"status": contracts.Const(value="F")}), contracts.When("status", "O", then={"tax": contracts.Number(above=0)}), contracts.When("flag", "N", then={"discount": contracts.Number(most=0.08)}))
    shape = contracts.Record(fields={"flag": contracts.Text(), "status": contracts.Text(), "tax": contracts.Number(), "discount": contracts.Number()}, rules=rules)
    doc = F.to_json(F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_tax").alias("tax"), F.col("l_discount").alias("discount")))
    rows = contracts.parsed(table(spark, sf_dir, "lineitem").select(doc.alias("raw")))
    names = {"if flag=R: status.const": "if returned: finished", "if status=O: tax.exclusiveMinimum": "if open: taxed", "if flag=N: discount.maximum": "if none: discount at most 0.08"}
    return contracts.rule_counts(rows, [(names[r], bad) for r, bad in contracts.rules(shape, F.col("doc")) if r in names]).drop("n")


@query("""
SELECT CASE WHEN try_cast(props AS JSON) IS NULL THEN 'malformed' WHEN NOT list_contains(json_keys(props), 'k') THEN 'absent'
  WHEN json_type(props, '$.k') = 'NULL' THEN 'null' WHEN json_type(props, '$.k') IN ('BIGINT', 'UBIGINT') THEN 'integer' ELSE 'other' END AS k,
  len(json_keys(props)) > 1 AS unknown_keys, count(*) AS n FROM events GROUP BY ALL
""")
def contract_props_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc")
    t = type_of(child(doc, "k"))
    k = F.when(doc.isNull(), "malformed").when(t.isNull(), "absent").when(t == "VOID", "null").when(t == "INTEGER", "integer").otherwise("other")
    unknown = F.size(F.array_except(keys(doc), F.array(F.lit("k")))) > 0
    return table(spark, sf_dir, "events").select(F.try_parse_json("props").alias("doc")).groupBy(k.alias("k"), unknown.alias("unknown_keys")).agg(F.count("*").alias("n"))


# Inventories, keys, hashes, scans


@query("""
SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'unexpected' END AS side, count(*) AS n
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR d.doc_id IS NULL GROUP BY ALL
""")
def inventory_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels against the inventory of documents."""
    found = audits.set_difference(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")
    return found.groupBy(F.col("detail").alias("side")).agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, x = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels")
    found = audits.without_match(d, x, "doc_id").select(F.col("what").cast("long").alias("doc_id"))
    return d.join(found, "doc_id").groupBy("source").agg(F.count("*").alias("n"))


FOREIGN_KEYS = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels", "doc_id", "documents", "doc_id")]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}.{k}' AS key, (SELECT count(*) FROM {c} WHERE {k} NOT IN (SELECT {r} FROM {p})) AS orphans, (SELECT count(*) FROM {p} WHERE {r} NOT IN (SELECT {k} FROM {c})) AS childless"
        for c, k, p, r in FOREIGN_KEYS
    )
)
def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for c, k, p, r in FOREIGN_KEYS:
        # both directions from one co-partitioned outer join of counts by key
        a = table(spark, sf_dir, c).groupBy(F.col(k).alias("key_value")).agg(F.count("*").alias("c"))
        b = table(spark, sf_dir, p).groupBy(F.col(r).alias("key_value")).agg(F.count("*").alias("p"))
        x = a.join(b, "key_value", "full_outer").agg(F.coalesce(F.sum(F.when(F.col("p").isNull(), F.col("c"))), F.lit(0)).alias("orphans"), F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("p"))), F.lit(0)).alias("childless"))
        out.append(x.select(F.lit(f"{c}.{k}").alias("key"), "orphans", "childless"))
    return audits.run(out)


REQUIRED = {"lineitem": {"l_orderkey": 0, "l_linenumber": 0, "l_quantity": 0, "l_discount": 0, "l_tax": 0, "l_returnflag": "''"}, "documents": {"text": "''", "lang": "''", "source": "''", "n_chars": 0}, "labels": {"quality": 0, "toxic": 0}}


@query(" UNION ALL ".join(f"SELECT '{t}.{c}' AS field, count(*) FILTER (coalesce({c} = {empty}, true)) AS missing, count(*) AS n FROM {t}" for t, cols in REQUIRED.items() for c, empty in cols.items()))
def required_fields_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = []
    for t, cols in REQUIRED.items():
        df = table(spark, sf_dir, t)
        kinds = dict(df.dtypes)
        missing = contracts.rule_counts(df, [(f"{t}.{c}", audits.falsy(F.col(c), kinds[c])) for c in cols])
        out.append(missing.select(F.col("rule_id").alias("field"), F.col("violations").alias("missing"), "n"))
    return audits.run(out)


SCANS = {"e-mail": r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z]+", "hex": r"[0-9a-f]{32}", "licence": r"[Ll]icen[cs]e", "live key": r"sk-[A-Za-z0-9]{20}"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS label, count(*) FILTER (regexp_matches(text, '{p}') AND octet_length(encode(text)) <= 2000000) AS documents FROM documents" for k, p in SCANS.items()))
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))
    found = audits.secrets(files, SCANS).groupBy(F.col("detail").alias("label")).agg(F.count("*").alias("n"))
    return audits.values(spark, list(SCANS), "label").join(found, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("documents"))


HREF = r'href="([^"]*)"'


@query(r"""
WITH l AS (SELECT page_id, regexp_replace(unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)), '#.*$', '') AS target FROM pages)
SELECT page_id, count(*) AS links, count(DISTINCT target) AS targets FROM l
WHERE target <> '' AND NOT regexp_matches(target, '^([A-Za-z][A-Za-z0-9+.-]*:|//)') GROUP BY page_id
""")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "pages").select(F.col("page_id").alias("path"), F.col("html").alias("raw"))
    return audits.links(texts, HREF).groupBy(F.col("path").alias("page_id")).agg(F.count("*").alias("links"), F.countDistinct("target").alias("targets"))


@query("SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = hashed(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", F.col("sha256").alias("hash"))
    return d.groupBy("hash").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def benchmark_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A passage's inner words stand alone in any document that holds the passage, so candidates come from an equi-join on the
    inner word that fewest documents have; passages without an inner word (one or two words) are looked for in all texts."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").where("text is not null")
    inner = F.expr(r"filter(slice(split(text, '\\s+'), 2, greatest(size(split(text, '\\s+')) - 2, 0)), x -> x <> '')")
    each = items.select("item_id", F.explode(F.array_distinct(inner)).alias("word"))
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word")).join(each.select("word").distinct(), "word", "left_semi")
    held = each.join(words.groupBy("word").agg(F.count("*").alias("n")), "word", "left")  # a word that no document has: nor the passage
    anchor = held.groupBy("item_id").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))
    near = words.join(anchor, "word").select("doc_id", "item_id")
    rest = docs.join(items.join(anchor, "item_id", "left_anti").select("item_id", F.col("text").alias("passage")), F.contains("text", "passage")).select("doc_id", "item_id")
    both = near.join(docs, "doc_id").join(items.select("item_id", F.col("text").alias("passage")), "item_id")
    return both.where(F.contains("text", "passage")).select("doc_id", "item_id").unionByName(rest)


# Streams and sessions


@query("""
SELECT conv_id, count(*) AS n, min(turn) AS first, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) - count(DISTINCT turn) AS duplicates
FROM conversations GROUP BY conv_id
""")
def conversation_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.sequence_summary(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query("""
SELECT conv_id, word, regexp_matches(word, '^(ua)*u?$') AS valid FROM (
  SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' WHEN 'system' THEN 's' ELSE '?' END, '' ORDER BY turn) AS word
  FROM conversations GROUP BY conv_id)
""")
def role_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    code = F.when(role == "user", "u").when(role == "assistant", "a").when(role == "system", "s")
    return events.grammar(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], code, "^(ua)*u?$")


@query("""
WITH e AS (SELECT *, coalesce(CAST(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) >= 86400000000 AS INTEGER), 1) AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM e)
SELECT user_id, CAST(session AS BIGINT) AS session, min(event_id) AS first_event, count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM s GROUP BY user_id, session
""")
def event_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    s = events.gap_sessions(e, "user_id", "ts", 86_400)
    first = s.join(e.select("user_id", F.col("ts").alias("start"), "event_id"), ["user_id", "start"]).groupBy("user_id", "session", "start", "end", "n").agg(F.min("event_id").alias("first_event"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return first.select("user_id", F.col("session").cast("long").alias("session"), "first_event", "n", (us("end") - us("start")).alias("us"))


@query("""
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts, event_id) = 1
""")
def event_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return events.first_per_key(e, ["user_id", "event_type", F.date_trunc("hour", "ts")], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("""
SELECT p.event_id, p.user_id, coalesce((SELECT s.event_id FROM events s WHERE s.event_type = 'signup' AND s.user_id = p.user_id AND s.ts <= p.ts ORDER BY s.ts DESC, s.event_id DESC LIMIT 1), -1) AS grant_id
FROM events p WHERE p.event_type = 'purchase'
""")
def asof_grant(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    found = events.asof(e.where("event_type = 'purchase'"), e.where("event_type = 'signup'"), "user_id", "ts", "ts", ["event_id"], "event_id")
    return found.select("event_id", "user_id", F.coalesce("asof_event_id", F.lit(-1)).alias("grant_id"))


@query("""
SELECT a.user_id, a.event_id AS first_id, b.event_id AS then_id, epoch_us(b.ts) - epoch_us(a.ts) AS us FROM events a JOIN events b
ON a.user_id = b.user_id AND a.event_type = 'error' AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR
""")
def purchase_after_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    return events.followed_by(e, "user_id", "ts", kind == "error", kind == "purchase", 3600, "event_id")


@query("""
WITH g AS (SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS us FROM events)
SELECT event_type, count(us) AS n, round(quantile_cont(us, 0.95), 3) AS p95_us FROM g GROUP BY event_type
""")
def p95_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("before", F.lag("ts").over(w))
    return metrics.latency(e, "before", "ts", ["event_type"]).select("event_type", "n", F.round("quantile_us", 3).alias("p95_us"))


@query("""
WITH w AS (SELECT event_id, user_id, max(event_id % 97) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
  event_id % 97 AS seq, row_number() OVER (PARTITION BY user_id, event_id % 97 ORDER BY ts, event_id) AS nth FROM events)
SELECT CASE WHEN seq <= top - 32 THEN 'out of window' WHEN nth > 1 THEN 'duplicate' ELSE 'accepted' END AS verdict, count(*) AS n FROM w GROUP BY ALL
""")
def replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_id") % 97).alias("seq"))
    return events.replay_window(e, "user_id", "seq", ["ts", "event_id"], 32).groupBy("verdict").agg(F.count("*").alias("n"))


# Governance


@query("""
SELECT source, CASE WHEN ('0x' || substr(sha256(source), 1, 4))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n, 0 AS leaks
FROM documents GROUP BY ALL
""")
def source_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = governance.split(table(spark, sf_dir, "documents").select("source"), "source")
    per = rows.groupBy("source", "split").agg(F.count("*").alias("n"))
    leak = governance.leaks(rows, ["source"]).agg(F.count("*").cast("int").alias("leaks"))
    return per.crossJoin(F.broadcast(leak))


@query("""
SELECT source, CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 AND lang IN ('en', 'de', 'fr') THEN 'accepted' ELSE 'quarantine' END AS route, count(*) AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL
""")
def rights_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rights = F.when(F.col("lang").isin("en", "de", "fr"), "licensed").otherwise("unknown")
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "accepted").otherwise("quarantine")
    return governance.routed(d.withColumns({"rights_status": rights, "status": status})).groupBy("source", "route").agg(F.count("*").alias("n"))


@query("""
SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS total, round(sum(n_chars * coalesce(quality, 0) * (1 - coalesce(toxic, 1))), 3) AS effective
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, source
""")
def effective_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    v = governance.effective_volume(d, ["lang", "source"], "n_chars", [F.col("quality"), 1 - F.col("toxic")])
    return v.withColumn("effective", F.round("effective", 3))


# Metrics and gates

WILSON = "((hits::DOUBLE / n + 3.8414588206941236 / (2 * n)) - 1.959963984540054 * sqrt(hits::DOUBLE / n * (1 - hits::DOUBLE / n) / n + 3.8414588206941236 / (4.0 * n * n))) / (1 + 3.8414588206941236 / n)"


@query(f"""
WITH g AS (SELECT source, count(*) AS n, CAST(sum(quality) AS BIGINT) AS hits FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT source, n, hits, round({WILSON}, 9) AS lower, {WILSON} >= 0.7 AS passed FROM g
""")
def wilson_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return metrics.rate(d, F.col("quality") == 1, ["source"]).select("source", "n", "hits", F.round("lower", 9).alias("lower"), (F.col("lower") >= 0.7).alias("passed"))


@query("""
WITH g AS (SELECT lang, count(*) AS n, CAST(sum(quality) AS BIGINT) AS hits FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), ()))
SELECT coalesce(lang, 'all') AS stratum, n, hits, round(hits / n, 9) AS rate, hits / n >= 0.82 AS passed, (SELECT bool_and(hits / n >= 0.82) FROM g) AS gate FROM g
""")
def stratified_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    g = metrics.stratified(d, F.col("quality") == 1, "lang", 0.82)
    return g.select(F.coalesce("lang", F.lit("all")).alias("stratum"), "n", "hits", F.round("rate", 9).alias("rate"), "passed", "gate")


@query("""
WITH g AS (SELECT source, lang, avg(quality) >= 0.8 AS passed FROM documents JOIN labels USING (doc_id) GROUP BY source, lang)
SELECT source, count(*) AS gates, bool_and(passed) AS passed FROM g GROUP BY source
""")
def gate_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as capabilities, whose gates are the quality rates of their languages."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    gate = F.concat_ws("/", "source", "lang").alias("evaluation_id")
    measured = d.groupBy("source", gate).agg(F.avg("quality").alias("value"), F.count("*").alias("n"))
    gates = measured.select("evaluation_id", F.lit("gte").alias("operator"), F.lit(0.8).alias("threshold"), F.lit(1).alias("sample_count"))
    table_of = measured.groupBy("source").agg(F.collect_set("evaluation_id").alias("evaluation_id"))
    return metrics.capabilities(table_of, metrics.gate_results(measured.drop("source"), gates), "source")


COS = "list_inner_product(a, b) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b)))"
DOUBLES = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


@query(f"""
WITH v AS (SELECT vec_id, label, {DOUBLES} AS a FROM embeddings),
c AS (SELECT label, list(m ORDER BY i) AS b FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM v) GROUP BY label, i) GROUP BY label)
SELECT vec_id, label, round({COS}, 6) AS cosine, CASE WHEN label = 3 THEN 'hard' WHEN {COS} > 0 THEN 'kept' ELSE 'cosine' END AS stage FROM v JOIN c USING (label)
""")
def persona_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", vector("embedding").alias("a"))
    part = v.select("label", F.posexplode("a").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centre = part.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("b"))
    out = metrics.persona_filter(v.join(centre, "label"), F.col("label") == 3, "a", "b")
    return out.select("vec_id", "label", F.round("cosine", 6).alias("cosine"), "stage")


@query(f"""
WITH v AS (SELECT vec_id, label, {DOUBLES} AS a FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, q.label, round(list_inner_product(q.a, c.a) / (sqrt(list_inner_product(q.a, q.a)) * sqrt(list_inner_product(c.a, c.a))), 9) AS score
  FROM v q JOIN v c ON q.label = c.label AND q.vec_id <> c.vec_id WHERE q.vec_id % 10 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s),
per AS (SELECT query_id, label, avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END) AS r FROM r WHERE id % 4 = 0 GROUP BY query_id, label)
SELECT count(*) AS queries, round(avg(r), 6) AS recall FROM per
""")
def recall_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the neighbours with an id divisible by 4, within the label as namespace."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("v"))
    asked = v.where(F.col("id") % 10 == 0)
    found = metrics.top_neighbours(asked, v, 10, ("label",))
    return metrics.recall_of(found, asked, v, F.col("id") % 4 == 0, ("label",)).select("queries", F.round("recall", 6).alias("recall"))


@query("""
WITH t AS (SELECT item_id, regexp_replace(text, '[^ -~]', '', 'g') AS said FROM benchmark),
p AS (SELECT a.item_id % 4 AS stratum, levenshtein(a.said, b.said) AS e, length(a.said) AS n FROM t a JOIN t b ON b.item_id = a.item_id + 1)
SELECT coalesce(CAST(stratum AS VARCHAR), 'all') AS stratum, CAST(sum(e) AS BIGINT) AS errors, CAST(sum(n) AS BIGINT) AS length, round(sum(e) / sum(n), 9) AS rate FROM p GROUP BY GROUPING SETS ((stratum), ())
""")
def corpus_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring passages, ASCII alone (the SQL engine counts bytes), as reference and transcript."""
    t = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_replace("text", "[^ -~]", "").alias("reference"))
    pairs = t.join(t.select((F.col("item_id") - 1).alias("item_id"), F.col("reference").alias("said")), "item_id").withColumn("stratum", F.col("item_id") % 4)
    r = metrics.error_rate(pairs, ["stratum"], strata=True)
    return r.select(F.coalesce(F.col("stratum").cast("string"), F.lit("all")).alias("stratum"), "errors", "length", F.round("rate", 9).alias("rate"))


@query("""
WITH l AS (SELECT doc_id, quality AS x, CASE WHEN toxic = 1 THEN 0 ELSE 1 END AS y FROM labels),
n AS (SELECT count(*) AS n, avg(CASE WHEN x = y THEN 1.0 ELSE 0 END) AS o FROM l),
e AS (SELECT sum(a.c * b.c) AS xy FROM (SELECT x, count(*) AS c FROM l GROUP BY x) a JOIN (SELECT y, count(*) AS c FROM l GROUP BY y) b ON a.x = b.y)
SELECT n, round(o, 9) AS observed, round(xy::DOUBLE / (n * n), 9) AS expected, round((o - xy::DOUBLE / (n * n)) / (1 - xy::DOUBLE / (n * n)), 9) AS kappa FROM n, e
""")
def annotator_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "labels").select(F.col("quality").alias("a"), (F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("b"))
    return metrics.agreement(x, "a", "b").select("n", *[F.round(c, 9).alias(c) for c in ("observed", "expected", "kappa")])


@query("""
WITH c AS (SELECT o_orderpriority AS actual, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS hit FROM orders GROUP BY 1)
SELECT round(avg(hit / n), 9) AS macro, bool_and(NOT (actual = '1-URGENT' AND hit / n < 0.4)) AS critical_pass FROM c
""")
def macro_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order counts as told rightly if it is finished; urgent is the critical class."""
    o = table(spark, sf_dir, "orders").withColumn("told", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("none"))
    m = metrics.macro_accuracy(metrics.confusion(o, "o_orderpriority", "told"), ["1-URGENT"], 0.4)
    return m.select(F.round("macro", 9).alias("macro"), "critical_pass")


@query("""
WITH g AS (SELECT source, doc_id % 2 AS release, avg(quality) >= 0.8 AS passed FROM documents JOIN labels USING (doc_id) GROUP BY ALL),
x AS (SELECT coalesce(n.passed, false) AS passed, coalesce(b.passed, false) AS was, coalesce(n.source, b.source) AS source FROM (SELECT * FROM g WHERE release = 1) n FULL JOIN (SELECT * FROM g WHERE release = 0) b USING (source))
SELECT count(*) FILTER (NOT passed) = 0 AND count(*) FILTER (NOT passed AND was) = 0 AND count(*) FILTER (NOT passed AND source = 'src0') = 0 AS promoted,
  count(*) FILTER (NOT passed) AS failed, count(*) FILTER (NOT passed AND was) AS regressed, count(*) FILTER (NOT passed AND source = 'src0') AS hard_failed FROM x
""")
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of even ids as the last release, of odd ids as this one; sources as gates."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    g = d.groupBy(F.col("source").alias("evaluation_id"), (F.col("doc_id") % 2).alias("release")).agg((F.avg("quality") >= 0.8).alias("passed"))
    return metrics.promotion(g.where("release = 1"), g.where("release = 0"), ["src0"])


# Memory and lineage


@query("""
WITH RECURSIVE up AS (
  SELECT c_custkey AS node, c_custkey // 7 AS ancestor, 1 AS depth FROM customer WHERE c_custkey > 0
  UNION ALL SELECT node, ancestor // 7, depth + 1 FROM up WHERE ancestor > 0)
SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY node, ancestor
""")
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as derived samples, whose parent is the seventh of their number."""
    c = table(spark, sf_dir, "customer").where("c_custkey > 0").select(F.col("c_custkey").alias("child"), F.floor(F.col("c_custkey") / 7).alias("parent"))
    return memory.reachable(c)


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND CAST(props->>'k' AS BIGINT) >= 30
""")
def memory_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type; one with k under 30 is a deletion."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return memory.latest(e, ["user_id", "event_type"], ["ts", "event_id"], F.col("k") < 30).select("user_id", "event_type", "event_id", "value")


OPERATION = {"signup": "create", "view": "replace", "click": "replace", "error": "delete", "purchase": "restore"}
OPS = """
ops AS (SELECT event_id, user_id, CASE event_type WHEN 'signup' THEN 'create' WHEN 'view' THEN 'replace' WHEN 'click' THEN 'replace' WHEN 'error' THEN 'delete' ELSE 'restore' END AS op, value FROM events),
s AS (SELECT *, row_number() OVER w AS revision, last_value(CASE WHEN op IN ('create', 'replace') THEN value END IGNORE NULLS) OVER w AS v FROM ops
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query(f"""
WITH {OPS}, last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) = 1)
SELECT user_id AS memory_id, revision, v AS value FROM last WHERE op <> 'delete'
""")
def memory_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, replace, delete and restore from event types, one memory for each user."""
    return memory.fold(_operations(spark, sf_dir)).select("memory_id", F.col("revision").cast("long").alias("revision"), "value")


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.create_map(*[F.lit(x) for kv in OPERATION.items() for x in kv])[F.col("event_type")]
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("commit_seq"), F.lit(0).alias("op_index"), F.lit("n").alias("namespace_id"), F.col("user_id").alias("memory_id"), op.alias("operation"), "value", F.get_json_object("props", "$.k").cast("int").alias("expected_revision"))


@query(f"""
WITH {OPS} SELECT s.event_id AS commit_seq, s.user_id AS memory_id, revision - 1 AS met, CAST(e.props->>'k' AS INTEGER) AS expected
FROM s JOIN events e USING (event_id) WHERE coalesce(CAST(e.props->>'k' AS INTEGER), 0) <> revision - 1
""")
def revision_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = memory.conflicts(_operations(spark, sf_dir))
    return c.select("commit_seq", "memory_id", F.col("met").cast("long").alias("met"), F.col("expected_revision").alias("expected"))


@query("""
WITH r AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 ELSE 7 END AS rank, CAST(props->>'k' AS BIGINT) // 25 AS v FROM events),
b AS (SELECT user_id, rank, min(v) AS lo, max(v) AS hi FROM r GROUP BY user_id, rank)
SELECT user_id, rank, CASE WHEN lo = hi THEN lo ELSE -1 END AS value, lo <> hi AS unresolved FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank) = 1
""")
def trust_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for kv in {"purchase": "user_correction", "signup": "user_statement", "click": "tool_observation"}.items() for x in kv])[F.col("event_type")]
    e = table(spark, sf_dir, "events").select("user_id", kind.alias("kind"), F.floor(F.get_json_object("props", "$.k").cast("long") / 25).alias("value"))
    return memory.most_trusted(e, ["user_id"], "kind", "value").withColumn("value", F.coalesce("value", F.lit(-1)))



"""Queries of metrics, event, memory and governance semantics on the test tables by analogy, and the same in DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.functions.statistics import Z95
from quillgate.operators import events, governance, memory, metrics
from quillgate.registry import OPS, WILSON, _operations, query
from quillgate.streaming import sessions
from quillgate.tables import shared_dir, table

# Metrics and gates


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id")


@query("""
WITH t AS (SELECT item_id % 4 AS stratum, item_id % 3 AS k, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS n FROM benchmark WHERE text IS NOT NULL)
SELECT stratum, CAST(sum(CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END) AS BIGINT) AS errors, CAST(sum(n) AS BIGINT) AS length FROM t GROUP BY stratum
""")
def corpus_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole passages against themselves, with one or two words more: word errors."""
    t, k = table(spark, sf_dir, "benchmark").where("text is not null"), F.col("item_id") % 3
    said = F.when(k == 0, F.col("text")).when(k == 1, F.concat("text", F.lit(" qqq"))).otherwise(F.concat(F.lit("qqq "), "text", F.lit(" zzz")))
    rows = t.select((F.col("item_id") % 4).alias("stratum"), F.col("text").alias("reference"), said.alias("said"))
    return metrics.error_rate(rows, ["stratum"], words=True).select("stratum", "errors", "length")


@query("SELECT round(sum(quality) / count(*), 9) AS rate, true AS inside, true AS narrow FROM labels")
def bootstrap_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Poisson bootstrap around a rate; its draws are beyond SQL, that its bounds enclose the rate closely isn't."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("top"), F.lit(1).alias("bottom"))
    b = metrics.bootstrap(rows, "top", "bottom", "doc_id")
    return b.select(F.round("rate", 9).alias("rate"), F.col("rate").between(F.col("lower"), F.col("upper")).alias("inside"), (F.col("upper") - F.col("lower") < 0.25).alias("narrow"))


@query(f"""
WITH d AS (SELECT (doc_id % 7) / 7.0 - (doc_id % 5) / 5.0 AS d FROM documents WHERE doc_id % 3 <> 0)
SELECT count(*) AS n, round(avg(d), 9) AS delta, round(avg(d) + {Z95} * stddev_samp(d) / sqrt(count(*)), 9) AS bound FROM d
""")
def paired_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    base, candidate = d.select(i, ((i % 5) / 5).alias("v")), d.where(i % 3 != 0).select(i, ((i % 7) / 7).alias("v"))
    p = metrics.paired_delta(base, candidate, "doc_id", "v")
    return p.select("n", F.round("delta", 9).alias("delta"), F.round("bound", 9).alias("bound"))


@query(f"""
WITH g AS (SELECT lang, count(*) AS n, CAST(count(*) FILTER (doc_id % 10 <> 0 AND (doc_id % 4 <> 0 OR doc_id % 3 = 0)) AS BIGINT) AS hits FROM documents GROUP BY lang)
SELECT lang, n, hits, round(hits / n, 9) AS rate, round({WILSON}, 9) AS lower FROM g
""")
def token_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often what was written is what was meant, by language, with Wilson's bound."""
    i = F.col("doc_id")
    wrong = (i % 10 == 0) | ((i % 4 == 0) & (i % 3 != 0))
    rows = table(spark, sf_dir, "documents").select("lang", F.col("source").alias("meant"), F.when(wrong, "other").otherwise(F.col("source")).alias("written"))
    return metrics.rate(rows, F.col("meant") == F.col("written"), ["lang"]).select("lang", "n", "hits", F.round("rate", 9).alias("rate"), F.round("lower", 9).alias("lower"))


@query("""
WITH a AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 1 WHEN quality = toxic THEN quality END AS label FROM labels)
SELECT count(*) AS n, count(*) FILTER (label = 1) AS hits, count(*) FILTER (label IS NULL) AS unresolved FROM a
""")
def adjudicated_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "labels").withColumn("judge", F.when(F.col("doc_id") % 3 == 0, 1))
    x = x.select(metrics.adjudicated(x, "quality", "toxic", "judge").alias("label"))
    r = metrics.rate(x, F.col("label") == 1).select("n", "hits")
    return r.crossJoin(x.agg(F.count_if(F.col("label").isNull()).alias("unresolved")))


GATE_OPERATOR = "CASE CAST(substr(source, 4) AS INTEGER) % 4 WHEN 0 THEN 'gte' WHEN 1 THEN 'lte' WHEN 2 THEN 'eq' ELSE 'non_inferior' END"


@query(f"""
WITH m AS (SELECT source, avg(quality) AS v, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source),
g AS (SELECT source, {GATE_OPERATOR} AS o FROM (SELECT DISTINCT source FROM documents)),
r AS (SELECT source, coalesce(n >= 10 AND CASE o WHEN 'gte' THEN v >= 0.8 WHEN 'lte' THEN v <= 0.8 WHEN 'eq' THEN v = 0.8 ELSE v >= -0.8 END, false) AS passed FROM g LEFT JOIN m USING (source))
SELECT source AS evaluation_id, passed AND (source <> 'src3' OR (SELECT passed FROM r WHERE source = 'src0')) AS passed FROM r
""")
def dependent_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as gates of four kinds, of which one counts only if another has passed."""
    d = table(spark, sf_dir, "documents")
    gates = d.select("source").distinct().select(F.col("source").alias("evaluation_id"), F.expr(GATE_OPERATOR).alias("operator"), F.lit(0.8).alias("threshold"), F.lit(10).alias("sample_count"))
    measured = _judged(spark, sf_dir).groupBy(F.col("source").alias("evaluation_id")).agg(F.avg("quality").alias("value"), F.count("*").alias("n"))
    return metrics.dependent(metrics.gate_results(measured, gates), "src3", "src0").select("evaluation_id", "passed")


@query(f"""
WITH p AS (SELECT lang, count(*) AS n, sum(quality) AS h FROM documents JOIN labels USING (doc_id) GROUP BY lang),
g AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(h) AS BIGINT) AS hits, count(*) FILTER (h / n < 0.79) AS collapsed FROM p)
SELECT n, hits, collapsed, round({WILSON}, 9) AS lower, {WILSON} >= 0.6 AND collapsed = 0 AS passed FROM g
""")
def preference_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.preference(_judged(spark, sf_dir), F.col("quality") == 1, "lang", 0.6, 0.79).withColumn("lower", F.round("lower", 9))


@query(f"""
WITH s AS (SELECT 3 + doc_id % 3 AS s, (doc_id % 7) / 7.0 - (doc_id % 5) / 5.0 AS d FROM documents),
g AS (SELECT count(*) AS n, avg(s) AS mean, avg(s) - {Z95} * stddev_samp(s) / sqrt(count(*)) AS lower, avg(d) - {Z95} * stddev_samp(d) / sqrt(count(*)) AS t FROM s)
SELECT n, round(mean, 9) AS mean, round(lower, 9) AS lower, round(t, 9) AS timbre_lower, lower >= 3.8 AND t >= -0.1 AS passed FROM g
""")
def naturalness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    own = d.select(i, (3 + i % 3).alias("score"), ((i % 7) / 7).alias("timbre"))
    out = metrics.naturalness(own, d.select(i, ((i % 5) / 5).alias("timbre")), "doc_id", "score", "timbre", 3.8, 0.1)
    return out.select("n", *[F.round(c, 9).alias(c) for c in ("mean", "lower", "timbre_lower")], "passed")


@query(f"""
WITH g AS (SELECT count(*) AS n, count(*) FILTER (event_type <> 'error') AS hits, count(*) FILTER (event_type = 'error' AND (event_id % 97 >= 80 OR event_id % 89 >= 80)) AS unexplained FROM events)
SELECT n, hits, round({WILSON}, 9) AS lower, unexplained, {WILSON} >= 0.75 AND unexplained = 0 AS passed FROM g
""")
def tool_completion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    calls = table(spark, sf_dir, "events").select(i.alias("id"), "event_type", F.array(i % 97, i % 89).alias("evidence"))
    known = table(spark, sf_dir, "part").where("p_partkey < 80").select(F.col("p_partkey").alias("evidence_id"))
    return metrics.tool_completion(calls, known, F.col("event_type") != "error", 0.75).withColumn("lower", F.round("lower", 9))


@query("""
WITH o AS (SELECT l_orderkey, bool_and(l_partkey % 50 <> 0) AS ok FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS n, count(*) FILTER (ok) AS covered, round(count(*) FILTER (ok) / count(*), 9) AS coverage FROM o
""")
def provenance_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records, whose line items' parts are evidence; some parts are unknown."""
    o = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("evidence"))
    known = table(spark, sf_dir, "part").where("p_partkey % 50 <> 0").select(F.col("p_partkey").alias("evidence_id"))
    return metrics.provenance(o, known).withColumn("coverage", F.round("coverage", 9))


@query("""
WITH u AS (SELECT *, coalesce(CAST(value > lag(value) OVER w AS INTEGER), 0) AS up FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(1 - up) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM u), r AS (SELECT user_id, g, sum(up) AS rise FROM g GROUP BY user_id, g),
l AS (SELECT user_id, CAST(max(rise) AS BIGINT) AS longest_rise FROM r GROUP BY user_id), s AS (SELECT user_id, regr_slope(value, event_id) AS slope FROM events GROUP BY user_id)
SELECT user_id, longest_rise, coalesce(longest_rise >= 3 AND slope > 0, false) AS unbounded FROM l JOIN s USING (user_id)
""")
def unbounded_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = metrics.growth(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 3)
    return g.select("user_id", "longest_rise", F.coalesce("unbounded", F.lit(False)).alias("unbounded"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'view') AND event_id % 6 <> 0")
def unaudited_denials(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (~F.col("event_type").isin("error", "view")).alias("allowed"))
    audit = table(spark, sf_dir, "events").where("event_id % 6 = 0").select("event_id")
    return metrics.unaudited(e, audit, "event_id").select("event_id", "event_type")


@query("""
WITH a AS (SELECT count(*) AS n, count(*) FILTER (event_id % 40 <> 0) AS hits, count(*) FILTER (event_id % 50 = 0) AS disclosures FROM events)
SELECT n, hits, round(hits / n, 9) AS rate, disclosures, hits / n >= 0.95 AND disclosures = 0 AS passed FROM a
""")
def personalisation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that used a memory: some of another user's."""
    i = F.col("event_id")
    other, none = i % 50 == 0, i % 3 == 0
    told = {"told_user": F.when(other, F.col("user_id") + 1).when(~none, F.col("user_id")), "told_character": F.when(other | ~none, F.col("event_type"))}
    e = table(spark, sf_dir, "events").withColumns(told)
    return metrics.personalisation(e, i % 40 != 0, ["user_id", "event_type"], ["told_user", "told_character"]).withColumn("rate", F.round("rate", 9))


ENGINES = """
a AS (SELECT item_id, regexp_replace(text, '[^ -~]', '', 'g') AS t FROM benchmark WHERE item_id % 9 <> 0),
b AS (SELECT item_id, replace(regexp_replace(text, '[^ -~]', '', 'g'), CASE WHEN item_id % 2 = 0 THEN 'th' ELSE 'q' END, '') AS t FROM benchmark WHERE item_id % 7 <> 0),
d AS (SELECT coalesce(a.item_id, b.item_id) AS item_id, levenshtein(a.t, b.t) / greatest(length(a.t), length(b.t), 1) AS difference FROM a FULL JOIN b ON a.item_id = b.item_id)
"""


def _engines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i, t = F.col("item_id"), F.regexp_replace("text", "[^ -~]", "")
    x = table(spark, sf_dir, "benchmark")
    other = F.replace(t, F.when(i % 2 == 0, "th").otherwise("q"), F.lit(""))
    return x.where(i % 9 != 0).select(i, t.alias("text")), x.where(i % 7 != 0).select(i, other.alias("text"))


@query(f"WITH {ENGINES} SELECT item_id, round(difference, 9) AS difference FROM d WHERE difference <= 0.04")
def engine_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages on whose transcript two engines agree (one of them drops some letters)."""
    return metrics.consensus(*_engines(spark, sf_dir), "item_id", 0.04).select("item_id", F.round("difference", 9).alias("difference"))


@query(f"WITH {ENGINES} SELECT item_id, round(difference, 9) AS difference FROM d WHERE coalesce(difference > 0.04, true)")
def disputed_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.disputed(*_engines(spark, sf_dir), "item_id", 0.04).select("item_id", F.round("difference", 9).alias("difference"))


# Events


@query("""
WITH a AS (SELECT user_id, max(event_id) - 500 AS ack FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT event_id, user_id FROM events LEFT JOIN a USING (user_id) WHERE coalesce(event_id > ack, true)
""")
def resumable_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    acks = e.where("event_type = 'purchase'").select("user_id", (F.col("event_id") - 500).alias("acknowledged"))
    return events.resumable(e, acks, "user_id", "event_id").select("event_id", "user_id")


@query("""
WITH f AS (SELECT user_id, ts AS arrived, ts - INTERVAL 1 HOUR * (event_id % 7) AS presented FROM events),
l AS (SELECT *, coalesce(epoch_ms(presented) < max(epoch_ms(presented)) OVER w - 7200000, false) AS late, coalesce(presented < max(presented) OVER w, false) AS r FROM f
  WINDOW w AS (PARTITION BY user_id ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, count(*) AS frames, count(*) FILTER (late) AS dropped, count(*) FILTER (r AND NOT late) AS reordered, count(*) - count(*) FILTER (late) AS played FROM l GROUP BY user_id
""")
def jitter_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that come out of order: dropped if too late, else put back in order."""
    late = F.make_dt_interval(hours=(F.col("event_id") % 7).cast("int"))
    f = table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("arrived"), (F.col("ts") - late).alias("presented"))
    args = f, "user_id", "presented", "arrived", 7_200_000
    played = events.jitter_buffer(*args).groupBy("user_id").agg(F.max("position").cast("long").alias("played"))
    return events.jitter_counts(*args).join(played, "user_id", "left").fillna(0, ["played"])


@query("""
WITH p AS (SELECT *, event_type IN ('view', 'click') AS p, coalesce(lead(event_type IN ('view', 'click')) OVER (PARTITION BY user_id ORDER BY event_id), false) AS next FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, p ORDER BY event_id DESC) AS n FROM p WHERE NOT (p AND next))
SELECT event_id FROM k WHERE NOT p OR n <= 2
""")
def bounded_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of progress coalesced, then a queue of two places for progress; nothing else is dropped."""
    return events.bounded_queue(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("event_type").isin("view", "click"), 2).select("event_id")


@query("""
WITH c AS (SELECT user_id, min(event_id) + 1000 AS l FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT event_id FROM events LEFT JOIN c USING (user_id) WHERE coalesce(event_id <= l, true)
""")
def cancelled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    stops = e.where("event_type = 'error'").select("user_id", (F.col("event_id") + 1000).alias("last_allowed"))
    return events.after_cancellation(e, stops, "user_id", "event_id").select("event_id")


@query("""
WITH f AS (SELECT *, CASE WHEN event_id % 13 <> 0 THEN event_id % 50 END AS n FROM events)
SELECT CASE WHEN event_type NOT IN ('click', 'purchase', 'view') THEN 'kind' WHEN n IS NULL OR n > 40 THEN 'length' WHEN length(props) <> n THEN 'payload' ELSE 'fine' END AS fault, count(*) AS frames FROM f GROUP BY ALL
""")
def header_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame's header is judged before its payload is looked at."""
    i = F.col("event_id")
    f = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.when(i % 13 != 0, i % 50).alias("length"), F.encode("props", "UTF-8").alias("payload"))
    return events.header_faults(f, ("click", "purchase", "view"), 40).groupBy(F.coalesce("fault", F.lit("fine")).alias("fault")).agg(F.count("*").alias("frames"))


LEVEL = "CASE event_id % 3 WHEN 0 THEN 'read-only' WHEN 1 THEN 'tool-use' ELSE 'notify-only' END"


@query(f"""
WITH t AS (SELECT user_id, event_id AS task_id, ts, CASE WHEN event_id % 7 = 0 THEN 'paused' ELSE 'active' END AS status, {LEVEL} AS permission, event_id % 11 AS target FROM events WHERE event_type = 'purchase'),
g AS (SELECT *, (SELECT struct_pack(s := e.event_type, p := {LEVEL}) FROM events e WHERE e.event_type IN ('signup', 'click') AND e.user_id = t.user_id AND e.ts <= t.ts ORDER BY e.ts DESC, e.event_id DESC LIMIT 1) AS g FROM t)
SELECT task_id, CASE WHEN status <> 'active' THEN 'status' WHEN g IS NULL THEN 'no grant' WHEN g.s <> 'signup' THEN 'grant' WHEN g.p <> permission THEN 'permission' WHEN target > 8 THEN 'target' ELSE 'allowed' END AS verdict FROM g
""")
def scheduled_rechecks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks judged anew when they are due: status, latest grant, its level, target."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    tasks = e.where("event_type = 'purchase'").select("user_id", i.alias("task_id"), F.col("ts").alias("at"), F.when(i % 7 == 0, "paused").otherwise("active").alias("status"), F.expr(LEVEL).alias("permission"), (i % 11).alias("target"))
    grants = e.where("event_type in ('signup', 'click')").select("user_id", i.alias("grant_id"), F.col("ts").alias("at"), F.when(F.col("event_type") == "signup", "active").otherwise("revoked").alias("grant_status"), F.expr(LEVEL).alias("granted"))
    out = events.rechecked(tasks, grants, spark.range(9).select(F.col("id").alias("target")))
    return out.select("task_id", F.when(F.col("allowed"), "allowed").otherwise(F.col("reason")).alias("verdict"))


@query(f"""
WITH e AS (SELECT *, {LEVEL} AS l FROM events), g AS (SELECT DISTINCT user_id, l FROM e WHERE event_type = 'signup')
SELECT event_id, EXISTS (SELECT 1 FROM g WHERE g.user_id = e.user_id AND g.l = e.l) AS allowed FROM e WHERE event_type = 'purchase'
""")
def permission_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level is granted by its own name alone; no level includes another."""
    e = table(spark, sf_dir, "events").withColumn("level", F.expr(LEVEL))
    asked = e.where("event_type = 'purchase'").select("event_id", "user_id", F.col("level").alias("requested"))
    return events.permitted(asked, e.where("event_type = 'signup'").select("user_id", F.col("level").alias("permission")), "user_id").select("event_id", "allowed")


@query("""
SELECT a.event_id AS cue, b.event_id AS heard FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'click' AND b.ts BETWEEN a.ts - INTERVAL 2 HOUR AND a.ts + INTERVAL 2 HOUR
""")
def timed_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues and sounds of one session within a time of each other."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    pairs = events.correlated(e.where("event_type = 'view'"), e.where("event_type = 'click'"), ["user_id"], "2 HOURS")
    return pairs.select(F.col("event_id").alias("cue"), F.col("r_event_id").alias("heard"))


@query("""
SELECT a.ts AS audio_ts, b.ts AS event_ts, b.event_type AS type FROM events a JOIN events b ON a.event_type = 'view' AND b.event_type = 'click' AND a.user_id = b.user_id AND a.event_id % 5 = b.event_id % 5
  AND b.ts BETWEEN a.ts - INTERVAL 30 MINUTE AND a.ts + INTERVAL 30 MINUTE
""")
def channel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two channels joined as streams over one batch: frames and events of one session and trace."""
    at = f"{shared_dir(spark)}/channels-{uuid.uuid4().hex}"
    own = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("session_id"), (F.col("event_id") % 5).cast("string").alias("trace_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("type"))
    own.coalesce(1).write.parquet(f"{at}/in")
    read = spark.readStream.schema(own.schema).parquet(f"{at}/in")
    pairs = sessions.correlated(read.where("type = 'view'").drop("type"), read.where("type = 'click'"), "30 minutes")
    pairs = pairs.select(F.col("ts").alias("audio_ts"), "event_ts", "type")
    pairs.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.schema(pairs.schema).parquet(f"{at}/out").select(ntz("audio_ts"), ntz("event_ts"), "type")


# Memory and access


@query("SELECT event_id, value FROM events WHERE user_id = 8 AND event_type = 'click' AND value > 5 UNION ALL SELECT count(*), 0 FROM events WHERE user_id = 8 AND event_type <> 'click'")
def namespace_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A memory query that names no namespace reads one all the same; what an unguarded read would disclose is counted."""
    e = table(spark, sf_dir, "events").select("event_id", "value", F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("character_id"))
    read = memory.Memory({"records": e}, "8", "click").sql("SELECT event_id, value FROM {records} WHERE value > 5")
    leaked = memory.disclosed(e.where("user_id = '8'"), "8", "click").agg(F.count("*").alias("event_id")).select("event_id", F.lit(0.0).alias("value"))
    return read.unionByName(leaked)


@query("SELECT p_partkey AS memory_id FROM part WHERE p_partkey NOT IN (SELECT p_partkey - 7 FROM part WHERE p_partkey % 4 = 0)")
def superseded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    r = table(spark, sf_dir, "part").select(F.lit("n").alias("namespace_id"), k.alias("memory_id"), F.when(k % 4 == 0, F.array(k - 7)).otherwise(F.array().cast("array<long>")).alias("supersedes"))
    return memory.not_superseded(r).select("memory_id")


@query("""
SELECT c_custkey AS memory_id, round(c_acctbal * greatest(0.1, pow(0.5, (c_custkey % 365) * (1 - (c_custkey % 11) / 10.0) / 30.0)), 6) AS priority FROM customer
""")
def decayed_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("memory_id"), F.round(memory.priority(F.col("c_acctbal"), (k % 365).cast("double"), (k % 11) / 10), 6).alias("priority"))


@query(f"WITH {OPS}, last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) = 1) SELECT user_id AS memory_id FROM last WHERE op <> 'delete'")
def undeleted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "events").select(F.lit("n").alias("namespace_id"), F.col("user_id").alias("memory_id")).distinct()
    return memory.without_deleted(index, _operations(spark, sf_dir)).select("memory_id")


@query("""
WITH RECURSIVE edge AS (SELECT c_custkey AS k, c_custkey // 7 AS p FROM customer WHERE c_custkey > 0 UNION SELECT c_custkey, c_custkey // 3 FROM customer WHERE c_custkey > 0 AND c_custkey % 5 = 0),
up AS (SELECT k AS node, p AS ancestor, 1 AS depth FROM edge UNION SELECT node, p, depth + 1 FROM up JOIN edge ON k = ancestor)
SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY node, ancestor
""")
def commit_dag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits with one or two parents: all ancestors of each."""
    c, k = table(spark, sf_dir, "customer").where("c_custkey > 0"), F.col("c_custkey")
    first = c.select(k.alias("child"), F.floor(k / 7).alias("parent"))
    return memory.reachable(first.unionByName(c.where(k % 5 == 0).select(k.alias("child"), F.floor(k / 3).alias("parent"))))


@query(f"""
WITH {OPS}, m AS (SELECT max(event_id) // 2 AS half FROM events),
old AS (SELECT * FROM s WHERE event_id <= (SELECT half FROM m) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) = 1),
new AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) = 1),
o AS (SELECT * FROM old WHERE op <> 'delete'), n AS (SELECT * FROM new WHERE op <> 'delete')
SELECT coalesce(o.user_id, n.user_id) AS memory_id, CASE WHEN o.user_id IS NULL THEN 'added' WHEN n.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM o FULL JOIN n ON o.user_id = n.user_id WHERE o.user_id IS NULL OR n.user_id IS NULL OR o.revision <> n.revision OR o.v IS DISTINCT FROM n.v
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between the memory as of half of all commits and now."""
    ops = _operations(spark, sf_dir)
    half = ops.agg(F.floor(F.max("commit_seq") / 2)).first()[0] or 0
    return memory.diff(memory.snapshot(ops, half), memory.fold(ops)).select("memory_id", "change")


@query(f"""
WITH {OPS}, last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) = 1)
SELECT user_id AS memory_id FROM last WHERE op = 'delete' OR user_id % 3 = 0
""")
def stale_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection whose rows lag by one for every third memory."""
    n = table(spark, sf_dir, "events").groupBy(F.lit("n").alias("namespace_id"), F.col("user_id").alias("memory_id")).agg(F.count("*").alias("n"))
    projection = n.select("namespace_id", "memory_id", F.when(F.col("memory_id") % 3 == 0, F.col("n") - 1).otherwise(F.col("n")).alias("revision"))
    return memory.stale(projection, _operations(spark, sf_dir)).select("memory_id")


@query("""
SELECT event_id, event_id % 3 <> 0 AND event_id % 4 <> 0 AND user_id % 5 <> 0 AND user_id % 2 = 0 AND (user_id % 6 <> 0 OR ts < TIMESTAMP '2024-01-05 00:00:00') AS allowed FROM events
""")
def access_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with tokens that fail, owners that differ, subjects unknown, grants revoked or expired."""
    i, u = F.col("event_id"), F.col("user_id")
    e = table(spark, sf_dir, "events")
    asked = e.select("event_id", F.concat(F.lit("s"), u).alias("subject"), (i % 3 != 0).alias("token_valid"), F.when(i % 4 == 0, u + 1).otherwise(u).alias("owner_id"), F.col("ts").cast("timestamp").alias("at"))
    ids = e.select("user_id").distinct()
    users = ids.where(u % 5 != 0).select(F.concat(F.lit("s"), u).alias("subject"), "user_id")
    grants = ids.select("user_id", F.when(u % 2 == 0, "active").otherwise("revoked").alias("status"), F.when(u % 6 == 0, F.lit("2024-01-05 00:00:00").cast("timestamp")).alias("expires_at"))
    return memory.access(asked, users, grants).select("event_id", "allowed")


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 12 <> 0")
def allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact addresses alone: neither wildcards nor another case."""
    k = F.col("c_custkey")
    address = F.concat(F.lit("u"), k, F.lit("@h.org"))
    c = table(spark, sf_dir, "customer")
    listed = c.where(k % 3 == 0).select(F.when(k % 12 == 0, F.upper(address)).otherwise(address).alias("email")).union(spark.createDataFrame([("*@h.org",), ("u1*",)], "email string"))
    return memory.on_allowlist(c.select(k.alias("id"), address.alias("email")), listed).select("id")


# Governance


@query("""
WITH d AS (SELECT *, CAST(substr(source, 4) AS INTEGER) AS s FROM documents)
SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'rejected' WHEN doc_id % 3 <> 0 AND lang IN ('en', 'de') AND s % 3 <> 0 AND s % 5 <> 0 THEN 'accepted' ELSE 'quarantine' END AS route FROM d
""")
def routed_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample is accepted only from an accepted source with cleared rights."""
    i, d = F.col("doc_id"), table(spark, sf_dir, "documents")
    samples = d.select(i, F.col("source").alias("source_id"), F.when(F.col("lang").isin("en", "de"), "owned").otherwise("restricted").alias("rights_status"), F.when(i % 10 == 0, "rejected").when(i % 3 != 0, "accepted").otherwise("quarantine").alias("status"))
    s = F.substring("source", 4, 9).cast("int")
    sources = d.select("source").distinct().select(F.col("source").alias("source_id"), F.when(s % 3 == 0, "unknown").otherwise("permitted").alias("rights_status"), F.when(s % 5 == 0, "quarantine").otherwise("accepted").alias("status"))
    return governance.routed(samples, sources).select("doc_id", "route")


@query("""
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'singing' ELSE 'speech' END AS source_type, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice * (o_custkey % 10) / 10.0), 2) AS effective FROM orders GROUP BY ALL
""")
def volume_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech and singing are told apart."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 4 == 0, "singing").otherwise("speech").alias("source_type"), "o_totalprice", ((F.col("o_custkey") % 10) / 10).alias("w"))
    v = governance.effective_volume(o, ["source_type"], "o_totalprice", [F.col("w")])
    return v.select("source_type", F.round("total", 2).alias("total"), F.round("effective", 2).alias("effective"))


@query("""
WITH RECURSIVE edge AS (SELECT c_custkey AS k, c_custkey // 7 AS p FROM customer WHERE c_custkey > 0 AND c_custkey % 4 <> 0), node AS (SELECT k FROM edge UNION SELECT p FROM edge),
up AS (SELECT k AS id, k AS top FROM node UNION ALL SELECT id, p FROM up JOIN edge ON edge.k = up.top)
SELECT id, min(top) AS root, CASE WHEN ('0x' || substr(sha256(CAST(min(top) AS VARCHAR)), 1, 4))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM up GROUP BY id
""")
def lineage_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived samples go to the split of their lineage's root."""
    c, k = table(spark, sf_dir, "customer").where("c_custkey > 0 and c_custkey % 4 <> 0"), F.col("c_custkey")
    return governance.split(governance.lineage_roots(c.select(k.alias("child"), F.floor(k / 7).alias("parent"))), "root")


@query("SELECT p_partkey FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0")
def untraced_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    t = table(spark, sf_dir, "part").select(k, F.when(k % 3 != 0, F.sha2("p_name", 256)).alias("parent_hash"), F.when(k % 5 == 0, " ").otherwise("tool").alias("tool"), F.when(k % 7 != 0, "1.0").alias("version"))
    return governance.untraced(t).select("p_partkey")


@query("SELECT o_orderkey AS task_id, o_orderstatus AS status FROM orders")
def push_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A notification carries the allowed columns alone."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("result"), F.col("o_custkey").alias("owner"))
    return governance.push_payload(o, ("task_id", "status"))

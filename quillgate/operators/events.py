"""Ordered event semantics over tables; the same over streams is in quillgate.streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sequence_faults(events: DataFrame, key: str, sequence: str, arrival: list[str], first: int | None = None) -> DataFrame:
    """events with fault: null, start (not `first`), gap, duplicate or late, by the highest sequence seen before."""
    w = W.partitionBy(key).orderBy(*arrival)
    top = F.max(sequence).over(w.rowsBetween(W.unboundedPreceding, -1))
    s = F.col(sequence)
    start = F.when(s != first, "start") if first is not None else F.lit(None).cast("string")
    return events.withColumn("fault", F.when(top.isNull(), start).when(s == top + 1, None).when(s > top + 1, "gap").when(s == top, "duplicate").otherwise("late"))


def sequence_summary(events: DataFrame, key: str, sequence: str) -> DataFrame:
    """key, n, first, gaps, duplicates from order-free aggregates: no sort, no window."""
    g = events.groupBy(key).agg(F.count("*").alias("n"), F.min(sequence).alias("first"), F.max(sequence).alias("last"), F.countDistinct(sequence).alias("d"))
    return g.select(key, "n", "first", (F.col("last") - F.col("first") + 1 - F.col("d")).alias("gaps"), (F.col("n") - F.col("d")).alias("duplicates"))


def grammar(events: DataFrame, key: str, order: list[str], code: Column, pattern: str) -> DataFrame:
    """key, word, valid: the events' codes in order, as one text, against a regular grammar. Events without a code break it."""
    each = events.select(key, F.struct(*order, F.coalesce(code, F.lit("?")).alias("c")).alias("x"))
    word = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["c"]), "")
    return each.groupBy(key).agg(word.alias("word")).withColumn("valid", F.col("word").rlike(pattern))


#: A tool call's life: requested, started, any progress, completed or failed.
TOOL_LIFE = {"tool.requested": "r", "tool.started": "s", "tool.progress": "p", "tool.completed": "c", "tool.failed": "f"}


def tool_lifecycles(events: DataFrame) -> DataFrame:
    """call_id, word, valid, one_trace of tool events (call_id, sequence, type, trace_id)."""
    code = F.create_map(*[F.lit(x) for kv in TOOL_LIFE.items() for x in kv])[F.col("type")]
    traces = events.groupBy("call_id").agg((F.countDistinct("trace_id") == 1).alias("one_trace"))
    return grammar(events, "call_id", ["sequence"], code, "^rsp*[cf]$").join(traces, "call_id")


def first_per_key(events: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The first row of each key: an aggregate that combines before it shuffles, not a window."""
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    cols = events.columns
    x = events.groupBy(*named).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_x"))
    return x.select("_x.*")


def correlated(left: DataFrame, right: DataFrame, keys: list[str], within: str, left_ts: str = "ts", right_ts: str = "ts") -> DataFrame:
    """Pairs of two channels by keys whose times differ by at most `within`; the right columns get a prefix."""
    r = right.select(*[F.col(c).alias(c if c in keys else f"r_{c}") for c in right.columns])
    d = F.expr(f"INTERVAL {within}")
    return left.join(r, keys).where((F.col(f"r_{right_ts}") >= F.col(left_ts) - d) & (F.col(f"r_{right_ts}") <= F.col(left_ts) + d))


def gap_sessions(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """key, session (from 1), start, end, n: sessions end after so long without an event."""
    w = W.partitionBy(key).orderBy(ts)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    e = events.withColumn("_us", us).withColumn("_new", F.coalesce((F.col("_us") - F.lag("_us").over(w) >= gap_seconds * 1_000_000).cast("int"), F.lit(1)))
    e = e.withColumn("session", F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, W.currentRow)))
    return e.groupBy(key, "session").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"))


def replay_window(frames: DataFrame, key: str, sequence: str, arrival: list[str], size: int) -> DataFrame:
    """frames with verdict: accepted, duplicate, or out of window (more than `size` below the highest before it)."""
    w = W.partitionBy(key).orderBy(*arrival).rowsBetween(W.unboundedPreceding, -1)
    own = W.partitionBy(key, sequence).orderBy(*arrival)
    top = F.max(sequence).over(w)
    old = F.coalesce(F.col(sequence) <= top - size, F.lit(False))
    return frames.withColumn("verdict", F.when(old, "out of window").when(F.row_number().over(own) > 1, "duplicate").otherwise("accepted"))


def resumable(frames: DataFrame, acknowledged: DataFrame, key: str, sequence: str) -> DataFrame:
    """Frames to send again: those after the last acknowledged sequence of their session, all if there is none."""
    last = acknowledged.groupBy(key).agg(F.max("acknowledged").alias("_ack"))
    return frames.join(last, key, "left").where(F.coalesce(F.col(sequence) > F.col("_ack"), F.lit(True))).drop("_ack")


def lateness(frames: DataFrame, key: str, presented: str, arrived: str, delay_ms: int) -> DataFrame:
    """frames with late: whether a frame comes after a frame presented more than the buffer's delay later."""
    w = W.partitionBy(key).orderBy(arrived).rowsBetween(W.unboundedPreceding, -1)
    ms = F.unix_millis(F.col(presented).cast("timestamp"))
    return frames.withColumn("late", F.coalesce(ms < F.max(ms).over(w) - delay_ms, F.lit(False)))


def jitter_buffer(frames: DataFrame, key: str, presented: str, arrived: str, delay_ms: int) -> DataFrame:
    """Frames as a buffer of so much delay plays them: late ones are dropped, the rest in order of presentation, with position
    (from 1) and reordered (whether one presented later came first)."""
    w = W.partitionBy(key).orderBy(arrived).rowsBetween(W.unboundedPreceding, -1)
    own = lateness(frames, key, presented, arrived, delay_ms).withColumn("reordered", F.coalesce(F.col(presented) < F.max(presented).over(w), F.lit(False)))
    return own.where("not late").withColumn("position", F.row_number().over(W.partitionBy(key).orderBy(presented, arrived))).drop("late")


def jitter_counts(frames: DataFrame, key: str, presented: str, arrived: str, delay_ms: int) -> DataFrame:
    """key, frames, dropped (late), reordered (kept, though one presented later came first)."""
    w = W.partitionBy(key).orderBy(arrived).rowsBetween(W.unboundedPreceding, -1)
    own = lateness(frames, key, presented, arrived, delay_ms).withColumn("_r", F.coalesce(F.col(presented) < F.max(presented).over(w), F.lit(False)))
    return own.groupBy(key).agg(F.count("*").alias("frames"), F.count_if("late").alias("dropped"), F.count_if(F.col("_r") & ~F.col("late")).alias("reordered"))


def bounded_queue(events: DataFrame, key: str, order: str, progress: Column, most: int) -> DataFrame:
    """What a queue of `most` places for progress hands on: runs of progress are coalesced, then only the last `most` progress
    events of a key stay. Other events are never dropped."""
    e = coalesced_progress(events.withColumn("_is", F.coalesce(progress, F.lit(False))), key, order, F.col("_is"))
    after = W.partitionBy(key, "_is").orderBy(F.desc(order))
    return e.withColumn("_n", F.row_number().over(after)).where(~F.col("_is") | (F.col("_n") <= most)).drop("_is", "_n")


def coalesced_progress(events: DataFrame, key: str, order: str, progress: Column) -> DataFrame:
    """Of each run of progress events only the last stays; all others stay."""
    following = F.lead("_p").over(W.partitionBy(key).orderBy(order))
    e = events.withColumn("_p", F.coalesce(progress, F.lit(False))).withColumn("_next", following)
    return e.where(~(F.col("_p") & F.coalesce("_next", F.lit(False)))).drop("_p", "_next")


def after_cancellation(frames: DataFrame, cancelled: DataFrame, key: str, sequence: str) -> DataFrame:
    """Frames without those past their session's least last-allowed sequence."""
    c = cancelled.groupBy(key).agg(F.min("last_allowed").alias("_last"))
    return frames.join(c, key, "left").where(F.coalesce(F.col(sequence) <= F.col("_last"), F.lit(True))).drop("_last")


def header_faults(frames: DataFrame, kinds: tuple[str, ...], most_bytes: int) -> DataFrame:
    """frames with fault: the header's kind, then its length, before the payload is looked at."""
    n = F.col("length")
    return frames.withColumn("fault", F.when(~F.coalesce(F.col("kind").isin(*kinds), F.lit(False)), "kind").when(~F.coalesce(n.between(0, most_bytes), F.lit(False)), "length").when(~F.length("payload").eqNullSafe(n.cast("int")), "payload"))


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, columns: list[str], tie: str) -> DataFrame:
    """left with columns of the latest right row at or before its time, by key: one union and one window, no range join."""
    kinds = dict(right.dtypes)
    lk = dict(left.dtypes)
    l_side = left.select(*left.columns, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"), *[F.lit(None).cast(kinds[c]).alias(f"_r_{c}") for c in columns])
    r_side = right.select(*[F.col(c) if c == key else F.lit(None).cast(lk[c]).alias(c) for c in left.columns], F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), F.col(tie).cast("long").alias("_tie"), *[F.col(c).alias(f"_r_{c}") for c in columns])
    w = W.partitionBy(key).orderBy("_t", "_side", "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = F.last(F.when(F.col("_side") == 0, F.struct(*[F.col(f"_r_{c}").alias(c) for c in columns])), ignorenulls=True).over(w)
    out = l_side.unionByName(r_side).withColumn("_x", seen).where("_side = 1")
    return out.select(*left.columns, *[F.col(f"_x.{c}").alias(f"asof_{c}") for c in columns])


def followed_by(events: DataFrame, key: str, ts: str, first: Column, then: Column, seconds: int, id_col: str) -> DataFrame:
    """first_id, then_id of all pairs of a key where `then` comes within so many seconds after `first`. Both are cut into
    buckets of that length, so a pair meets in an equi-join on (key, bucket) and no key's events meet all others."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    span = seconds * 1_000_000
    a = events.where(first).select(key, us.alias("a"), F.col(id_col).alias("first_id"))
    a = a.withColumn("bucket", F.explode(F.array(F.floor(F.col("a") / span), F.floor(F.col("a") / span) + 1)))
    b = events.where(then).select(key, us.alias("b"), F.col(id_col).alias("then_id")).withColumn("bucket", F.floor(F.col("b") / span))
    return a.join(b, [key, "bucket"]).where((F.col("b") > F.col("a")) & (F.col("b") <= F.col("a") + span)).select(key, "first_id", "then_id", (F.col("b") - F.col("a")).alias("us"))


def permitted(requests: DataFrame, grants: DataFrame, key: str) -> DataFrame:
    """requests with allowed: levels are equal, never inherited. requests: key, requested; grants: key, permission."""
    g = grants.select(key, F.col("permission").alias("requested"), F.lit(True).alias("_ok")).distinct()
    return requests.join(g, [key, "requested"], "left").withColumn("allowed", F.coalesce("_ok", F.lit(False))).drop("_ok")


def rechecked(tasks: DataFrame, grants: DataFrame, targets: DataFrame, key: str = "user_id") -> DataFrame:
    """Tasks as the scheduler sees them when they are due: allowed, and the first reason against. The latest grant at or before the
    task's time must be active and of the very level that the task asks for, the task itself active, its target still there.
    tasks: key, task_id, at, status, permission, target; grants: key, grant_id, at, grant_status, granted; targets: target."""
    held = asof(tasks, grants, key, "at", "at", ["grant_status", "granted"], "grant_id")
    there = targets.select("target", F.lit(True).alias("_there")).distinct()
    t = held.join(there, "target", "left")
    reason = F.when(F.col("status") != "active", "status").when(F.col("asof_grant_status").isNull(), "no grant").when(F.col("asof_grant_status") != "active", "grant").when(~F.col("asof_granted").eqNullSafe(F.col("permission")), "permission").when(F.col("_there").isNull(), "target")
    return t.withColumn("reason", reason).withColumn("allowed", F.col("reason").isNull()).drop("_there", "asof_grant_status", "asof_granted")

"""Evaluation metrics and gates. Thresholds, confidence levels and statistics that a policy leaves open are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.functions.statistics import cosine, mean_bound, wilson
from quillgate.functions.text import char_errors, word_errors

OPERATORS = ("gte", "lte", "eq", "non_inferior")


def error_rate(pairs: DataFrame, by: list[str] | None = None, words: bool = False, strata: bool = False) -> DataFrame:
    """errors, length, rate over pairs (reference, said): sum of edit distances over sum of lengths. With strata, a row for each
    group and one for all (its group columns null)."""
    e = word_errors("reference", "said") if words else char_errors("reference", "said")
    n = F.size(F.split(F.trim("reference"), r"\s+")) if words else F.char_length("reference")
    own = pairs.select(*(by or []), e.alias("errors"), n.cast("long").alias("length"))
    if strata:
        g = own.groupingSets([by, []], *by)
    else:
        g = own.groupBy(*(by or []))
    return g.agg(F.sum("errors").alias("errors"), F.sum("length").alias("length")).withColumn("rate", F.col("errors") / F.col("length"))


def poisson(u: Column, most: int = 8) -> Column:
    """A Poisson(1) count from a uniform number."""
    p, total, out = 0.36787944117144233, 0.0, F.lit(0)
    for k in range(most):
        total += p
        out = out + (u >= total).cast("int")
        p /= k + 1
    return out


def bootstrap(rows: DataFrame, top: str, bottom: str, key: str, times: int = 200, level: float = 0.95, seed: int = 1) -> DataFrame:
    """rate, lower, upper of sum(top) / sum(bottom): a Poisson bootstrap, whose draws depend on key, replicate and seed. Rows
    are summed by replicate before anything is shuffled."""
    u = F.shiftrightunsigned(F.xxhash64(key, "b", F.lit(seed)), 11) / F.lit(float(1 << 53))
    drawn = rows.select(key, top, bottom, F.explode(F.sequence(F.lit(1), F.lit(times))).alias("b")).withColumn("k", poisson(u))
    each = drawn.groupBy("b").agg((F.sum(F.col(top) * F.col("k")) / F.sum(F.col(bottom) * F.col("k"))).alias("r"))
    ends = each.agg(*[F.percentile("r", F.lit(q)).alias(n) for n, q in (("lower", 1 - level), ("upper", level))])
    return rows.agg((F.sum(top) / F.sum(bottom)).alias("rate")).crossJoin(F.broadcast(ends))  # one row each


def paired_delta(base: DataFrame, candidate: DataFrame, key: str, value: str, upper: bool = True) -> DataFrame:
    """n, delta (candidate less base), bound of rows that both have."""
    both = base.select(key, F.col(value).alias("_b")).join(candidate.select(key, F.col(value).alias("_c")), key)
    x = both.select((F.col("_c") - F.col("_b")).alias("d")).agg(F.count("d").alias("n"), F.avg("d").alias("delta"), F.stddev_samp("d").alias("s"))
    return x.select("n", "delta", mean_bound(F.col("delta"), F.coalesce("s", F.lit(0.0)), F.col("n"), upper=upper).alias("bound"))


def rate(rows: DataFrame, ok: Column, by: list[str] | None = None) -> DataFrame:
    """n, hits, rate, lower, upper (Wilson)."""
    g = rows.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.coalesce(F.sum(ok.cast("long")), F.lit(0)).alias("hits"))
    h, n = F.col("hits"), F.col("n")
    return g.withColumns({"rate": h / n, "lower": wilson(h, n), "upper": wilson(h, n, upper=True)})


def stratified(rows: DataFrame, ok: Column, stratum: str, least: float) -> DataFrame:
    """stratum (null: all), n, hits, rate, passed; gate: whether the total and every stratum pass. One scan by grouping sets."""
    g = rows.withColumn("_ok", ok.cast("long")).groupingSets([[stratum], []], stratum).agg(F.count("*").alias("n"), F.sum("_ok").alias("hits"), F.grouping(stratum).alias("is_total"))
    g = g.withColumn("rate", F.col("hits") / F.col("n")).withColumn("passed", F.coalesce(F.col("rate") >= least, F.lit(False)))
    all_pass = g.agg(F.every("passed").alias("gate"))
    return g.crossJoin(F.broadcast(all_pass))


def adjudicated(rows: DataFrame, first: str, second: str, adjudicator: str) -> Column:
    """The adjudicator's label, else what both annotators say, else null."""
    return F.coalesce(adjudicator, F.when(F.col(first) == F.col(second), F.col(first)))


def agreement(rows: DataFrame, first: str, second: str) -> DataFrame:
    """n, observed, expected, kappa of two annotators."""
    own = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull())
    n = own.agg(F.count("*").alias("n"), F.avg((F.col(first) == F.col(second)).cast("double")).alias("observed"))
    a, b = own.groupBy(F.col(first).alias("v")).count(), own.groupBy(F.col(second).alias("v")).count()
    chance = a.withColumnRenamed("count", "x").join(b.withColumnRenamed("count", "y"), "v").agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("xy"))
    e = F.col("xy") / (F.col("n") * F.col("n"))
    return n.crossJoin(F.broadcast(chance)).select("n", "observed", e.alias("expected"), F.when(e < 1, (F.col("observed") - e) / (1 - e)).alias("kappa"))


def consensus(a: DataFrame, b: DataFrame, key: str, most: float) -> DataFrame:
    """Rows (key, text) of two engines whose texts differ by at most that rate of characters."""
    both = a.select(key, F.col("text").alias("text_a")).join(b.select(key, F.col("text").alias("text_b")), key)
    r = F.levenshtein("text_a", "text_b") / F.greatest(F.char_length("text_a"), F.char_length("text_b"), F.lit(1))
    return both.withColumn("difference", r).where(F.col("difference") <= most)


def confusion(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    return rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def macro_accuracy(table: DataFrame, critical: list[str] | None = None, least: float = 0.0) -> DataFrame:
    """macro (mean recall over classes) and whether each critical class reaches `least`; of a confusion()."""
    per = table.groupBy("actual").agg((F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("recall"))
    bad = F.col("actual").isin(*(critical or [""])) & (F.col("recall") < least)
    return per.agg(F.avg("recall").alias("macro"), (F.count_if(bad) == 0).alias("critical_pass"))


def top_neighbours(queries: DataFrame, items: DataFrame, k: int = 10, within: tuple[str, ...] = ()) -> DataFrame:
    """query_id, id, rank by cosine among items of the query's own namespace columns, itself apart. queries, items: id, v and
    the namespace columns. A namespace's items meet its queries alone."""
    q = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"), *within)
    pairs = q.join(items.select("id", "v", *within), list(within)) if within else q.crossJoin(items.select("id", "v"))  # a stated query set against all rows
    s = pairs.where("query_id <> id").select("query_id", "id", *within, F.round(cosine("q", "v"), 9).alias("score"))
    w = W.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "id")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall_at(found: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """queries, recall: mean share of each query's relevant ids (query_id, id) among its first k."""
    hit = truth.join(found.where(F.col("rank") <= k).select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    per = hit.groupBy("query_id").agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")).alias("r"))
    return per.agg(F.count("*").alias("queries"), F.avg("r").alias("recall"))


def recall_of(found: DataFrame, queries: DataFrame, items: DataFrame, relevant: Column, within: tuple[str, ...] = (), k: int = 10) -> DataFrame:
    """queries, recall, where what is relevant is a condition on an item's id: counted by namespace, never listed as pairs. found:
    query_id, id, rank of top_neighbours(); queries without a relevant item but themselves have no recall."""
    n = items.groupBy(*within).agg(F.count_if(relevant).alias("n"))
    asked = queries.select(*within, F.col("id").alias("query_id"), F.coalesce(relevant, F.lit(False)).cast("long").alias("_self"))
    total = (asked.join(n, list(within)) if within else asked.crossJoin(F.broadcast(n))).select("query_id", (F.col("n") - F.col("_self")).alias("n")).where("n > 0")
    hits = found.where(F.col("rank") <= k).groupBy("query_id").agg(F.count_if(relevant).alias("hits"))
    return total.join(hits, "query_id", "left").agg(F.count("*").alias("queries"), F.avg(F.coalesce("hits", F.lit(0)) / F.col("n")).alias("recall"))


def provenance(records: DataFrame, evidence: DataFrame, id_col: str = "id", refs: str = "evidence") -> DataFrame:
    """n, covered, coverage: records with evidence, all of which resolves. evidence: evidence_id."""
    each = records.select(id_col, F.explode_outer(refs).alias("evidence_id"))
    known = each.join(evidence.select("evidence_id", F.lit(1).alias("k")).distinct(), "evidence_id", "left")
    per = known.groupBy(id_col).agg(F.every(F.col("k").isNotNull()).alias("ok"))
    return per.agg(F.count("*").alias("n"), F.count_if("ok").alias("covered")).withColumn("coverage", F.col("covered") / F.col("n"))


def latency(pairs: DataFrame, start: str, end: str, by: list[str] | None = None, q: float = 0.95) -> DataFrame:
    """n and the exact interpolated quantile in microseconds of end - start.

    A histogram (16 steps for each doubling, a few hundred rows a group) tells in which steps the two values lie that the quantile is
    between; only those steps' distinct values are ranked, so no task holds a group's values."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    by = by or []
    v = pairs.select(*by, (us(end) - us(start)).alias("_v"))
    step = F.when(F.col("_v") == 0, 0).otherwise(F.signum("_v") * (F.floor(F.log2(F.abs("_v").cast("double")) * 16) + 1)).cast("int")
    counts = v.where("_v is not null").groupBy(*by, "_v", step.alias("_s")).agg(F.count("*").alias("_c"))
    steps = counts.groupBy(*by, "_s").agg(F.sum("_c").alias("_c"))
    up_to = W.partitionBy(*by).orderBy("_s").rowsBetween(W.unboundedPreceding, W.currentRow)
    steps = steps.withColumn("_to", F.sum("_c").over(up_to)).withColumn("_n", F.sum("_c").over(W.partitionBy(*by)))
    at = (F.col("_n") - 1) * F.lit(q)
    low, high = F.floor(at), F.ceil(at)
    wanted = steps.where((F.col("_to") > low) & (F.col("_to") - F.col("_c") <= high))
    wanted = wanted.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_s").alias("_step"), (F.col("_to") - F.col("_c")).alias("_before"), "_n")
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)] + [F.col("_s") == F.col("_step")]
    near = counts.join(wanted, reduce(Column.__and__, same)).select(*by, "_s", "_v", "_c", "_before", "_n")
    near = near.withColumn("_to", F.col("_before") + F.sum("_c").over(W.partitionBy(*by, "_s").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)))
    pick = lambda rank: F.min(F.when(F.col("_to") > rank, F.col("_v")))
    found = near.groupBy(*by).agg(F.max("_n").alias("_n"), pick(low).alias("_x"), pick(high).alias("_y"))
    part = at - low
    found = found.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], (F.col("_x") + (F.col("_y") - F.col("_x")) * part).alias("quantile_us"))
    total = v.groupBy(*by).agg(F.count("_v").alias("n"))
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.lit(True))
    return total.join(found if by else F.broadcast(found), on, "left").select(*by, "n", "quantile_us")


def growth(samples: DataFrame, by: str, at: str, value: str, run: int) -> DataFrame:
    """by, slope, longest_rise, unbounded: whether a measure rose `run` times in a row and its regression slope is positive."""
    w = W.partitionBy(by).orderBy(at)
    up = F.coalesce((F.col(value) > F.lag(value).over(w)).cast("int"), F.lit(0))
    s = samples.withColumn("_up", up).withColumn("_g", F.sum(1 - F.col("_up")).over(w))
    runs = s.groupBy(by, "_g").agg(F.sum("_up").alias("rise")).groupBy(by).agg(F.max("rise").alias("longest_rise"))
    slope = samples.groupBy(by).agg(F.regr_slope(value, at).alias("slope"))
    return slope.join(runs, by).withColumn("unbounded", (F.col("longest_rise") >= run) & (F.col("slope") > 0))


def unaudited(attempts: DataFrame, audit: DataFrame, key: str) -> DataFrame:
    """Denied attempts that no audit entry names."""
    return attempts.where("not allowed").join(audit, key, "left_anti")


def persona_filter(rows: DataFrame, hard_violation: Column, vector: str, canonical: str, least: float = 0.0) -> DataFrame:
    """rows with cosine and stage: hard (rejected first), cosine (at most `least`, or none), kept."""
    own = rows.withColumn("cosine", cosine(vector, canonical))
    return own.withColumn("stage", F.when(F.coalesce(hard_violation, F.lit(True)), "hard").when(~F.coalesce(F.col("cosine") > least, F.lit(False)), "cosine").otherwise("kept"))


def gate_results(measured: DataFrame, gates: DataFrame) -> DataFrame:
    """evaluation_id, value, passed. gates: evaluation_id, operator, threshold, sample_count; measured: evaluation_id, value,
    n. A gate without a value, or with too few samples, isn't passed; non_inferior holds value >= -threshold."""
    m = gates.join(measured, "evaluation_id", "left")
    t, v = F.col("threshold"), F.col("value")
    ok = F.when(F.col("operator") == "gte", v >= t).when(F.col("operator") == "lte", v <= t).when(F.col("operator") == "eq", v == t).when(F.col("operator") == "non_inferior", v >= -t)
    return m.select("evaluation_id", "value", F.coalesce(ok & (F.col("n") >= F.col("sample_count")), F.lit(False)).alias("passed"))


def dependent(results: DataFrame, gate: str, needs: str) -> DataFrame:
    """results where a gate passes only if the one it needs has passed."""
    first = F.broadcast(results.where(F.col("evaluation_id") == needs).select(F.col("passed").alias("_p")))
    both = results.join(first, F.lit(True), "left")
    return both.select("evaluation_id", "value", (F.col("passed") & ((F.col("evaluation_id") != gate) | F.coalesce("_p", F.lit(False)))).alias("passed"))


def capabilities(table: DataFrame, results: DataFrame, id_col: str = "capability_id", gates: str = "evaluation_id") -> DataFrame:
    """id_col, gates, passed: whether all its gates pass; one without gates, or with an unknown gate, doesn't."""
    each = table.select(id_col, F.explode_outer(gates).alias("evaluation_id")).join(results.select("evaluation_id", "passed"), "evaluation_id", "left")
    return each.groupBy(id_col).agg(F.count("evaluation_id").alias("gates"), F.every(F.coalesce("passed", F.lit(False))).alias("passed"))


def promotion(now: DataFrame, before: DataFrame, hard: list[str]) -> DataFrame:
    """One row: promoted, failed, regressed, hard_failed. No gate may fail, none that passed before may fail now, and a hard
    gate's failure isn't averaged away."""
    b = before.select("evaluation_id", F.col("passed").alias("was"))
    x = now.join(b, "evaluation_id", "full_outer").withColumn("passed", F.coalesce("passed", F.lit(False)))
    counts = x.agg(F.count_if(~F.col("passed")).alias("failed"), F.count_if(~F.col("passed") & F.coalesce("was", F.lit(False))).alias("regressed"), F.count_if(~F.col("passed") & F.col("evaluation_id").isin(*(hard or [""]))).alias("hard_failed"))
    return counts.select(reduce(Column.__and__, [F.col(c) == 0 for c in ("failed", "regressed", "hard_failed")]).alias("promoted"), "failed", "regressed", "hard_failed")


def naturalness(scores: DataFrame, base: DataFrame, key: str, score: str, timbre: str, least: float, margin: float) -> DataFrame:
    """n, mean, lower, timbre_lower, passed: the mean score's lower bound reaches `least`, and timbre is no worse than the base's by
    more than the margin (lower bound of the paired difference)."""
    own = scores.agg(F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("s"))
    own = own.select("n", "mean", mean_bound(F.col("mean"), F.coalesce("s", F.lit(0.0)), F.col("n")).alias("lower"))
    pair = paired_delta(base, scores, key, timbre, upper=False).select(F.col("bound").alias("timbre_lower"))
    both = own.crossJoin(F.broadcast(pair))  # one row each
    return both.withColumn("passed", F.coalesce((F.col("lower") >= least) & (F.col("timbre_lower") >= -margin), F.lit(False)))


def preference(rows: DataFrame, preferred: Column, stratum: str, least: float, floor: float) -> DataFrame:
    """n, hits, lower, collapsed, passed: the preference rate's lower bound reaches `least`, and no stratum's rate is under `floor`."""
    per = rows.groupBy(stratum).agg(F.count("*").alias("n"), F.coalesce(F.sum(preferred.cast("long")), F.lit(0)).alias("hits"))
    one = per.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.count_if(F.col("hits") / F.col("n") < floor).alias("collapsed"))
    one = one.withColumn("lower", wilson(F.col("hits"), F.col("n")))
    return one.withColumn("passed", F.coalesce((F.col("lower") >= least) & (F.col("collapsed") == 0), F.lit(False)))


def tool_completion(calls: DataFrame, evidence: DataFrame, completed: Column, least: float, id_col: str = "id", refs: str = "evidence") -> DataFrame:
    """n, hits, lower, unexplained, passed: the completion rate's lower bound reaches `least`, and every call that failed has
    evidence, all of which resolves."""
    done = rate(calls, completed).select("n", "hits", "lower")
    failed = provenance(calls.where(~F.coalesce(completed, F.lit(False))), evidence, id_col, refs).select((F.col("n") - F.col("covered")).alias("unexplained"))
    both = done.crossJoin(F.broadcast(failed))  # one row each
    return both.withColumn("passed", F.coalesce((F.col("lower") >= least) & (F.col("unexplained") == 0), F.lit(False)))


def personalisation(answers: DataFrame, correct: Column, asker: list[str], told: list[str], least: float = 0.95) -> DataFrame:
    """n, hits, rate, disclosures, passed: enough answers are right, and none tells what belongs to another namespace. told: the
    columns that say whose memory an answer used, beside asker; all null: none."""
    used = reduce(Column.__or__, [F.col(c).isNotNull() for c in told])
    same = reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(t)) for a, t in zip(asker, told, strict=True)])
    one = answers.agg(F.count("*").alias("n"), F.coalesce(F.sum(correct.cast("long")), F.lit(0)).alias("hits"), F.count_if(used & ~same).alias("disclosures"))
    return one.withColumn("rate", F.col("hits") / F.col("n")).withColumn("passed", F.coalesce((F.col("rate") >= least) & (F.col("disclosures") == 0), F.lit(False)))

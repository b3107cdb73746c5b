"""Versioned memory as an event log: folding, conflicts, trust, snapshots, and access.

Operations: commit_seq, op_index (order within a commit), namespace_id, memory_id, operation, value, expected_revision.
``create`` and ``replace`` set a value, ``supersede``, ``reject`` and ``delete`` end it, ``restore`` brings back the state before
the latest delete. A null order column or memory_id is no operation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.operators.graphs import closure

# Evidence classes, most trusted first.
TRUST = ("user_correction", "user_statement", "tool_observation", "repeated_observation", "session_event", "model_inference")
ENDED = {"supersede": "superseded", "reject": "rejected", "delete": "deleted"}


class Memory:
    """Memory tables behind the namespace filter: whoever holds a Memory reads one user's rows with one character, whatever the
    table. Null namespaces match nothing, and a table without both columns is refused."""

    def __init__(self, tables: dict[str, DataFrame], user: str, character: str):
        for name, df in tables.items():
            if not {"user_id", "character_id"} <= set(df.columns):
                raise ValueError(f"{name} has no namespace")
        self._read = lambda name: in_namespace(tables[name], user, character)

    def __getitem__(self, name: str) -> DataFrame:
        return self._read(name)

    def sql(self, query: str) -> DataFrame:
        """A query over the tables by name, each already filtered: {records} stands for the table records."""
        names = set(re.findall(r"\{(\w+)\}", query))
        frames = {n: self[n] for n in names}
        return next(iter(frames.values())).sparkSession.sql(query, **frames)


def in_namespace(table: DataFrame, user: str, character: str) -> DataFrame:
    """One user's rows with one character. Null namespaces match nothing."""
    return table.where((F.col("user_id") == user) & (F.col("character_id") == character))


def disclosed(read: DataFrame, user: str, character: str) -> DataFrame:
    """Rows of an answer that belong to another namespace, or to none: there must be none."""
    return read.where(~F.coalesce((F.col("user_id") == user) & (F.col("character_id") == character), F.lit(False)))


def states(ops: DataFrame) -> DataFrame:
    """Every operation with revision, status and value after it. A restore takes the state that the latest delete ended: among
    operations other than restores, the last one before it that isn't a delete."""
    own = W.partitionBy("namespace_id", "memory_id").orderBy("commit_seq", "op_index")
    past = own.rowsBetween(W.unboundedPreceding, W.currentRow)
    status = F.coalesce(F.create_map(*[F.lit(x) for kv in ENDED.items() for x in kv])[F.col("operation")], F.lit("active"))
    holds = ~F.col("operation").isin("delete", "restore")
    set_now = F.when(F.col("operation").isin("create", "replace"), F.struct(F.col("value")))
    o = ops.where("memory_id is not null and commit_seq is not null").withColumn("revision", F.row_number().over(own))
    o = o.withColumn("_value", F.last(set_now, ignorenulls=True).over(past)["value"])
    o = o.withColumn("_state", F.last(F.when(holds, status), ignorenulls=True).over(past))
    return o.withColumn("status", F.when(F.col("operation") == "restore", F.coalesce("_state", F.lit("active"))).otherwise(status)).withColumn("current", F.col("_value")).drop("_value", "_state")


def fold(ops: DataFrame, live_only: bool = True) -> DataFrame:
    """namespace_id, memory_id, revision, status, value: the state after the last operation."""
    last = states(ops).groupBy("namespace_id", "memory_id").agg(F.max_by(F.struct("revision", "status", F.col("current").alias("value")), "revision").alias("s")).select("namespace_id", "memory_id", "s.*")
    return last.where("status = 'active'") if live_only else last


def latest(log: DataFrame, keys: list[str], order: list[str], tombstone: Column) -> DataFrame:
    """The last row of each key, deleted keys apart: one aggregate that combines before it shuffles."""
    cols = log.columns
    out = log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_x")).select("_x.*")
    return out.where(~F.coalesce(tombstone, F.lit(False)))


def conflicts(ops: DataFrame) -> DataFrame:
    """Operations whose expected revision isn't the one they met; null expects that there is none yet."""
    met = F.col("revision") - 1
    return states(ops).withColumn("met", met).where(F.coalesce("expected_revision", F.lit(0)) != met)


def not_superseded(records: DataFrame) -> DataFrame:
    """Records that no record of their namespace supersedes; the others stay in the table."""
    gone = records.select("namespace_id", F.explode("supersedes").alias("memory_id")).distinct()
    return records.join(gone, ["namespace_id", "memory_id"], "left_anti")


def most_trusted(rows: DataFrame, keys: list[str], kind: str, value: str, ranks: tuple[str, ...] = TRUST) -> DataFrame:
    """keys, rank, value, unresolved: what the most trusted class says; null and unresolved if it says several things."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ranks)), F.col(kind)), F.lit(0)), F.lit(len(ranks) + 1))
    by_rank = rows.groupBy(*keys, rank.cast("int").alias("rank")).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    best = by_rank.groupBy(*keys).agg(F.min_by(F.struct("rank", "lo", "hi"), "rank").alias("b")).select(*keys, "b.*")
    tied = F.col("lo") != F.col("hi")
    return best.select(*keys, "rank", F.when(~tied, F.col("lo")).alias(value), tied.alias("unresolved"))


def priority(score: Column, age_days: Column, importance: Column, half_life_days: float = 30.0, floor: float = 0.1) -> Column:
    """Retrieval priority: decays with age, less the more important it is, never below the floor. Never deletes."""
    return score * F.greatest(F.lit(floor), F.pow(F.lit(0.5), age_days * (1 - importance) / half_life_days))


def without_deleted(index: DataFrame, ops: DataFrame) -> DataFrame:
    """Index rows whose memory isn't deleted now."""
    gone = fold(ops, live_only=False).where("status = 'deleted'").select("namespace_id", "memory_id")
    return index.join(gone, ["namespace_id", "memory_id"], "left_anti")


def reachable(edges: DataFrame, rounds: int = 100_000) -> DataFrame:
    """node, ancestor, depth (least, at most `rounds`) over child-parent edges of a commit graph with any number of parents."""
    return closure(edges, rounds)


def snapshot(ops: DataFrame, at: int) -> DataFrame:
    """fold() as of a commit."""
    return fold(ops.where(F.col("commit_seq") <= at))


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """namespace_id, memory_id, change of two snapshots: added, removed, changed."""
    keys = ["namespace_id", "memory_id"]
    both = old.select(*keys, F.struct("revision", "value").alias("o")).join(new.select(*keys, F.struct("revision", "value").alias("n")), keys, "full_outer")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    return both.select(*keys, change.alias("change")).where("change is not null")


def stale(projection: DataFrame, ops: DataFrame) -> DataFrame:
    """Rows of a derived table (namespace_id, memory_id, revision) that aren't at the canonical revision."""
    now = fold(ops).select("namespace_id", "memory_id", F.col("revision").alias("_now"))
    both = projection.join(now, ["namespace_id", "memory_id"], "left")
    return both.where(~F.col("revision").eqNullSafe(F.col("_now"))).drop("_now")


def access(requests: DataFrame, users: DataFrame, grants: DataFrame) -> DataFrame:
    """requests with allowed. A valid token of a known subject, an active grant that hasn't expired, and the owner's own data;
    anything else, unknowns included, is denied. requests: subject, token_valid, owner_id, at; users: subject, user_id;
    grants: user_id, status, expires_at."""
    u = users.select("subject", F.col("user_id").alias("_user")).distinct()
    g = grants.where("status = 'active'").groupBy(F.col("user_id").alias("_user")).agg(F.max(F.coalesce("expires_at", F.lit("9999-12-31").cast("timestamp"))).alias("_until"))
    own = requests.join(u, "subject", "left").join(g, "_user", "left")
    ok = F.col("token_valid") & (F.col("owner_id") == F.col("_user")) & (F.col("at") < F.col("_until"))
    return own.withColumn("allowed", F.coalesce(ok, F.lit(False))).drop("_user", "_until")


def on_allowlist(identities: DataFrame, allowlist: DataFrame, email: str = "email") -> DataFrame:
    """Identities whose exact address is listed; entries with a wildcard list nobody."""
    own = allowlist.where(~F.contains(F.col(email), F.lit("*"))).select(email)
    return identities.join(own, email, "left_semi")

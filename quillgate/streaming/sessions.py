"""Event semantics over streams: deduplication, order, lifecycles, correlation, late data, session timeouts.

State is per key and bounded: a sequence state holds one number and a bitmap of the replay window, a lifecycle one letter, a
session two times and a count. All go behind the watermark: the first two by timers, when a key was silent for `idle_ms`. The RocksDB state store is needed for transformWithState.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamReader
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a key may be silent before its state goes.
IDLE_MS = 3_600_000


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def unique_calls(calls: DataFrame, ts: str = "ts", key: str = "idempotency_key", within: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark: a repeated side-effect call is dropped."""
    return calls.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


class _Expiring(StatefulProcessor):
    """State that goes when a key was silent, in event time, for idle_ms. Each batch of a key sets a timer; one that a later batch
    has outrun does nothing."""

    def __init__(self, ts: str, idle_ms: int):
        self.ts, self.idle_ms = ts, idle_ms

    def held(self, rows: list[pd.DataFrame], default: tuple) -> tuple:
        """The state, unless the key's new rows all come after it was due: its timer may not have had its turn yet."""
        if not rows or not self.state.exists():
            return default
        state = self.state.get()
        return state if min(int(b[self.ts].min().timestamp() * 1000) for b in rows) <= state[0] else default

    def due(self, rows: list[pd.DataFrame], before: int | None) -> int:
        """When the key expires, with a timer for it."""
        last = max(int(b[self.ts].max().timestamp() * 1000) for b in rows) + self.idle_ms
        last = last if before is None else max(last, before)
        self.handle.registerTimer(last)
        return last

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.state.exists() and self.state.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class Sequences(_Expiring):
    """Verdict of each frame by its session's highest sequence: ok, gap, duplicate, late, or out of window. The bitmap remembers
    which of the last `size` sequences came."""

    def __init__(self, size: int, ts: str, idle_ms: int):
        super().__init__(ts, idle_ms)
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", StructType([StructField("due", LongType()), StructField("top", LongType()), StructField("bits", BinaryType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        rows = [b for b in rows if len(b)]
        due, top, bits = self.held(rows, (None, None, b""))
        bits, mask = int.from_bytes(bits, "little"), (1 << self.size) - 1
        for b in rows:
            out = []
            for s in b.sequence:
                s = int(s)
                if top is None or s > top:
                    verdict = "ok" if top is None or s == top + 1 else "gap"
                    bits = 1 if top is None else ((bits << (s - top)) & mask if s - top <= self.size else 0) | 1
                    top = s
                elif top - s >= self.size:
                    verdict = "out of window"
                elif bits >> (top - s) & 1:
                    verdict = "duplicate"
                else:
                    verdict, bits = "late", bits | 1 << (top - s)
                out.append((key[0], s, verdict))
            yield pd.DataFrame(out, columns=["session_id", "sequence", "verdict"])
        if rows:
            self.state.update((self.due(rows, due), top, bits.to_bytes(-(-self.size // 8), "little")))


def sequence_verdicts(frames: DataFrame, size: int = 63, ts: str = "ts", idle_ms: int = IDLE_MS, delay: str = "1 minute") -> DataFrame:
    """session_id, sequence, verdict of a stream of frames (session_id, sequence, ts), in order of arrival. A session's state goes
    when the watermark, `delay` behind the latest frame, has passed its last frame by idle_ms."""
    own = frames.select("session_id", "sequence", ts).withWatermark(ts, delay)
    return own.groupBy("session_id").transformWithStateInPandas(Sequences(size, ts, idle_ms), "session_id string, sequence long, verdict string", "Append", "EventTime")


#: State and letter to next state; an end is a state without successors.
LIFE = {("", "tool.requested"): "r", ("r", "tool.started"): "s", ("s", "tool.progress"): "p", ("p", "tool.progress"): "p", **{(a, f"tool.{b}"): b for a in "sp" for b in ("completed", "failed")}}


class Lifecycles(_Expiring):
    """ok or violation for each event of a tool call; a violation leaves the state as it was."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", StructType([StructField("due", LongType()), StructField("at", StringType()), StructField("trace", StringType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        rows = [b for b in rows if len(b)]
        due, at, trace = self.held(rows, (None, "", None))
        for b in rows:
            out = []
            for kind, own in zip(b.type, b.trace_id, strict=True):
                new = LIFE.get((at, kind)) if trace in (None, own) else None
                out.append((key[0], kind, "violation" if new is None else "ok"))
                at, trace = (at, trace) if new is None else (new, own)
            yield pd.DataFrame(out, columns=["call_id", "type", "verdict"])
        if rows:
            self.state.update((self.due(rows, due), at, trace))


def lifecycle_verdicts(events: DataFrame, ts: str = "ts", idle_ms: int = IDLE_MS, delay: str = "1 minute") -> DataFrame:
    """call_id, type, verdict of a stream of tool events (call_id, type, trace_id, ts); state goes as in sequence_verdicts()."""
    own = events.select("call_id", "type", "trace_id", ts).withWatermark(ts, delay)
    return own.groupBy("call_id").transformWithStateInPandas(Lifecycles(ts, idle_ms), "call_id string, type string, verdict string", "Append", "EventTime")


def limited(reader: DataStreamReader, files: int | None = None, size: str | None = None) -> DataStreamReader:
    """A file reader that takes so many files, or bytes, into a micro-batch: what waits stays in the source, not in a queue."""
    for k, v in (("maxFilesPerTrigger", files), ("maxBytesPerTrigger", size)):
        reader = reader if v is None else reader.option(k, v)
    return reader


def correlated(audio: DataFrame, events: DataFrame, within: str = "30 seconds") -> DataFrame:
    """Frames and events of one session and trace within a time of each other: an inner join whose state watermarks bound."""
    a = audio.withWatermark("ts", within).alias("a")
    e = events.select("session_id", "trace_id", F.col("ts").alias("event_ts"), "type").withWatermark("event_ts", within).alias("e")
    on = F.expr(f"a.session_id = e.session_id AND a.trace_id = e.trace_id AND e.event_ts BETWEEN a.ts - INTERVAL {within} AND a.ts + INTERVAL {within}")
    return a.join(e, on).select("a.*", "e.event_ts", "e.type")


def timed_out_sessions(beats: DataFrame, gap: str = "30 seconds", delay: str = "1 minute") -> DataFrame:
    """session_id, start, end, beats of sessions that ended by silence, once the watermark has passed."""
    w = F.session_window("ts", gap)
    return beats.withWatermark("ts", delay).groupBy("session_id", w).agg(F.count("*").alias("beats")).select("session_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "beats")


def late_counts(frames: DataFrame, delay_ms: int) -> DataFrame:
    """session_id, on_time, late so far: lateness is told before any watermark drops a row. For update or complete mode.
    frames: session_id, presented, arrived."""
    late = F.unix_millis("arrived") - F.unix_millis("presented") > delay_ms
    return frames.groupBy("session_id").agg(F.count_if(~late).alias("on_time"), F.count_if(late).alias("late"))


def progress_batches(events: DataFrame, batch_id: int) -> DataFrame:
    """For foreachBatch: of each call's progress events in a micro-batch only the last stays."""
    last = events.where("type = 'tool.progress'").groupBy("call_id").agg(F.max_by(F.struct(*events.columns), "sequence").alias("x")).select("x.*")
    return events.where("type <> 'tool.progress'").unionByName(last)

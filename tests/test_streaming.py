import json
import os

import pytest

from quillgate.streaming import sessions as S


@pytest.fixture
def stream(spark, tmp_path):
    """A stream over batches of rows, one file each, and a way to run it to its end."""
    S.use_rocksdb(spark)

    def make(schema, *batches):
        d = tmp_path / "in"
        d.mkdir()
        for i, rows in enumerate(batches):
            f = d / f"{i:03}.json"
            f.write_text("\n".join(map(json.dumps, rows)))
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))  # batches come by time of change
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(d))

    def run(df, mode="append"):
        q = df.writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return [tuple(r) for r in spark.table("out").collect()]

    return make, run


def at(s):
    return f"2026-01-01T00:{s // 60:02}:{s % 60:02}Z"


def test_repeated_calls_are_dropped(stream):
    make, run = stream
    df = make("idempotency_key string, ts timestamp", [{"idempotency_key": "a", "ts": at(0)}, {"idempotency_key": "a", "ts": at(1)}], [{"idempotency_key": "a", "ts": at(2)}, {"idempotency_key": "b", "ts": at(3)}])
    assert sorted(x[0] for x in run(S.unique_calls(df))) == ["a", "b"]


FRAME = "session_id string, sequence long, ts timestamp"


def frames(at_second, *q, session="s"):
    return [{"session_id": session, "sequence": x, "ts": at(at_second)} for x in q]


def test_sequences_over_batches(stream):
    make, run = stream
    got = run(S.sequence_verdicts(make(FRAME, frames(0, 0, 1), frames(1, 3), frames(2, 3), frames(3, 2), frames(4, 100), frames(5, 5)), 10))
    assert sorted(got, key=str) == sorted([("s", 0, "ok"), ("s", 1, "ok"), ("s", 3, "gap"), ("s", 3, "duplicate"), ("s", 2, "late"), ("s", 100, "gap"), ("s", 5, "out of window")], key=str)


def test_wide_windows(stream):
    make, run = stream
    got = run(S.sequence_verdicts(make(FRAME, frames(0, 0), frames(1, 199), frames(2, 1), frames(3, 1)), 200))
    assert sorted(v for _, _, v in got) == ["duplicate", "gap", "late", "ok"]


def test_idle_state_is_gone(stream):
    """Once the watermark is past a session's last frame by the idle time, its numbers start anew; a busy one goes on."""
    make, run = stream
    batches = [frames(0, 7) + frames(0, 7, session="busy"), frames(100, 8, session="busy"), frames(200, 9, session="busy"), frames(300, 3) + frames(300, 10, session="busy"), frames(301, 3)]
    got = run(S.sequence_verdicts(make(FRAME, *batches), 10, idle_ms=120_000, delay="1 second"))
    assert sorted(got) == sorted([("s", 7, "ok"), ("s", 3, "ok"), ("s", 3, "duplicate"), *[("busy", n, "ok") for n in (7, 8, 9, 10)]])


def test_timers_clear_state():
    """A timer that is due clears the state; one that a later batch has outrun doesn't."""
    from types import SimpleNamespace

    class State:
        value = (500, 1, b"")

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def clear(self):
            self.value = None

    p = S.Sequences(10, "ts", 100)
    p.state = State()
    fire = lambda ms: list(p.handleExpiredTimer(("s",), None, SimpleNamespace(getExpiryTimeInMs=lambda: ms)))
    assert fire(400) == [] and p.state.exists()
    assert fire(500) == [] and not p.state.exists()


def test_lifecycles(stream):
    make, run = stream
    e = lambda s, c, *kinds: [{"call_id": c, "type": f"tool.{k}", "trace_id": "t", "ts": at(s)} for k in kinds]
    batches = [e(0, "x", "requested"), e(1, "x", "started"), e(2, "x", "completed"), e(3, "y", "progress"), e(4, "x", "failed"), e(400, "z", "requested"), e(500, "x", "requested")]
    got = run(S.lifecycle_verdicts(make("call_id string, type string, trace_id string, ts timestamp", *batches), idle_ms=60_000, delay="1 second"))
    want = [("x", "tool.requested", "ok"), ("x", "tool.started", "ok"), ("x", "tool.completed", "ok"), ("y", "tool.progress", "violation"), ("x", "tool.failed", "violation"), ("z", "tool.requested", "ok"), ("x", "tool.requested", "ok")]
    assert sorted(got) == sorted(want)  # the call's state had gone before its name came again


def test_silent_sessions_end_behind_the_watermark(stream):
    make, run = stream
    b = lambda *s: [{"session_id": k, "ts": at(x)} for k, x in s]
    df = make("session_id string, ts timestamp", b(("a", 0), ("a", 10)), b(("b", 300)), b(("c", 900)))
    assert sorted((x[0], x[3]) for x in run(S.timed_out_sessions(df))) == [("a", 2), ("b", 1)]


def test_late_rows_are_counted(stream):
    make, run = stream
    f = [{"session_id": "s", "presented": at(0), "arrived": at(x)} for x in (0, 1, 9)]
    got = run(S.late_counts(make("session_id string, presented timestamp, arrived timestamp", f), 2000), "complete")
    assert got == [("s", 2, 1)]


def test_channels_meet(spark, stream):
    make, run = stream
    df = make("session_id string, trace_id string, ts timestamp, type string", [{"session_id": "s", "trace_id": "t", "ts": at(0), "type": "x"}], [{"session_id": "s", "trace_id": "u", "ts": at(5), "type": "y"}])
    got = run(S.correlated(df.select("session_id", "trace_id", "ts"), df))
    assert len(got) == 2


def test_progress_is_coalesced(spark):
    df = spark.createDataFrame([("c", 1, "tool.progress"), ("c", 2, "tool.progress"), ("c", 3, "tool.completed")], "call_id string, sequence int, type string")
    assert sorted(r["sequence"] for r in S.progress_batches(df, 0).collect()) == [2, 3]

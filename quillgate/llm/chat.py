"""Chat formatting: an event log is folded into messages, which a template renders.

An event has ``conv_id, seq, event, msg_id, role, text``. ``message`` opens a message, ``delta`` appends to it, ``edit``
replaces its text so far, ``regenerate`` empties it and drops every message that began between its own start and the
regeneration (they answered the reply that is gone). The log is partitioned by conversation and message, each message is
folded on its own, and only folded messages meet by conversation: a conversation's rendering is one value by nature, but
its raw log (one event for each streamed token) never has to fit in one task's sort.

Defined cases: a null text is empty; a null role is empty and never trained on; an event without msg_id is a whole
message of its own; equal seq is ordered by role, then text, and identical rows stay separate turns; a null conv_id is a
conversation; an empty log gives no rows. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    r"""``<``, k backslashes, ``|`` gets one more backslash, so no text holds ``<|``; unescape() takes it away again."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    """A role ends at the first line break and must hold no control string."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return role.replace("%3C", "<").replace("%0A", "\n").replace("%25", "%")


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, start (seq of the opening event), role, text of every message that is left."""
    e = events.select("conv_id", "seq", "event", "msg_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = e.where("msg_id is null").select("conv_id", F.col("seq").alias("start"), "role", "text", F.lit(None).cast(e.schema["seq"].dataType).alias("again"))
    restarts = F.col("event").isin("edit", "regenerate")
    parts = F.array_sort(F.collect_list(F.struct("seq", "role", "text")))
    folded = (
        e.where("msg_id is not null")
        .groupBy("conv_id", "msg_id")
        .agg(F.min("seq").alias("start"), F.min_by("role", F.struct("seq", F.col("event") != "message")).alias("role"), parts.alias("parts"), F.max(F.when(restarts, F.col("seq"))).alias("reset"), F.max(F.when(F.col("event") == "regenerate", F.col("seq"))).alias("again"))
        .withColumn("text", F.array_join(F.transform(F.filter("parts", lambda p: p["seq"] >= F.coalesce("reset", "start")), lambda p: p["text"]), ""))
    )
    messages = whole.unionByName(folded.select(whole.columns))
    before = W.partitionBy("conv_id").orderBy("start", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    return messages.withColumn("_gone", F.coalesce(F.max("again").over(before) > F.col("start"), F.lit(False))).where("not _gone").select("conv_id", "start", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask: the code point spans of the trained texts in formatted."""
    head = F.concat(F.lit(START), escape_role("role"), F.lit("\n"))
    m = messages.select("conv_id", "start", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"))
    piece = F.concat("head", "body", F.lit(END + "\n"))
    order = W.partitionBy("conv_id").orderBy("start", "role", "text")
    m = m.select("conv_id", "role", F.row_number().over(order).alias("n"), F.char_length("body").alias("len"), piece.alias("piece"), (F.sum(F.char_length(piece).cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.char_length("body") - len(END) - 1).alias("at"))
    span = F.when(F.col("role") == TRAINED, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("len")).alias("end")))
    rows = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("p"), F.array_sort(F.collect_list(span)).alias("loss_mask"))
    return rows.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), "loss_mask")


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold_events(events))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation, as they went in."""
    turns = []
    for block in formatted.split(END + "\n")[:-1]:
        role, _, text = block.removeprefix(START).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


def digests(chats: DataFrame) -> DataFrame:
    """What the output says, read from formatted and loss_mask alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, mask in zip(b.column("formatted").to_pylist(), b.column("loss_mask").to_pylist(), strict=True):
                turns, trained, n = read_back(text), hashlib.sha256(), 0
                said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                for s in mask:
                    own = unescape(text[s["start"] : s["end"]])
                    n += len(own)
                    trained.update(own.encode())
                rows.append((len(turns), said.hexdigest(), n, trained.hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch([b.column("conv_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], DIGEST)

    return chats.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
#: Code points of one streamed piece.
PIECE = 64


def streamed(rows: DataFrame) -> DataFrame:
    """Whole turns (conv_id, turn, role, text) as the events they come as: a message that opens the turn, then a delta for each
    piece of its text. Each row is a message of its own, identical ones too."""
    own = rows.select("conv_id", "turn", "role", "text", F.hex(F.monotonically_increasing_id()).alias("msg_id"))
    n = F.ceil(F.char_length(F.coalesce("text", F.lit(""))) / PIECE).cast("int")
    piece = lambda i: F.substring(F.col("text"), (i - 1) * PIECE + 1, F.lit(PIECE))
    event = lambda i: F.struct(F.struct(F.col("turn"), i.alias("part")).alias("seq"), F.when(i == 0, "message").otherwise("delta").alias("event"), F.when(i > 0, piece(i)).alias("text"))
    e = own.select("conv_id", "msg_id", "role", F.explode(F.transform(F.sequence(F.lit(0), n), event)).alias("e"))
    return e.select("conv_id", "e.seq", "e.event", "msg_id", "role", "e.text")

r"""LM scoring: a causal self-attention model over subword ids, and a unigram baseline over words.

Texts are read twice: once to count the words of training rows, once to cut all texts into subword ids, which are kept in the
shared folder with each text's word figures. The model (see attention) learns from windows of the training rows' ids. A bounded
number of them (about `WARM_TOKENS` ids) starts it on the driver and gives the groups of ids with like neighbours; then the rounds learn
from every window of the training rows, each window in one of `ROUNDS` rounds. Each task trains a copy of the model for every
`GROUP_TOKENS` ids or so that it reads, where it reads them, and the copies are averaged. Ids' counts, from which classes and their members' shares come, are those of all training rows.

Words are told apart by exact keys in numpy tables. The `HOT_WORDS` most frequent words of up to 15 bytes are broadcast: their size is
fixed. What is left, the rare words of each document, meets the word table in a join, in which no word is frequent.

Defined cases: a null text is empty and consists of the end alone; with no training rows N and V are 0 and the model is
untrained; repeated rows are rows of their own; a null doc_id is never held out; a long text is scored window by window like any
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgate.llm import attention
from quillgate.llm.attention import STEP, Model, Vocabulary, windows
from quillgate.llm.common import arrow_runs, held_out, stored
from quillgate.llm.token_files import CHARS, OUT_BYTES, WordIds, binary, flat_ids, id_counts, word_ids
from quillgate.llm.wordtable import KIND, LOWER, SHORT, Table, keys, put, runs, spelled, texts_of, words

KEPT_WORDS, HOT_WORDS = 1_000_000, 1 << 18
#: Ids that the driver starts the model with; ids that a copy learns from; rounds that share all windows.
WARM_TOKENS, GROUP_TOKENS, ROUNDS = 1 << 20, 1 << 21, 2
#: Batches of the start; windows of a batch; learning rates of the start and of each round.
WARM_STEPS, WINDOWS, RATES = 800, 96, ((0.01, 0.002), (0.003, 0.001), (0.001, 0.0002))
CHUNK, FAN = 1 << 13, 64
SCORED_IDS = 1 << 18


def _cut(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased bytes, beginnings, sizes and texts of the words, a run at a time."""
    for a, z in runs(data, offsets, CHARS):
        low = LOWER[data[a:z]]
        start, size = words(KIND[low], offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, z)] - a)
        yield low, start, size, np.searchsorted(offsets, start + a, "right") - 1


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (bytes), n over the rows of docs. A worker's table is emptied when it is full."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n, long = Table(), np.zeros(1 << 14, np.int64), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for a in range(1, table.n + 1, 100_000):
                z = min(a + 100_000, table.n + 1)
                yield pa.record_batch({"word": binary(*spelled(table.a[a:z], table.b[a:z])), "n": n[a:z]})
            yield pa.record_batch({"word": pa.array(list(long), pa.binary()), "n": pa.array(list(long.values()), pa.int64())})

        for b in batches:
            for low, start, size, _ in _cut(*texts_of(b.column(0))):
                short = size <= SHORT
                row = table.rows_of(*keys(low, start[short], size[short]))
                if table.n >= len(n):
                    n = put(n, table.n, np.zeros(1, np.int64))
                seen = np.bincount(row, minlength=table.n + 1)
                n[: len(seen)] += seen
                long.update(low[x : x + k].tobytes() for x, k in zip(start[~short].tolist(), size[~short].tolist(), strict=True))
                if table.n + len(long) > KEPT_WORDS:
                    yield from out()
                    table, n, long = Table(), np.zeros(1 << 14, np.int64), Counter()
        yield from out()

    own = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    return own.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the most frequent words and log10 of their counts plus one. The least count comes from a histogram, so no
    more than HOT_WORDS reach the driver."""
    short, level = counts.where(F.octet_length("word") <= SHORT), F.floor(F.log2("n") * 16)
    least, room = 0, HOT_WORDS
    for r in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some hundred levels
        room -= r["count"]
        if room < 0:
            least = r["level"] + 1
            break
    found = short.where(level >= least).select("word", "n").toArrow()
    data, offsets = texts_of(found["word"])
    return *keys(data, offsets[:-1], np.diff(offsets)), np.log10(found["n"].to_numpy() + 1)


FIRST = "row long, doc_id long, training boolean, ids binary, n_words long, n_hot long, log_hot double, rare array<binary>"


def read_texts(docs: DataFrame, tokenizer_path: str, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """row, doc_id, training, ids (the end not included), n_words, n_hot, log_hot, rare (the words that aren't hot)."""
    held = docs.sparkSession.sparkContext.broadcast(hot)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, table = word_ids(tokenizer_path), Table()
        a, b, logs = held.value
        table.add(a, b)
        logs = np.concatenate(([0.0], logs))
        for batch in batches:
            for own in arrow_runs(batch, "text", OUT_BYTES):
                data, offsets = texts_of(own.column("text"))
                ids, n = tok.encode_bytes(data, offsets)
                n_words, n_hot, log_hot = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros(len(n))
                rare, sizes, texts = [], [], []
                for low, start, size, text in _cut(data, offsets):
                    row = np.zeros(len(start), np.int32)
                    short = size <= SHORT
                    row[short] = table.find(*keys(low, start[short], size[short]))
                    n_words += np.bincount(text, minlength=len(n))
                    n_hot += np.bincount(text[row > 0], minlength=len(n))
                    log_hot += np.bincount(text, logs[row], len(n))
                    s, k = start[row == 0], size[row == 0]
                    rare.append(low[np.repeat(s - np.cumsum(k) + k, k) + np.arange(k.sum())])
                    sizes.append(k)
                    texts.append(text[row == 0])
                each = np.bincount(np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64), minlength=len(n))
                flat, sizes = (np.concatenate(rare), np.concatenate(sizes)) if rare else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))), pa.int32()), binary(flat, sizes))
                yield pa.record_batch({"row": own.column("row"), "doc_id": own.column("doc_id"), "training": own.column("training"), "ids": binary(ids, n), "n_words": n_words, "n_hot": n_hot, "log_hot": log_hot, "rare": lists})

    return docs.mapInArrow(work, FIRST)


def _with_end(flat: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(flat.astype(np.int64), at[1:], end), np.diff(at) + 1


def draw_windows(rows: DataFrame, width: int, end: int, share: float) -> DataFrame:
    """u, window (ids as int32, see windows()): about that share of the windows of rows (row, ids), drawn by row and place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in arrow_runs(batch, "ids", SCORED_IDS * width):
                ids, sizes = _with_end(*flat_ids(b.column("ids"), width), end)
                steps = -(-sizes // STEP)
                row = np.repeat(b.column("row").to_numpy().astype(np.uint64), steps)
                place = (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)).astype(np.uint64)
                h = (row * np.uint64(0x9E3779B97F4A7C15) + place + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
                h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
                u = (h >> np.uint64(11)) / float(1 << 53)
                mine = np.flatnonzero(u < share)
                raw, _ = windows(ids, sizes, mine)
                yield pa.record_batch({"u": u[mine], "window": binary(raw.ravel(), np.full(len(mine), raw.shape[1]))})

    return rows.select("row", "ids").mapInArrow(work, "u double, window binary")


def _raw(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i4").reshape(-1, attention.WIDTH + 1)


def trained_round(drawn: DataFrame, model: Model, vocabulary: Vocabulary, number: int) -> Model:
    """The mean, weighted by windows, of copies of the model that each learnt from some of the round's windows. No window is shuffled."""
    spark = drawn.sparkSession
    held = spark.sparkContext.broadcast((model, vocabulary))
    rates = RATES[min(number, len(RATES) - 1)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = held.value
        task, copies, own, n = TaskContext.get().partitionId(), 0, [], 0

        def copy() -> pa.RecordBatch:
            raw, m = np.concatenate(own), Model().with_flat(model.flat())
            m.train(raw, vocabulary, -(-len(raw) // WINDOWS), WINDOWS, rates, seed=task * 1000 + copies)
            flat = m.flat().astype(np.float64) * len(raw)
            cuts = range(0, len(flat), CHUNK)
            same = lambda x, kind: pa.array([x] * len(cuts), kind)
            return pa.record_batch({"part": pa.array(range(len(cuts)), pa.int32()), "fan": same((task + copies) % FAN, pa.int32()), "n": same(len(raw), pa.int64()), "sums": pa.array([flat[a : a + CHUNK].tobytes() for a in cuts], pa.binary())})

        for b in batches:
            if len(b):
                own.append(texts_of(b.column(0))[0].view("<i4").reshape(-1, attention.WIDTH + 1))
                n += len(b)
            if n * STEP >= GROUP_TOKENS:
                yield copy()
                copies, own, n = copies + 1, [], 0
        if n:
            yield copy()

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in b.sums)
        return pd.DataFrame({"part": [key[0]], "fan": [0], "n": [int(b.n.sum())], "sums": [total.tobytes()]})

    shape = "part int, fan int, n long, sums binary"
    own = drawn.where(F.floor(F.col("u") * F.lit(2.0**40)) % ROUNDS == number - 1)
    copies = own.select("window").mapInArrow(learn, shape)
    # copies of the model are added FAN by FAN, part by part; what reaches the driver is one model
    got = copies.groupBy("part", "fan").applyInPandas(add, shape).groupBy("part").applyInPandas(add, shape).orderBy("part").collect()
    if not got:
        return model
    return Model().with_flat(np.concatenate([np.frombuffer(x["sums"]) / x["n"] for x in got]).astype(np.float32))


def train(rows: DataFrame, n_texts: int, tokenizer_path: str) -> tuple[Model, Vocabulary, int]:
    """Model, vocabulary and the id of the end of a text. rows: row, ids of the training rows, stored."""
    tok = WordIds(tokenizer_path).tokenizer
    size, end = tok.get_vocab_size(), tok.token_to_id("<|endoftext|>")
    width = 2 if size <= 1 << 16 else 4
    counts = id_counts(rows, size, width).astype(float)
    counts[end] += n_texts
    total = max(counts.sum(), 1.0)
    warm = min(1.0, WARM_TOKENS / total)
    start = _raw(r["window"] for r in draw_windows(rows, width, end, warm).orderBy("u").collect())
    vocabulary = Vocabulary.of(counts, start[start >= 0])
    model = Model(0, vocabulary, counts)
    model.train(start, vocabulary, WARM_STEPS, WINDOWS, RATES[0])
    drawn = draw_windows(rows, width, end, 1.0)
    for number in range(1, ROUNDS + 1):
        model = trained_round(drawn, model, vocabulary, number)
    return model, vocabulary, end


def score(docs: DataFrame, tokenizer_path: str, is_training: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    flag = ~held_out(id_col, 7) if is_training is None else is_training
    training = docs.where(flag)
    counts = stored(word_counts(training, text_col), "word-counts")
    n_texts = training.count()
    x = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    n_all, n_distinct = x["n"] + n_texts, x["v"] + (n_texts > 0)
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(flag, F.lit(False)).alias("training"), F.col(text_col).alias("text"))
    first = stored(read_texts(keyed, tokenizer_path, hot_words(counts)), "lm-texts")
    held = docs.sparkSession.sparkContext.broadcast(train(first.where("training").select("row", "ids"), n_texts, tokenizer_path))
    width = 2 if WordIds(tokenizer_path).tokenizer.get_vocab_size() <= 1 << 16 else 4

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary, end = held.value
        for b in batches:
            for own in arrow_runs(b, "ids", SCORED_IDS * width):
                scores = model.score(*_with_end(*flat_ids(own.column("ids"), width), end), vocabulary)
                yield pa.RecordBatch.from_arrays([*own.drop_columns(["ids"]).columns, pa.array(scores)], ["row", "doc_id", "n_words", "n_hot", "log_hot", "score"])

    scored = first.select("row", "doc_id", "n_words", "n_hot", "log_hot", "ids").mapInArrow(work, "row long, doc_id long, n_words long, n_hot long, log_hot double, score double")
    rare = first.select("row", F.explode("rare").alias("word")).join(counts, "word")
    rare = rare.groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("log_rare"))
    n_tokens = F.col("n_words") + 1
    base = F.col("log_hot") + F.coalesce("log_rare", F.lit(0.0)) + math.log10(n_texts + 1) - n_tokens * math.log10(n_all + n_distinct + 1)
    known = F.col("n_hot") + F.coalesce("n_rare", F.lit(0)) + (1 if n_texts else 0)
    out = scored.join(rare, "row", "left")
    return out.select("doc_id", n_tokens.alias("n_tokens"), known.alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")

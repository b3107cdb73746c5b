r"""Language ID by interpolated Kneser-Ney character models, one for each language, in shared sorted hash arrays.

Text is lower-cased, everything but letters becomes one space, and the 4-grams of a bounded sample of labelled rows (about
`SAMPLE_DOCS` for each language, chosen by a hash of doc_id) are counted. Lower orders count continuations. For each order
the union of all languages' n-grams is one ascending array of 64-bit hashes with a row of log-probabilities beside it, one
column a language, already interpolated; a 4-gram that no language has falls back to shorter ones with their weights. The
language of the lowest cross-entropy per character wins. A fifth of the sample is kept from fitting, to calibrate: the
temperature of the score, and by length the highest excess of cross-entropy over the language's mean, times `SLACK`; a
document beyond that, or without a letter, is rejected. The sample's size bounds what reaches the driver and is broadcast.

Defined cases: text that is null or has no letter is ``und`` with score 0; ties go to the language that sorts first; with
nothing to learn from all rows are ``und``; a long text is scored `CHARS` characters at a time, each with the context
before it; a null doc_id is never held out; repeated rows are rows of their own; an empty table gives no rows;
lang, source and doc_id are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgate.llm.common import drawn, held_out, slices

ORDER, SAMPLE_DOCS, FOLDS = 4, 4000, 5
CHARS, MOST_LANGS = 1 << 20, 400
SLACK, FLOOR = 1.25, 0.5  # times the highest excess seen in calibration; nats a character that are never held against a text
UNKNOWN = "und"
_P, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PAD = "\0" * (ORDER - 1)


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after a pad of ORDER - 1 spaces, and where each text's pad begins."""
    c = np.frombuffer((_PAD + _PAD.join(t.replace("\0", " ").lower() for t in texts)).encode("utf-32-le", "surrogatepass"), "<u4")
    pad = c == 0
    c = np.where(_letters()[c], c, np.uint32(32))
    gap = c == 32
    drop = gap & ~pad
    drop[1:] &= gap[:-1]
    drop[0] = False
    c, pad = c[~drop], pad[~drop]
    return c, np.flatnonzero(pad)[:: ORDER - 1]


def coded(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points, the numbers of the texts they come from, and where each text's own begin after ORDER - 1 points of context: texts
    of about CHARS characters together, a longer one in pieces. A piece ends behind white space where it can, and its context is the
    end of the piece before."""
    for run in slices(texts, CHARS):
        if len(run) > 1 or len(texts[run[0]]) <= CHARS:
            c, begin = codes_of([texts[i] for i in run])
            yield c, np.array(run), begin
            continue
        text, a, tail = texts[run[0]], 0, None
        while a < len(text):
            z = min(a + CHARS, len(text))
            if z < len(text):
                z = max(text.rfind(" ", a, z), text.rfind("\n", a, z)) + 1 or z
            c, begin = codes_of([text[a:z]])
            if tail is not None:
                c[: ORDER - 1] = tail
            yield c, np.array(run), begin
            tail, a = c[1 - ORDER :], z


def raw_hashes(c: np.ndarray) -> list[np.ndarray]:
    """For each order k the hash of the k code points up to each position (0 where there are not so many)."""
    out = [c.astype(np.uint64) + np.uint64(1)]
    for _ in range(1, ORDER):
        h = np.zeros(len(c), np.uint64)
        h[1:] = out[-1][:-1] * _P + out[0][1:]
        out.append(h)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Sorted:
    """An ascending array of hashes with a row of values for each, and where each run of leading bits begins."""

    hashes: np.ndarray
    values: np.ndarray
    bits: int = 0
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    @classmethod
    def of(cls, raw: np.ndarray, values: np.ndarray) -> Sorted:
        h = _mixed(raw)
        order = np.argsort(h)
        h = np.append(h[order], np.uint64(2**64 - 1))
        bits = max(4, int(np.ceil(np.log2(len(h)))) + 2)
        first = np.searchsorted(h, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
        return cls(h, np.concatenate([values[order], np.zeros((1, values.shape[1]), values.dtype)]), bits, first)

    def find(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each hash, and whether it is there."""
        q = _mixed(raw)
        at = self.first[q >> np.uint64(64 - self.bits)]
        less = np.flatnonzero(self.hashes[at] < q)
        while len(less):
            at[less] += 1
            less = less[self.hashes[at[less]] < q[less]]
        return at, self.hashes[at] == q


@dataclass
class Model:
    langs: list[str]
    grams: list[Sorted]  # by order: interpolated log-probabilities
    weights: list[Sorted]  # by order from 2: log of the weight that a context gives to the shorter n-gram
    unseen: np.ndarray
    temperature: float = 1.0
    means: np.ndarray | None = None
    excess: np.ndarray | None = None  # by log2 of the length

    def log_p(self, hashes: list[np.ndarray], at: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log-probabilities of the characters at those positions, a column for each language."""
        if not order:
            return np.repeat(self.unseen[None, :], len(at), 0)
        row, there = self.grams[order - 1].find(hashes[order - 1][at])
        out = self.grams[order - 1].values[row]
        miss = np.flatnonzero(~there)
        if len(miss):
            short = self.log_p(hashes, at[miss], order - 1)
            if order > 1:
                ctx, known = self.weights[order - 2].find(hashes[order - 2][at[miss] - 1])
                short = short + np.where(known[:, None], self.weights[order - 2].values[ctx], 0)
            out[miss] = short
        return out

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability by language and number of characters of each text; texts without a letter have none."""
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        letters = np.zeros(len(texts), bool)
        for c, run, begin in coded(texts):
            size = np.diff(np.append(begin, len(c))) - (ORDER - 1)
            own = np.ones(len(c), bool)
            own[(begin[:, None] + np.arange(ORDER - 1)).ravel()] = False
            p = self.log_p(raw_hashes(c), np.flatnonzero(own))
            some = size > 0
            if some.any():
                starts = (np.cumsum(size) - size)[some]
                total[run[some]] += np.add.reduceat(p, starts, axis=0, dtype=np.float64)
                letters[run[some]] |= np.add.reduceat((c != 32)[own].astype(np.int64), starts) > 0
            n[run] += size
        return total * letters[:, None], n * letters

    def judge(self, texts: list[str]) -> pd.DataFrame:
        """lang_pred, score, cross_entropy, rejected."""
        k = len(self.langs)
        if not k:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "cross_entropy": np.nan, "rejected": True}, index=range(len(texts)))
        total, n = self.sums(texts)
        ce = -total / np.maximum(n, 1)[:, None]
        best = ce.argmin(1)
        least = ce[np.arange(len(texts)), best]
        e = np.exp((total - total.max(1, keepdims=True)) / self.temperature)
        score = e.max(1) / e.sum(1)
        none = n == 0
        rejected = none.copy()
        if self.excess is not None:
            bins = np.minimum(np.log2(np.maximum(n, 1)).astype(int), len(self.excess) - 1)
            rejected |= least - self.means[best] > self.excess[bins]
        return pd.DataFrame({"lang_pred": np.where(none, UNKNOWN, np.array(self.langs, object)[best]), "score": np.where(none, 0.0, score), "cross_entropy": np.where(none, np.nan, least), "rejected": rejected})


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """counts: by language the distinct 4-grams (rows of code points) and how often each stands in the sample."""
    langs = sorted(counts)
    n_lang = len(langs)
    size = len(np.unique(np.concatenate([g.ravel() for g, _ in counts.values()]))) + 1 if langs else 1
    model = Model(langs, [], [], np.full(n_lang, -np.log(size), np.float32))
    levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[counts[x] for x in langs]]
    for _ in range(ORDER - 1):  # continuation counts
        levels.insert(0, [np.unique(g[:, 1:], axis=0, return_counts=True) for g, _ in levels[0]])
    hashed = lambda g: _row_hash(g) if len(g) else np.zeros(0, np.uint64)
    lower = None
    for k, level in enumerate(levels, 1):
        union = np.unique(np.concatenate([g for g, _ in level]), axis=0) if langs else np.zeros((0, k), np.uint32)
        raw = hashed(union)
        by_raw = np.argsort(raw)
        add, weight_rows = np.zeros((len(union), n_lang)), []
        ctx_raw = hashed(union[:, :-1]) if k > 1 else np.zeros(len(union), np.uint64)
        ctx_all, ctx_of = np.unique(ctx_raw, return_inverse=True)
        weights = np.ones((len(ctx_all), n_lang))
        for j, (g, n) in enumerate(level):
            n1, n2 = int((n == 1).sum()), int((n == 2).sum())
            d = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
            rows = by_raw[np.searchsorted(raw[by_raw], hashed(g))]
            ctx = ctx_of[rows]
            total = np.bincount(ctx, n, len(ctx_all))
            types = np.bincount(ctx, minlength=len(ctx_all))
            add[rows, j] = np.maximum(n - d, 0) / total[ctx]
            weights[:, j] = np.where(total > 0, d * types / np.maximum(total, 1), 1)
        if k == 1:
            below = np.full((len(union), n_lang), 1 / size)
        else:
            at, _ = lower.find(hashed(union[:, 1:]))
            below = np.exp(lower.values[at].astype(float))
            model.weights.append(Sorted.of(ctx_all, np.log(weights).astype(np.float32)))
        p = add + weights[ctx_of] * below
        lower = Sorted.of(raw, np.log(p).astype(np.float32))
        model.grams.append(lower)
        if k == 1:
            model.unseen = (np.log(weights[0]) - np.log(size)).astype(np.float32) if len(weights) else model.unseen
    return model


def _row_hash(g: np.ndarray) -> np.ndarray:
    h = g[:, 0].astype(np.uint64) + np.uint64(1)
    for j in range(1, g.shape[1]):
        h = h * _P + (g[:, j].astype(np.uint64) + np.uint64(1))
    return h


def calibrate(model: Model, langs: list[str], totals: np.ndarray, n: np.ndarray) -> None:
    """Sets temperature, means and excess from labelled texts that were not fitted on."""
    own = (n > 0) & np.isin(langs, model.langs)
    if not own.any():
        return
    y = np.searchsorted(model.langs, np.array(langs, object)[own].astype(str))
    totals, n = totals[own], n[own]
    ce = (-totals / n[:, None])[np.arange(len(n)), y]

    def loss(t: float) -> float:
        z = (totals - totals.max(1, keepdims=True)) / t
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), y]).mean())

    model.temperature = min((2.0 ** (x / 2) for x in range(21)), key=loss)
    model.means = np.array([np.average(ce[y == j], weights=n[y == j]) if (y == j).any() else ce.mean() for j in range(len(model.langs))])
    over, bins = ce - model.means[y], np.log2(n).astype(int)
    top = np.full(32, FLOOR)
    np.maximum.at(top, bins, over)
    model.excess = SLACK * np.maximum.accumulate(top[::-1])[::-1]  # a shorter text may vary as much as a longer one
    model.excess[: bins.min() + 1] += 2.0  # shorter than any that was seen: nearly anything goes


def fit(docs: DataFrame, mod: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from rows with text and lang that are not held out."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null").where(~held_out("doc_id", mod))
    sizes = {x["lang"]: x["n"] for x in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()}
    if not sizes:
        return kneser_ney({})
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"{len(sizes)} values of lang; a model of each is broadcast, so {MOST_LANGS} at most")
    share = spark.createDataFrame([(k, min(1.0, SAMPLE_DOCS / n)) for k, n in sizes.items()], "lang string, share double")
    sample = rows.join(F.broadcast(share), "lang").where(drawn(F.col("share"), "doc_id", "text", F.lit(1)))
    sample = sample.select("lang", "text", F.pmod(F.xxhash64("doc_id", "text", F.lit(2)), F.lit(FOLDS)).alias("fold"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang").text:
                for c, _, begin in coded(texts.tolist()):
                    own = np.ones(len(c), bool)
                    own[(begin[:, None] + np.arange(ORDER - 1)).ravel()] = False
                    at = np.flatnonzero(own)
                    _, first, n = np.unique(raw_hashes(c)[-1][at], return_index=True, return_counts=True)
                    g = c[at[first][:, None] + np.arange(1 - ORDER, 1)].astype("<u4")
                    yield pd.DataFrame({"lang": lang, "gram": [x.tobytes() for x in g], "n": n})

    counted = sample.where("fold > 0").mapInPandas(count, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    by_lang = {k: (np.frombuffer(b"".join(x.gram), "<u4").reshape(-1, ORDER), x.n.to_numpy()) for k, x in counted.groupby("lang")}
    model = kneser_ney(by_lang)
    held = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total, n = held.value.sums(b.text.tolist())
            yield pd.DataFrame({"lang": b.lang, "total": list(total), "n": n})

    tried = sample.where("fold = 0").mapInPandas(score, "lang string, total array<double>, n long").toPandas()
    if len(tried):
        calibrate(model, tried.lang.tolist(), np.stack(tried.total), tried.n.to_numpy())
    return model


JUDGED = {"lang_pred": pa.string(), "score": pa.float64(), "cross_entropy": pa.float64(), "rejected": pa.bool_()}


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = held.value.judge([t or "" for t in b.column("text").to_pylist()])
            yield pa.record_batch({"doc_id": b.column("doc_id"), **{c: pa.array(out[c], t) for c, t in JUDGED.items()}})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def kept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, all columns as they are; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            yield b.filter(pa.array(~held.value.judge(texts).rejected.to_numpy().astype(bool)))

    return docs.mapInArrow(work, docs.schema)

r"""Secret scans: fixed patterns, and a battery of randomness tests over long tokens.

A token is a maximal run of at least `MIN_LEN` characters of the base64 and URL alphabets. Its encoding is the smallest alphabet that
holds it, separators apart (digits, hex, one case of letters, base32, base62, base64). Three tests ask whether it looks drawn at random from
that alphabet: chi-squared uniformity of the alphabet's bins, Wald-Wolfowitz runs above and below the middle of the alphabet, and
the lag-one serial correlation; Fisher's method joins their p-values. A token that they reject at `ALPHA` is no secret.

For the others, what matters is how likely ordinary text is to look as random. The null is fitted to the corpus: from each text, at a
place that its own hash sets, a run of its words shorter than a token is joined to a window of each of `LENGTHS`, and the
battery judges these like tokens. A token's p-value is the share of windows of its stratum of length that have its encoding and do
no worse in the battery, one more counted on both sides. The Benjamini-Hochberg threshold at rate `Q` is set in each stratum of length over
all its tokens. So a short token of letters, which text resembles, can't be a discovery, while a long one can. All of this
needs two tables of counts whose size is fixed (strata x encodings x bins).

The patterns' spans are kept as they are; the battery adds spans of kind ``random`` that don't overlap those.

Defined cases: a null text is empty; offsets are code points, end exclusive; whole texts are searched; repeated rows are rows
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgate.llm.common import stored

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as shorter ones dropped
KINDS = ("assign", "access", "hex", "random")
MIN_LEN, Q, ALPHA = 20, 0.01, 0.001
#: Bins of a battery's p-value, two for each power of ten; strata of lengths, by powers of 2; lengths of the null's windows.
P_BINS, FIRST_STRATUM, STRATA = 24, 5, 4
LENGTHS = (26, 45, 90, 180)
TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_LEN},}}")
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: By size; hex is judged in lower case.
ALPHABETS = {"digits": _DIGITS, "hex": _DIGITS + "abcdef", "lower": _LOWER, "upper": _UPPER, "base32": _UPPER + "234567", "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/"}
ENCODINGS = list(ALPHABETS)
_SETS = [(k, set(v)) for k, v in ALPHABETS.items()] + [("hex", set(_DIGITS + "ABCDEF"))]
_SETS.sort(key=lambda x: len(x[1]))


def _places(alphabet: str) -> np.ndarray:
    out = np.zeros(128, np.int64)
    out[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return out


PLACES = {k: _places(v) for k, v in ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start, then kind as listed."""
    out = [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


def core_of(token: str) -> tuple[str, str]:
    """The characters that the battery judges, and their encoding. Padding is none of them; - and _ separate groups, unless + or /
    show that they stand for these."""
    t = token.rstrip("=")
    t = t.replace("-", "+").replace("_", "/") if "+" in t or "/" in t else t.replace("-", "").replace("_", "")
    own = set(t)
    encoding = next((k for k, letters in _SETS if own <= letters), "base64")
    return t.replace("=", "").lower() if encoding == "hex" else t.replace("=", ""), encoding


def _chi2_tail(x: float, k: int) -> float:
    """P(chi-squared of k degrees > x), by Wilson and Hilferty's cube root."""
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniform_p(core: str, encoding: str) -> float:
    """p-value of "drawn at random from the alphabet": chi-squared, runs and serial correlation by Fisher's method."""
    size = len(ALPHABETS[encoding])
    v = PLACES[encoding][np.frombuffer(core.encode(), np.uint8)]
    n = len(v)
    bins = max(2, min(16, size, n // 5))
    seen = np.bincount(v * bins // size, minlength=bins)
    want = np.bincount(np.arange(size) * bins // size, minlength=bins) * n / size
    p_chi = _chi2_tail(float(((seen - want) ** 2 / want).sum()), bins - 1)
    up = v >= size / 2
    n1 = int(up.sum())
    n2 = n - n1
    if n1 and n2 and n > 2:
        runs, mean = 1 + int((up[1:] != up[:-1]).sum()), 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    c = v - v.mean()
    r = float((c[1:] * c[:-1]).sum() / (c * c).sum()) if (c * c).sum() else 1.0
    p_serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))  # Fisher's statistic, halved
    return math.exp(-half) * (1 + half + half * half / 2)


def cell_of(token: str) -> tuple[int, int, int]:
    """Stratum of length, encoding and bin of the battery's p-value, small where the token looks random."""
    core, encoding = core_of(token)
    p = uniform_p(core, encoding) if len(core) > 2 else 0.0
    return stratum_of(len(core)), ENCODINGS.index(encoding), P_BINS - 1 if p < ALPHA else int(-2 * math.log10(p))


def stratum_of(length: int) -> int:
    return min(max(length.bit_length() - FIRST_STRATUM, 0), STRATA - 1)


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, stratum, encoding, bin) of the tokens apart from the base spans."""
    out, at, reach = [], 0, 0  # reach: the end of the base spans that began before here
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while at < len(base) and base[at][0] < b:
            reach, at = max(reach, base[at][1]), at + 1
        if reach <= a:
            out.append((a, b, *cell_of(m[0])))
    return out


def null_cells(text: str) -> list[tuple[int, int, int]]:
    """Cells of windows of ordinary text: words that are no tokens, joined; none where the text is too short."""
    out = []
    if text:
        seed = zlib.crc32(text.encode("utf-8", "replace"))
        for i, n in enumerate(LENGTHS):
            at = (seed * (2 * i + 1)) % len(text)
            words = text[at : at + 6 * n + 40].split()[1:-1]
            joined = "".join(re.sub(r"[^A-Za-z0-9]", "", w) for w in words if not TOKEN.search(w))[:n]
            if len(joined) == n:
                out.append(cell_of(joined))
    return out


def discoveries(tokens: dict[tuple[int, int, int], int], null: dict[tuple[int, int, int], int]) -> list[tuple[int, int, int]]:
    """Cells (stratum, encoding, bin) whose tokens are discoveries: Benjamini-Hochberg in each stratum. Tokens that the battery
    rejects have the p-value 1."""
    found = []
    for s in range(STRATA):
        n_null, m = (sum(n for c, n in table.items() if c[0] == s) for table in (null, tokens))
        p = {c: (1 + sum(null.get((s, c[1], b), 0) for b in range(c[2] + 1))) / (1 + n_null) for c in tokens if c[0] == s and c[2] < P_BINS - 1}
        k, best = 0, 0.0
        for c in sorted(p, key=lambda c: p[c]):  # of cells of one p-value the last has the k of all
            k += tokens[c]
            best = p[c] if p[c] <= Q * k / m else best
        found += [c for c in p if p[c] <= best]
    return found


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
TOKENS = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.int32()), ("encoding", pa.int32()), ("bin", pa.int32())])
CELL = pa.struct([("stratum", pa.int32()), ("encoding", pa.int32()), ("bin", pa.int32())])
_CELL = "stratum:int,encoding:int,bin:int"
SCANNED = f"doc_id long, base array<struct<start:int,end:int,kind:string>>, tokens array<struct<start:int,end:int,{_CELL}>>, null_cells array<struct<{_CELL}>>"


def _structs(rows: list[list[tuple]], kind: pa.StructType) -> pa.Array:
    names = [kind.field(i).name for i in range(kind.num_fields)]
    return pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], pa.list_(kind))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, tokens, null_cells: all spans of the patterns, all long tokens with their test results, the null's windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            tokens = [candidates(t, x) for t, x in zip(texts, base, strict=True)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "base": _structs(base, SPAN), "tokens": _structs(tokens, TOKENS), "null_cells": _structs([null_cells(t) for t in texts], CELL)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, SCANNED)


def _counts(found: DataFrame, column: str) -> dict[tuple[int, int, int], int]:
    """Rows by cell: a row for each of strata x encodings x bins at most."""
    cells = found.select(F.explode(column).alias("t")).groupBy("t.stratum", "t.encoding", "t.bin").count().collect()
    return {(x["stratum"], x["encoding"], x["bin"]): x["count"] for x in cells}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, spans (array of start, end, kind; the base ones and those of the battery)."""
    found = stored(scan(docs, id_col, text_col), "tokens")
    cells = discoveries(_counts(found, "tokens"), _counts(found, "null_cells"))
    code = lambda s, e, b: (s * len(ENCODINGS) + e) * P_BINS + b
    wanted = F.array(*[F.lit(code(*c)) for c in cells]).cast("array<int>")
    new = F.transform(F.filter("tokens", lambda t: F.array_contains(wanted, code(t["stratum"], t["encoding"], t["bin"]))), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(KINDS[3]).alias("kind")))
    rank = lambda x: F.struct(x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))
    spans = F.array_sort(F.transform(F.concat("base", new), rank))
    return found.select("doc_id", "base", F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("spans"))

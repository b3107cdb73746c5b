r"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; two fingerprints within the radius share one.
Variants are dealt by their leading bits: a fingerprint goes once to every prefix that one of its variants has, and the
rest of the variants (those bits flipped that the prefix left over) are spelled out where they are compared. So 2,081
variants of radius 2 cost some 60 shuffled values, not 2,081. A prefix whose load is high is split by further bits, by a
histogram of at most 4,096 counts. Fingerprints that share a variant are within the radius of one another; each prefix
returns a spanning forest of what it found (fewer links than fingerprints), never all pairs of a group.

Defined cases: text that is null, empty or only white space has fingerprint zero, linked like any other; fewer than k
words are one shingle; rows with one doc_id are rows of their own; a null doc_id never names a component unless all its
rows are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgate.llm.common import arrow_runs, fresh, scratch, slices, stored
from quillgate.llm.components import roots

BITS, SEED = 64, 42
#: Characters worked on at once; variants sorted at once; variants that a prefix should have.
CHARS, SORTED, LOAD = 1 << 20, 1 << 20, 1 << 20
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, k: int) -> list[bytes]:
    """XXH64 of the k-word shingles, 8 big-endian bytes each."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    joined, h = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= k:
        return [h(joined, SEED)] if words else []
    ends = list(accumulate(len(w) + 1 for w in words))
    return [h(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[k - 1 :], strict=False)]


def word_set_hashes(text: str, seed: int) -> list[bytes]:
    h = xxhash.xxh64_digest
    return [h(w, seed) for w in set(text.encode("utf-8", "surrogatepass").lower().split())]


def fingerprints_of(texts: list[str], hashes: Callable[[str], list[bytes]]) -> np.ndarray:
    """uint64 fingerprints of what hashes() makes of each text. Bits are counted in byte lanes, at most 255 hashes at a time."""
    out = np.zeros(len(texts), np.uint64)
    for run in slices(texts, CHARS):
        each = [hashes(texts[i]) for i in run]
        n = np.array([len(x) for x in each])
        h = np.frombuffer(b"".join(b"".join(x) for x in each), ">u8").astype(np.uint64)
        rows, n = np.array(run)[n > 0], n[n > 0]
        if not len(rows):
            continue
        segs = -(-n // 255)
        first = np.concatenate(([0], np.cumsum(segs)[:-1]))
        base = np.concatenate(([0], np.cumsum(n)[:-1]))
        starts = np.repeat(base, segs) + 255 * (np.arange(segs.sum()) - np.repeat(first, segs))
        counts = np.empty((len(rows), BITS), np.int64)
        for b in range(8):
            lanes = np.add.reduceat((h >> np.uint64(b)) & _LANES, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
            counts[:, b::8] = np.add.reduceat(lanes, first, axis=0, dtype=np.int64)
        bits = (2 * counts > n[:, None]).astype(np.uint8)
        out[rows] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, k: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "fp": fingerprints_of(texts, lambda t: shingle_hashes(t, k)).view(np.int64)})

    ids = F.col(id_col).cast("long").alias("doc_id")
    return docs.select(ids, F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, fp long")


def _masks(bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All masks of so many low bits with at most `most` ones, and their ones."""
    m = [(sum(1 << x for x in c), k) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array([x for x, _ in m], np.uint64), np.array([k for _, k in m], np.int64)


def _dealt(fps: np.ndarray, width: int, extra: np.ndarray, half: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(prefix, part of the prefix, fingerprint) for every prefix of a variant. extra[prefix]: bits that split it."""
    masks, ones = _masks(width, half)
    for m, k in zip(masks, ones, strict=True):
        prefix = (fps >> np.uint64(BITS - width)) ^ m
        e = extra[prefix]
        for bits in np.unique(e):
            own, at = fps[e == bits], prefix[e == bits]
            if not bits:
                yield at, np.zeros(len(at), np.uint64), own
                continue
            low = (own >> np.uint64(BITS - width - bits)) & np.uint64((1 << int(bits)) - 1)
            for m2 in _masks(int(bits), half - k)[0]:
                yield at, low ^ m2, own


def _meet(fps: np.ndarray, left: np.ndarray, bits: int, linked: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Links among sorted fingerprints that share a variant, as linked() makes them. left: flips that each has left for its
    low bits. Too many variants are compared half by half, by the next bit."""
    n_variants = sum(int((left == k).sum()) * sum(math.comb(bits, j) for j in range(k + 1)) for k in range(left.max(initial=0) + 1))
    if n_variants > SORTED and bits > 0:
        found = []
        top = (fps >> np.uint64(bits - 1)) & np.uint64(1)
        for v in (0, 1):
            rest = left - (top != v)
            found.append(_meet(fps[rest >= 0], rest[rest >= 0], bits - 1, linked))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
    low = fps & np.uint64((1 << bits) - 1)
    variants, source = [], []
    for k in range(left.max(initial=0) + 1):
        rows = np.flatnonzero(left == k)
        masks = _masks(bits, k)[0]
        variants.append((low[rows, None] ^ masks[None, :]).ravel())
        source.append((rows, len(masks)))
    v = np.concatenate(variants)
    s = np.sort(v)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return fps[:0], fps[:0]
    mix = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    seen = np.zeros(1 << 20, bool)
    seen[mix(twice)] = True
    at = np.flatnonzero(seen[mix(v)])
    at = at[twice[np.minimum(np.searchsorted(twice, v[at]), len(twice) - 1)] == v[at]]
    src = np.concatenate([np.repeat(rows, n) for rows, n in source])[at]
    order = np.lexsort((src, v[at]))
    src, val = src[order], v[at][order]
    starts = np.flatnonzero(np.concatenate(([True], val[1:] != val[:-1])))
    group = np.cumsum(np.concatenate(([0], val[1:] != val[:-1])))
    a, b = linked(src, group, starts, len(fps))
    return fps[a], fps[b]


def _forest(src: np.ndarray, group: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A link from each of n fingerprints to the smallest that variants connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum.reduceat(label[src], starts)
        new = label.copy()
        np.minimum.at(new, src, least[group])
        new = new[new]
        if (new == label).all():
            own = np.flatnonzero(label != np.arange(n))
            return own, label[own]
        label = new


def _pairs(src: np.ndarray, group: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each variant's fingerprints, each with the smallest and with the one before it: all within the radius."""
    first, before = src[starts][group], np.concatenate((src[:1], src[:-1]))
    inner = np.setdiff1d(np.arange(len(src)), starts)
    code = np.unique(np.concatenate([src[inner] * n + first[inner], src[inner] * n + before[inner]]))
    return code // n, code % n


def links(fps: DataFrame, radius: int = 4, direct: bool = False) -> DataFrame:
    """a, b: links that connect all fp (distinct longs) at up to `radius` differing bits, radius even. With direct, each
    link itself is within the radius: for every shared variant those to its smallest fingerprint and to the next."""
    if radius % 2:
        raise ValueError("the ball around the middle needs an even radius")
    half = radius // 2
    ball = sum(math.comb(BITS, k) for k in range(half + 1))
    n = fps.count()
    width = min(12, max(6, math.ceil(math.log2(max(n * ball / (LOAD >> 2), 1)))))
    own = np.zeros(1 << width)
    for x in fps.groupBy(F.shiftrightunsigned("fp", BITS - width).alias("p")).count().collect():  # 4,096 rows at most
        own[x["p"]] = x["count"]
    load, rest = np.zeros(1 << width), BITS - width
    for m, k in zip(*_masks(width, half), strict=True):
        load += own[np.arange(1 << width) ^ int(m)] * sum(math.comb(rest, j) for j in range(half - k + 1))
    extra = np.minimum(24, np.ceil(np.log2(np.maximum(load / (2 * LOAD), 1)))).astype(np.int64)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = list(_dealt(b.fp.to_numpy().view(np.uint64), width, extra, half))
            key = np.concatenate([(p << np.uint64(24)) | q for p, q, _ in got])
            fp = np.concatenate([f for _, _, f in got])
            order = np.argsort(key, kind="stable")
            key, fp = key[order], fp[order]
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else []
            ends = [*cut[1:], len(key)]
            yield pd.DataFrame({"k": key[cut].view(np.int64) if len(key) else [], "fps": [fp[a:z].astype("<u8").tobytes() for a, z in zip(cut, ends, strict=len(key) > 0)]})

    def meet(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(np.frombuffer(b"".join(b.fps), "<u8"))
        prefix, part = int(key[0]) >> 24, int(key[0]) & 0xFFFFFF
        bits = int(extra[prefix])
        whole = np.uint64(prefix << bits | part)
        left = half - np.bitwise_count((fp >> np.uint64(BITS - width - bits)) ^ whole).astype(np.int64)
        x, y = _meet(fp, left, BITS - width - bits, _pairs if direct else _forest)
        return pd.DataFrame({"a": x.astype(np.uint64).view(np.int64), "b": y.astype(np.uint64).view(np.int64)})

    return fps.mapInPandas(emit, "k long, fps binary").groupBy("k").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) of every row."""
    rows = stored(fingerprints(docs, k, id_col, text_col), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    tree = roots(links(nodes.select("fp"), radius))
    named = nodes.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


#: Word-set fingerprints of the stage that checks its links, and ids that may be broadcast.
STAGE_SEEDS, BROADCAST_IDS = (42,), 1 << 20
#: Pairs of one text that are tested at once.
PAIRED = 64
#: Leading bits of a shingle's hash by which shingles are counted.
LEVEL_BITS = 18
#: Longs of a text's sketch.
SKETCH = 16


def _candidates(texts: DataFrame, fp: str, radius: int) -> DataFrame:
    """x, y: texts' documents whose fingerprints link. Of equal fingerprints, each with the first. These are a cheap start; what
    they miss is found from common shingles."""
    nodes = texts.groupBy(fp).agg(F.min("doc").alias("doc"))
    same = texts.select(fp, F.col("doc").alias("y")).join(nodes.select(fp, F.col("doc").alias("x")), fp).where("x < y").select("x", "y")
    near = links(nodes.select(F.col(fp).alias("fp")), radius, direct=True).distinct()
    name = lambda c, out: nodes.select(F.col(fp).alias(c), F.col("doc").alias(out))
    near = near.join(name("a", "x"), "a").join(name("b", "y"), "b").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return same.unionByName(near)


def _texts_of(docs: DataFrame, ids: DataFrame, few: bool, repeated: bool) -> DataFrame:
    """doc, text of ids (doc, distinct), with the other columns of ids; of rows with one doc_id the least text."""
    own, ids = docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), F.broadcast(ids) if few else ids
    if repeated:
        own = own.join(ids.select("doc"), "doc", "left_semi").groupBy("doc").agg(F.min("text").alias("text"))
    return own.join(ids, "doc")


def _hashed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Documents and the sorted distinct XXH64 of their k-word shingles, of a few texts at a time."""
    for batch in batches:
        for b in arrow_runs(batch, "text", CHARS):
            yield b.column("doc").to_numpy(), [np.unique(np.frombuffer(b"".join(shingle_hashes(t or "", k)), ">u8").astype("<u8")) for t in b.column("text").to_pylist()]


def _levels(texts: DataFrame, k: int) -> np.ndarray:
    """By the leading bits of a shingle's hash, how many there are: eight steps for each doubling."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << LEVEL_BITS, np.int64)
        for _, each in _hashed(batches, k):
            total += np.bincount((np.concatenate(each) >> np.uint64(BITS - LEVEL_BITS)).astype(np.int64), minlength=1 << LEVEL_BITS)
        yield pa.record_batch({"part": pa.array(range(64), pa.int32()), "n": pa.array([x.tobytes() for x in total.reshape(64, -1)], pa.binary())})

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in b.n)
        return pd.DataFrame({"part": [key[0]], "n": [np.minimum(8 * np.log2(total + 1), 255).astype(np.uint8).tobytes()]})

    got = texts.mapInArrow(count, "part int, n binary").groupBy("part").applyInPandas(add, "part int, n binary").orderBy("part").collect()
    return np.frombuffer(b"".join(x["n"] for x in got), np.uint8) if got else np.zeros(1 << LEVEL_BITS, np.uint8)


def _postings(texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """s, doc, n, at: the shingles that two similar sets cannot all miss, where another document has the same. Shingles
    are ordered by level, then hash; of sets with at least that similarity one of the first n - ceil(similarity x n) + 1 is common."""
    level = _levels(texts, k)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, each in _hashed(batches, k):
            s = []
            for h in each:
                most = len(h) - math.ceil(similarity * len(h) - 1e-9) + 1 if len(h) else 0
                s.append(h[np.lexsort((h, level[(h >> np.uint64(BITS - LEVEL_BITS)).astype(np.int64)]))[:most]])
            n = [len(x) for x in s]
            at = np.concatenate([np.arange(m, dtype=np.int32) for m in n])
            yield pa.record_batch({"s": np.concatenate(s).view(np.int64), "doc": np.repeat(doc, n), "n": np.repeat(np.array([len(h) for h in each], np.int32), n), "at": at})

    rows = texts.mapInArrow(first, "s long, doc long, n int, at int")
    # one shuffle of these rows is what the stage costs most; a crowd's copies have a row each for a shingle, never pairs
    return stored(rows.withColumn("c", F.count("*").over(W.partitionBy("s"))).where("c > 1").drop("c"), "postings")


def _named(posts: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """posts with label, the component by the links found; only of shingles that several components have, as texts of different components
    share no others."""
    label = posts.join(roots(found).withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("root", "doc")).drop("root")
    label = stored(label, f"{name}-all")
    mixed = label.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("s")
    return label.join(mixed, "s", "left_semi")


def _sketches(texts: DataFrame, k: int) -> DataFrame:
    """doc, b0, b1 and so on: for each of 64 x SKETCH classes of hashes, whether the text has an odd number of shingles in it. The classes in
    which two texts differ are no more than the shingles that only one of them has."""
    names = [f"b{i}" for i in range(SKETCH)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, each in _hashed(batches, k):
            odd = np.array([np.bincount((h % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1 for h in each], np.uint8)
            bits = np.packbits(odd, axis=1).view(np.int64)
            yield pa.record_batch({"doc": doc} | {x: np.ascontiguousarray(bits[:, i]) for i, x in enumerate(names)})

    return texts.mapInArrow(work, ", ".join(f"{x} long" for x in ["doc", *names]))


def _met(apart: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different components at the shingles they share, but for pairs that cannot be similar by their sketches. A
    pair's first common shingle, and those that follow while there is room for enough of them, are there."""
    apart = apart.join(sketches, "doc")
    side = lambda c: apart.select(*[F.col(x).alias(x if x == "s" else f"{c}_{x}") for x in apart.columns])
    both = side("x").where("x_minor").join(side("y"), "s").where("x_label <> y_label and (not y_minor or x_doc < y_doc)")
    room = f"least(x_n - x_at, y_n - y_at) + 1e-6 >= (x_n + y_n) * {similarity / (1 + similarity)!r}"
    differ = " + ".join(f"bit_count(x_b{i} ^ y_b{i})" for i in range(SKETCH))
    return both.where(f"{room} and {differ} <= (x_n + y_n) * {(1 - similarity) / (1 + similarity)!r} + 1e-6")


def _linked(docs: DataFrame, posts: DataFrame, found: DataFrame, k: int, similarity: float, repeated: bool) -> DataFrame:
    """The links found by pairs, and those that are needed to connect all similar texts.

    Each text meets the one of its shingle that shares most with others. What is still apart after that meets everything of
    another component with which it has a shingle in common, so nothing that is left untested could join two components. As all
    order shingles alike, two texts have no more in common than what is before a common one in both, and from it on in both."""
    # before: the text's shingles that several components have and that come earlier
    apart = stored(_named(posts, found, "apart").withColumn("before", F.row_number().over(W.partitionBy("doc").orderBy("at")) - 1), "apart")
    shared = posts.groupBy("doc").agg((F.count("*") / F.max("n")).alias("part"))
    hub = apart.join(shared, "doc").groupBy("s").agg(F.max_by(F.struct("doc", "label", "n", "at", "before"), F.struct("part", -F.col("doc"))).alias("hub"))
    star = apart.join(hub, "s").where("label <> hub.label").where(f"least(before, hub.before) + least(n - at, hub.n - hub.at) + 1e-6 >= (n + hub.n) * {similarity / (1 + similarity)!r}")
    tested = stored(star.select(F.least("doc", "hub.doc").alias("x"), F.greatest("doc", "hub.doc").alias("y")).distinct(), "stars")
    found = stored(found.unionByName(_similar(docs, tested, k, similarity, repeated)), "links-stars")
    apart = stored(_named(apart.drop("label", "before"), found, "still-apart"), "still-apart")
    most = apart.groupBy("s", "label").count().groupBy("s").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
    apart = stored(apart.join(most, "s").withColumn("minor", F.col("label") != F.col("most")).drop("most"), "minor")
    ids = stored(apart.select("doc").distinct(), "minor-ids")
    both = _met(apart, stored(_sketches(_texts_of(docs, ids, ids.count() <= BROADCAST_IDS, repeated), k), "sketches"), similarity)
    swap = F.col("x_doc") > F.col("y_doc")
    both = both.select(*[F.when(swap, F.col(f"{b}_{c}")).otherwise(F.col(f"{a}_{c}")).alias(f"{a}_{c}") for a, b in ("xy", "yx") for c in ("doc", "n", "at")])
    both = both.groupBy("x_doc", "y_doc", "x_n", "y_n").agg(F.count("*").alias("c"), F.max("x_at").alias("x_at"), F.max("y_at").alias("y_at"))
    most = F.col("c") + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")) - 1  # common shingles at most
    both = both.where(most + 1e-6 >= (F.col("x_n") + F.col("y_n")) * (similarity / (1 + similarity))).select(F.col("x_doc").alias("x"), F.col("y_doc").alias("y"))
    rest = stored(both.join(tested, ["x", "y"], "left_anti"), "rest")
    return found.unionByName(_similar(docs, rest, k, similarity, repeated))


def _similar(docs: DataFrame, pairs: DataFrame, k: int, similarity: float, repeated: bool) -> DataFrame:
    """The pairs (x, y, distinct, stored) whose texts' sets of shingles have at least that Jaccard similarity.

    Each pair is tested at the one of its texts that has more pairs, PAIRED of them at a time. So a set is sent once for each pair of
    its text with a busier one, and once for each PAIRED of its own: what is shuffled is about a set for each pair."""
    ends = pairs.select(F.col("x").alias("doc")).unionByName(pairs.select(F.col("y").alias("doc"))).groupBy("doc").count()
    if ends.isEmpty():
        return pairs.select(F.col("x").alias("a"), F.col("y").alias("b"))
    n = lambda c: ends.select(F.col("doc").alias(c), F.col("count").alias(f"n_{c}"))
    more = F.struct("n_y", "y") > F.struct("n_x", "x")
    sided = pairs.join(n("x"), "x").join(n("y"), "y").select(F.when(more, F.col("y")).otherwise(F.col("x")).alias("at"), F.when(more, F.col("x")).otherwise(F.col("y")).alias("doc"), F.greatest("n_x", "n_y").alias("n"))
    sided = sided.select("at", "doc", F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / PAIRED)).cast("int").alias("part"))
    sent = sided.unionByName(sided.select("at", F.col("at").alias("doc"), "part").distinct())
    sent = stored(sent.groupBy("doc").agg(F.collect_list(F.struct("at", "part")).alias("to")), "sent")
    texts = _texts_of(docs, sent, pairs.count() <= BROADCAST_IDS, repeated)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in arrow_runs(batch, "text", CHARS):
                for doc, text, to in zip(b.column("doc").to_pylist(), b.column("text").to_pylist(), b.column("to").to_pylist(), strict=True):
                    s = np.unique(np.frombuffer(b"".join(shingle_hashes(text or "", k)), ">u8").astype("<u8")).tobytes()
                    run = max(1, CHARS // max(1, len(s)))
                    for i in range(0, len(to), run):
                        own = to[i : i + run]
                        yield pa.record_batch({"at": pa.array([x["at"] for x in own], pa.int64()), "part": pa.array([x["part"] for x in own], pa.int32()), "doc": pa.array([doc] * len(own), pa.int64()), "s": pa.array([s] * len(own), pa.binary())})

    def check(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        at, fits = int(key[0]), []
        own, rest = np.frombuffer(b.s[b.doc == at].iloc[0], "<u8"), b[b.doc != at]
        for doc, s in zip(rest.doc.tolist(), rest.s, strict=True):
            x = np.frombuffer(s, "<u8")
            both = len(np.intersect1d(own, x, assume_unique=True))
            if both + 1e-9 >= similarity * (len(own) + len(x) - both):
                fits.append((min(at, doc), max(at, doc)))
        return pd.DataFrame(fits, columns=["a", "b"], dtype="int64")

    return texts.mapInArrow(sets, "at long, part int, doc long, s binary").groupBy("at", "part").applyInPandas(check, "a long, b long")


def deduplicated(docs: DataFrame, k: int = 5, radius: int = 4, similarity: float = 0.8, seeds: tuple[int, ...] = STAGE_SEEDS) -> DataFrame:
    """docs less all but one of each group, the one of the smallest doc_id, with all columns.

    Five-word fingerprints of near copies at similarity 0.8 differ in some nine bits, which no small ball covers; those of word
    sets of lightly edited copies differ in about four. So word-set fingerprints of several seeds give cheap links first, the rest
    comes from rare common shingles, which no similar pair is without. A link counts if the k-word shingle sets are similar
    enough. Equal texts are one text. Rows without an id stay."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b.text.fillna("").tolist()
            yield b.drop(columns="text").assign(void=[not t.encode("utf-8", "surrogatepass").split() for t in texts], **{f"fp{i}": fingerprints_of(texts, lambda t, s=s: word_set_hashes(t, s)).view(np.int64) for i, s in enumerate(seeds)})

    with scratch(docs.sparkSession):
        fp = [f"fp{i}" for i in range(len(seeds))]
        own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), "text")
        rows = stored(own.mapInPandas(work, "doc_id long, h long, key string, void boolean, " + ", ".join(f"{x} long" for x in fp)), "word-sets")
        texts = stored(rows.groupBy("key").agg(F.min("doc_id").alias("doc"), F.max("void").alias("void"), *[F.min(x).alias(x) for x in fp]), "texts")
        found = [stored(_candidates(texts, x, radius), f"candidates-{x}") for x in fp]
        pairs = stored(reduce(DataFrame.unionByName, found).where("x < y").distinct(), "pairs")
        unique = rows.groupBy("doc_id").count().where("count > 1").isEmpty()
        ids = texts.select("doc").distinct()
        posts = _postings(_texts_of(docs, ids, ids.count() <= BROADCAST_IDS, not unique), k, similarity)
        # similar texts share a posting, so these give the sizes by which most of the first pairs are out; texts without words have none
        size = posts.select("doc", "n").unionByName(texts.where("void").select("doc", F.lit(0).alias("n"))).groupBy("doc").agg(F.max("n").alias("n"))
        n = lambda c: size.select(F.col("doc").alias(c), F.col("n").alias(f"n_{c}"))
        pairs = pairs.join(n("x"), "x").join(n("y"), "y").where(f"least(n_x, n_y) + 1e-6 >= greatest(n_x, n_y) * {similarity!r}").select("x", "y")
        found = stored(_similar(docs, stored(pairs, "pairs-sized"), k, similarity, not unique), "links")
        later = roots(_linked(docs, posts, found, k, similarity, not unique)).select(F.col("node").alias("doc"), F.lit(True).alias("linked"))
        gone = rows.select("doc_id", "h", "key").join(texts.select("key", "doc").join(later, "doc", "left"), "key").where("linked or doc_id <> doc")
        d, h = fresh(docs, "copy_doc"), fresh(docs, "copy_text")
        gone = stored(gone.select(F.col("doc_id").alias(d), F.col("h").alias(h)).distinct(), "near-copies", keep=True)
        unique = unique or rows.groupBy("doc_id", "key").count().where("count > 1").isEmpty()
    out = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, (F.col("doc_id") == F.col(d)) & (F.xxhash64("text") == F.col(h)), "left_anti")
    return out if unique else out.where("doc_id is null").unionByName(out.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))

r"""Token-ID output: frequency-ranked ids in variable-length bytes, in ascending doc_id order.

Texts become ids where they lie, and the ids are kept in a table in the shared folder. They are counted there (a row for each
vocabulary entry reaches the driver, no more) and ranked by count; then they are dealt to ranges of doc_id, sorted, cut into blocks of
whole documents and written once, as ranks. Ranges are of (doc_id, hash of ids, row), so rows that share a doc_id, or have none,
are split like all others. A file set is a folder with two tables: ``ranks`` (rank, id, n) and ``blocks`` (part, seq, skip, doc_ids,
sizes, n_ids, control, data), in the order of (part, seq); skip counts the part's ids before the block. Spark's committer writes
them, so a lost executor leaves no half block, and any store that Spark reaches will do. A document's start is the count of all
parts before its own, plus skip, plus the documents before it in its block.

Defined cases: a null text is empty and has the end id alone; rows with one doc_id follow one another, in an order that their ids
set; a null doc_id sorts first; a document longer than a block is a block; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.llm import vbyte
from quillgate.llm.common import arrow_runs, dropped, partitions, shared_dir, store
from quillgate.llm.wordtable import DIGIT, KIND, LETTER, LOWER, SHORT, SPACE, Table, keys, put, runs, spelled, texts_of, words

END_ID = 2
CHARS, BLOCK_IDS, KNOWN = 1 << 20, 1 << 18, 1_000_000
#: Text bytes that one output batch comes from, about; bytes of ids in one range.
OUT_BYTES, RANGE_BYTES = 1 << 24, 1 << 27


#: Letters that NFC and lower case leave as they are: the pre-tokenizer keeps a run of them whole.
_PLAIN = re.compile("[" + "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower() and unicodedata.is_normalized("NFC", c)) + "]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others, in order, for 256 and up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}


class WordIds:
    """Ids of texts by a tokenizer file, through a bounded table of pieces.

    The file's model is a byte-level BPE over pieces: runs of letters, single digits, runs of marks, never across white space. So
    texts are cut into such pieces in numpy and each piece meets the tokenizer but once. Pieces of plain letters go
    straight to the model, as normalizer and pre-tokenizer leave them whole. A word (between white space) with a piece that may
    depend on what is beside it - an apostrophe, letters that NFC or lower case change, marks beyond ASCII - is odd: it goes
    through the tokenizer as a whole, and so do all words of a text that holds ``<|``, as special tokens tell cases apart."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.table, self.long, self.odd_words = Table(), {}, {}
        self.pool, self.used, self.n = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), 0, 1
        self.begin, self.size, self.odd = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32), np.zeros(1 << 14, bool)
        self.entry = np.zeros(1 << 14, np.int32)  # by row of the table: the number of its ids

    def _add(self, ids: list[list[int]], odd: list[bool]) -> np.ndarray:
        """Numbers of new entries."""
        flat, size = np.fromiter(chain.from_iterable(ids), self.pool.dtype), np.fromiter(map(len, ids), np.int32, len(ids))
        first, self.n = self.n, self.n + len(ids)
        self.pool = put(self.pool, self.used, flat)
        self.size, self.odd = put(self.size, first, size), put(self.odd, first, np.array(odd, bool))
        self.begin = put(self.begin, first, self.used + np.cumsum(size, dtype=np.int32) - size)
        self.used += len(flat)
        return np.arange(first, self.n, dtype=np.int32)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Entries of pieces; those that may not stand alone have no ids and are marked as odd."""
        ids, odd = [], []
        for w in pieces:
            s, no = w.decode("utf-8", "replace"), False
            if w.isalpha() and s.isascii():
                own = self._letters(s)
            elif w[0] >= 0x80 or KIND[w[0]] == LETTER:
                no = not _PLAIN.fullmatch(s)
                own = [] if no else self._letters(s)
            else:
                no = b"'" in w
                own = [] if no else self.tokenizer.encode(s, add_special_tokens=False).ids
            ids.append(own)
            odd.append(no)
        return self._add(ids, odd)

    def _letters(self, s: str) -> list[int]:
        return [t.id for t in self.model.tokenize(s if s.isascii() else s.encode().decode("latin-1").translate(self.letters))]

    def _pieces(self, low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of each piece."""
        out = np.zeros(len(start), np.int32)
        short = size <= SHORT
        a, b = keys(low, start[short], size[short])
        known = self.table.n
        row = self.table.rows_of(a, b)
        if self.table.n > known:
            flat, n = spelled(self.table.a[known + 1 : self.table.n + 1], self.table.b[known + 1 : self.table.n + 1])
            raw, ends = flat.tobytes(), np.concatenate(([0], np.cumsum(n))).tolist()
            self.entry = put(self.entry, known + 1, self._learn([raw[x:y] for x, y in zip(ends, ends[1:], strict=False)]))
        out[short] = self.entry[row]
        long = np.flatnonzero(~short)
        if len(long):
            out[long] = self._kept(self.long, [low[x : x + n].tobytes() for x, n in zip(start[long].tolist(), size[long].tolist(), strict=True)], self._learn)
        return out

    @staticmethod
    def _kept(known: dict[bytes, int], words: list[bytes], learn: Callable[[list[bytes]], np.ndarray]) -> list[int]:
        new = list(dict.fromkeys(w for w in words if w not in known))
        if new:
            known.update(zip(new, learn(new).tolist(), strict=True))
        return [known[w] for w in words]

    def _whole(self, words: list[bytes]) -> np.ndarray:
        ids = []
        for at in range(0, len(words), 4096):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words[at : at + 4096]], add_special_tokens=False)]
        return self._add(ids, [False] * len(ids))

    def _forget(self) -> None:
        """Keeps what was met first: the frequent pieces are among it."""
        last = KNOWN // 2
        self.table.cut(int(np.searchsorted(self.entry[1 : self.table.n + 1], last)))
        self.long, self.odd_words = ({w: r for w, r in d.items() if r < last} for d in (self.long, self.odd_words))
        self.n, self.used = last, int(self.begin[last - 1] + self.size[last - 1])

    def _run(self, raw: np.ndarray, edges: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each piece or odd word, and where it begins. special: where texts with special tokens' strings lie."""
        if self.n > KNOWN:
            self._forget()
        low = LOWER[raw]
        kind = KIND[low]
        new = np.ones(len(low), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        new[edges] = True
        start = np.flatnonzero(new)
        size, full = np.diff(np.append(start, len(low))), kind[start] != SPACE
        start, size = start[full], size[full]
        entry = self._pieces(low, start, size)
        odd = self.odd[entry] | special[start] if len(special) else self.odd[entry]
        if odd.any():
            first, n = words(kind, edges)
            word = np.searchsorted(first, start, "right") - 1
            bad = np.zeros(len(first), bool)
            bad[word[odd]] = True
            at = np.flatnonzero(bad)
            source = np.where(special, raw, low) if len(special) else low
            own = self._kept(self.odd_words, [source[x : x + k].tobytes() for x, k in zip(first[at].tolist(), n[at].tolist(), strict=True)], self._whole)
            keep = ~bad[word] | (start == first[word])
            start, entry, word = start[keep], entry[keep], word[keep]
            entry[bad[word]] = own
        return entry, start

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has. data: the texts' UTF-8, text i from offsets[i] on."""
        ids, n = [np.zeros(0, self.pool.dtype)], np.zeros(len(offsets) - 1, np.int64)
        for a, z in runs(data, offsets, CHARS):
            raw = data[a:z]
            edges = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, z)] - a
            special = np.zeros(0, bool)
            bars = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))
            if len(bars):
                special = np.zeros(len(raw), bool)
                for i in np.unique(np.searchsorted(offsets, bars + a, "right") - 1).tolist():
                    special[max(int(offsets[i]) - a, 0) : max(int(offsets[i + 1]) - a, 0)] = True
            entry, start = self._run(raw, edges, special)
            size, begin = self.size[entry], self.begin[entry]
            ends = np.cumsum(size, dtype=np.int64)
            ids.append(self.pool[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)])
            before = np.concatenate(([0], ends))
            own = slice(np.searchsorted(offsets, a, "right") - 1, np.searchsorted(offsets, z))  # texts with bytes here
            cuts = before[np.searchsorted(start, np.clip(offsets[own.start : own.stop + 1] - a, 0, z - a))]
            n[own] += np.diff(cuts)
        return np.concatenate(ids), n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode("utf-8", "replace") for t in texts]
        return self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One table for a worker, which keeps it from task to task."""
    return WordIds(path)


def binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """flat cut into so many elements for each row, as bytes."""
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))) * flat.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ids (little-endian bytes, 2 or 4 for each id), the end id included."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_ids(tokenizer_path)
        for b in batches:
            for run in arrow_runs(b, "text", OUT_BYTES):
                ids, n = tok.encode_bytes(*texts_of(run.column("text")))
                ids = np.insert(ids, np.cumsum(n), END_ID)
                yield pa.record_batch({"doc_id": run.column("doc_id"), "ids": binary(ids, n + 1)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, ids binary")


def flat_ids(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and where each row's begin (one more: the end)."""
    data, offsets = texts_of(column)
    return data.view(f"<u{width}"), offsets // width


BLOCK = "part int, seq long, skip long, doc_ids array<long>, sizes array<long>, n_ids long, control binary, data binary"


def _blocker(width: int, rank_of: Broadcast):
    """Sorted documents to blocks of ranks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, skip = TaskContext.get().partitionId(), 0, 0
        for b in (run for batch in batches for run in arrow_runs(batch, "ids", OUT_BYTES)):
            flat, at = flat_ids(b.column("ids"), width)
            block = at[:-1] // BLOCK_IDS
            cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True]))) if len(block) else []
            for x, z in zip(cuts, cuts[1:], strict=False):
                own = flat[at[x] : at[z]]
                control, data = vbyte.encode(rank_of.value[own])
                out = {"part": pa.array([part], pa.int32()), "seq": [seq], "skip": [skip], "doc_ids": [b.column("doc_id")[x:z].to_pylist()], "sizes": [np.diff(at[x : z + 1])], "n_ids": [len(own)], "control": [control], "data": [data]}
                yield pa.record_batch(out, pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("skip", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("control", pa.binary()), ("data", pa.binary())]))
                seq, skip = seq + 1, skip + len(own)

    return work


@dataclass
class TokenFiles:
    path: str

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCK).parquet(f"{self.path}/blocks")

    def ranks(self, spark: SparkSession) -> np.ndarray:
        """Id of each rank; as many rows as the vocabulary has at most."""
        return np.array([x["id"] for x in spark.read.parquet(f"{self.path}/ranks").orderBy("rank").collect()], np.uint32)


def id_counts(ids: DataFrame, vocabulary: int, width: int) -> np.ndarray:
    """How often each id stands in a column ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for b in arrow_runs(batch, "ids", OUT_BYTES):
                total += np.bincount(flat_ids(b.column("ids"), width)[0], minlength=vocabulary)
        yield pa.record_batch({"id": np.flatnonzero(total), "n": total[total > 0]})

    out = np.zeros(vocabulary, np.int64)
    for x in ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[x["id"]] = x["n"]
    return out


def write(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encodes docs and writes a file set to the shared folder."""
    spark = docs.sparkSession
    vocabulary = WordIds(tokenizer_path).tokenizer.get_vocab_size()
    width = 2 if vocabulary <= 1 << 16 else 4
    at = store(encoded(docs, tokenizer_path, id_col, text_col), "token-ids", "snappy")
    ids = spark.read.schema("doc_id long, ids binary").parquet(at)
    counts = id_counts(ids, vocabulary, width)
    order = np.lexsort((np.arange(vocabulary), -counts))[: int((counts > 0).sum())]
    rank_of = np.zeros(vocabulary, np.uint32)
    rank_of[order] = np.arange(len(order))
    path = f"{shared_dir(spark)}/quillgate/tokens-{os.path.basename(at)}"
    spark.createDataFrame([(r, int(i), int(counts[i])) for r, i in enumerate(order)], "rank int, id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    keys = ("doc_id", "tie", "row")
    n = max(partitions(spark), int(counts.sum()) * width // RANGE_BYTES)
    dealt = ids.select("doc_id", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("row"), "ids").repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    final = dealt.select("doc_id", "ids").mapInArrow(_blocker(width, spark.sparkContext.broadcast(rank_of)), BLOCK)
    final.write.option("compression", "none").parquet(f"{path}/blocks")
    dropped(spark, at)
    return TokenFiles(path)


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids (array) from the files."""
    return _read(spark, files, "ids array<long>", lambda ids, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int64())))


def _checksums(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    raw = memoryview(ids.astype("<u4")).cast("B")
    return pa.array([zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(at.tolist(), at[1:].tolist(), strict=False)], pa.int64())


def digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files."""
    return _read(spark, files, "ids_crc32 long", _checksums)


def _read(spark: SparkSession, files: TokenFiles, column: str, made: Callable[[np.ndarray, np.ndarray], pa.Array]) -> DataFrame:
    blocks = files.blocks(spark)
    totals = {x["part"]: x["n"] for x in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row for each range
    before, so_far = {}, 0
    for p in sorted(totals):
        before[p], so_far = so_far, so_far + totals[p]
    held = spark.sparkContext.broadcast((before, files.ranks(spark)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, id_of = held.value
        for b in batches:
            for part, skip, docs, sizes, n, control, data in zip(*(b.column(i) for i in range(b.num_columns)), strict=True):
                ids = id_of[vbyte.decode(control.as_py(), data.as_py(), n.as_py())]
                at = np.concatenate(([0], np.cumsum(sizes.values.to_numpy())))
                yield pa.record_batch({"doc_id": docs.values, "start": before[part.as_py()] + skip.as_py() + at[:-1], "n_tokens": np.diff(at), column.split()[0]: made(ids, at)})

    return blocks.select("part", "skip", "doc_ids", "sizes", "n_ids", "control", "data").mapInArrow(work, f"doc_id long, start long, n_tokens long, {column}")

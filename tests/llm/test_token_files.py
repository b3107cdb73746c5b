import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillgate.llm import token_files as T
from quillgate.llm import vbyte

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40))
def test_coding_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = vbyte.encode(v)
    assert len(control) == -(-len(v) // 4) and (vbyte.decode(control, data, len(v)) == v).all()


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(["Foo", "foo,", "É", "réa", "ΑΣ", "'s", "it's,", ".", "..", "!!,", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y", "3,5.", "日本。", " ", "é", "ﬁ", "İ", "ǅ", "_", "a_b-"]) | st.text(max_size=4), max_size=8), st.sampled_from([" ", "\n", "", "\t "]))
def test_word_table_agrees_with_the_tokenizer(parts, between):
    text = between.join(parts)
    ids, n = WORDS.encode([text, "", text])
    want = WHOLE.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids
    assert ids.tolist() == want * 2 and n.tolist() == [len(want), 0, len(want)]


WORDS, WHOLE = T.WordIds(PATH), Tokenizer.from_file(PATH)


def test_files_read_back_in_order(spark, docs, no_docs, monkeypatch):
    files = T.write(docs, PATH)
    got = T.read(spark, files).collect()
    by_start = sorted(got, key=lambda r: r["start"])
    ids = [None if r["doc_id"] is None else r["doc_id"] for r in by_start]
    assert ids == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    assert [r["start"] for r in by_start] == np.cumsum([0] + [r["n_tokens"] for r in by_start[:-1]]).tolist()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        assert r["ids"] == WHOLE.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [T.END_ID]
    crc = {(r["doc_id"], r["ids_crc32"]) for r in T.digests(spark, files).collect()}
    assert crc == {(r["doc_id"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}
    assert T.digests(spark, T.write(no_docs, PATH)).count() == 0
    ranks = spark.read.parquet(f"{files.path}/ranks").orderBy("rank").collect()
    assert [r["n"] for r in ranks] == sorted((r["n"] for r in ranks), reverse=True)


def test_a_full_table_forgets_and_runs_cut_no_word(monkeypatch):
    monkeypatch.setattr(T, "KNOWN", 40)
    monkeypatch.setattr(T, "CHARS", 64)
    r = np.random.default_rng(0)
    parts = ["the", "THE", "réa", "É", "it's", "'s", "x" * 20, "日本。", ".", "12", "<|endoftext|>", "<|EndOfText|>", "a\x00b", " "] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    texts = [str(between).join(r.choice(parts, r.integers(0, 60))) for between in (" ", "", "\n") for _ in range(40)]
    own = T.WordIds(PATH)
    for _ in range(2):
        ids, n = own.encode(texts)
        at = np.concatenate(([0], np.cumsum(n)))
        for t, a, z in zip(texts, at, at[1:], strict=False):
            assert ids[a:z].tolist() == WHOLE.encode(t, add_special_tokens=False).ids
    assert own.n < 40 + 200


def test_registered_query_against_the_tokenizer(spark):
    import pyarrow.parquet as pq

    from quillgate.llm.queries import QUERIES

    rows = sorted(pq.read_table("/root/testdata/sf0.001/documents.parquet").select(["doc_id", "text"]).to_pylist(), key=lambda r: r["doc_id"])
    want, start = [], 0
    for r in rows:
        ids = WHOLE.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op9_token_output"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == want


def test_ids_beyond_doubles_and_hot_ids(spark):
    big = 2**53 + 1
    rows = [(big, f"text {i}") for i in range(30)] + [(None, "a"), (None, "b"), (big + 1, "c")]
    got = T.digests(spark, T.write(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 0] + [big] * 30 + [big + 1]
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == np.cumsum([0] + [r["n_tokens"] for r in by_start[:-1]]).tolist()
    assert [r["doc_id"] or 0 for r in by_start] == sorted(r["doc_id"] or 0 for r in got)

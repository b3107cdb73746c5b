"""The pipeline's stages and the queries that have no SQL, as registered, against brute force over whole tables."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from test_decontaminate import brute as hits
from test_simhash import brute_kept, components, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as P
from quillgate.llm import langid, mixing
from quillgate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def read(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, and the result of run()."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema if name != "token_output" else "doc_id long, start long, n_tokens long, ids_crc32 long")
        out.append(sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"]))
        assert docs.columns == columns or name == "token_output"
    return out, sorted((r.asDict() for r in P.run(spark, SF).collect()), key=lambda r: r["doc_id"])


def test_language_stage(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    rows = sorted(read("documents"), key=lambda r: r["doc_id"])
    judged = model.judge([r["text"] or "" for r in rows])
    assert stages[0][0] == [r for r, no in zip(rows, judged.rejected, strict=True) if not no]


def test_near_duplicate_stage(stages):
    before, after = stages[0][:2]
    kept = brute_kept([r["text"] for r in before])  # numbers in order of doc_id, so the smallest stays
    assert after == [before[i] for i in kept] and len(after) < len(before)


def test_decontamination_stage(stages):
    before, after = stages[0][1:3]
    found = {i: n for i, _, n, _ in hits([(r["doc_id"], r["text"]) for r in before], [(r["item_id"], r["text"]) for r in read("benchmark")])}
    assert after == [r for r in before if not found[r["doc_id"]]]


def test_mixing_stage(spark, stages):
    before, after = stages[0][2:4]
    rows, name = mixing.mix(spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema), ["doc_id"])
    told = {r["doc_id"]: r for r in rows.select("doc_id", f"{name}.*").collect()}
    assert [r["doc_id"] for r in after] == [i for i in sorted(told) if told[i]["sampled"]]
    assert all(told[r["doc_id"]]["tokens"] == len(r["text"].split()) for r in before)


def test_token_stage_and_run(stages):
    before, after = stages[0][3:]
    tok, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r, x in zip(before, after, strict=True):
        ids = tok.encode(r["text"], add_special_tokens=False).ids + [2]
        assert x == {"doc_id": r["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)
    assert stages[1] == after


def test_op7_query(spark):
    rows = read("documents")
    fps = {r["doc_id"]: fingerprint(r["text"]) for r in rows}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    want = components(fps, near)
    got = QUERIES["op7_simhash_near_dedup"](spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == [(i, f"{fps[i]:016x}", want[i]) for i in sorted(fps)]


def test_op10_query(spark):
    """Cells, raked factors, probabilities and draws: margins of the expected tokens meet their targets over all documents."""
    got = QUERIES["op10_source_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    texts = {r["doc_id"]: r for r in read("documents", "/root/testdata/sf0.01")}
    assert len(got) == len(texts) and (got.tokens == [len((texts[i]["text"] or "").split()) for i in got.doc_id]).all()
    assert (got.source == [texts[i]["source"] for i in got.doc_id]).all() and 1 < got.topic.nunique() <= mixing.TOPICS and got.off.max() < mixing.TOLERANCE
    kept = (got.tokens * got.prob).sum()
    for d in mixing.DIMS:
        own = got.groupby(d).tokens.sum() ** mixing.ALPHA
        share = (got.tokens * got.prob).groupby(got[d]).sum() / kept
        assert (share - own / own.sum()).abs().max() < 1e-3, d
    drawn = got[got.sampled]
    assert drawn.prob.min() > 0 and drawn.tokens.sum() == pytest.approx(kept, rel=0.1)

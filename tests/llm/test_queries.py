import os

import duckdb
import pytest

import corpus_pipeline
from quillgate.llm import queries, sql

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(sql.ORACLES[name])
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want.fetchall()))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = docs.count()
    kept = corpus_pipeline.language_id(spark, docs, DATA)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * n
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0, name
    assert [x for x, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]

import ast
import os
from pathlib import Path

import duckdb
import pytest

from quillgate import queries_release, queries_semantics, registry  # noqa: F401

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    want = con.execute(registry.ORACLES[name])
    cols = [c[0] for c in want.description]
    got = registry.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(cols)
    norm = lambda rows: sorted(str(tuple(round(float(x), 6) if hasattr(x, "real") and not isinstance(x, bool) else x for x in r)) for r in rows)
    assert norm(got.select(*cols).collect()) == norm(want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 8
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_llm_folder():
    for f in (ROOT / "quillgate").rglob("*.py"):
        if "llm" in f.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith(("quillgate.llm", "corpus_pipeline")) for n in names), f

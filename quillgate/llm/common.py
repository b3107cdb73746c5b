"""Shared pieces: table access, the folder all executors share, batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.tables import checkpointed, shared_dir, table  # noqa: F401  for the operators here

#: Lower-cases A-Z alone, as the word rules ask for.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """While it is open, tables that stored() writes without keep are deleted when it ends: what a result still reads is kept."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            dropped(spark, path)


def stored(df: DataFrame, name: str, compression: str = "zstd", keep: bool = False) -> DataFrame:
    """Writes df to a fresh table in the shared folder and reads it back: lineage ends there."""
    path, paths = store(df, name, compression), _SCRATCH.get()
    if paths is not None and not keep:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(df: DataFrame, name: str, compression: str = "zstd") -> str:
    path = f"{shared_dir(df.sparkSession)}/quillgate/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return path


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a table of store() that no later plan reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one, that no column of df has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drawn(share: Column, *key: Column | str) -> Column:
    """Whether a number in [0, 1) that depends on the key alone is below share; 53 bits, so the least share draws something of the
    largest corpus. A null key column counts as a value, so give it others beside (rows without an id differ by their text)."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53)) < share


def held_out(doc_id: str | Column, mod: int) -> Column:
    """crc32 of doc_id as text has remainder 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % mod == 2, F.lit(False))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def slices(texts: Iterable[str], limit: int) -> Iterator[list[int]]:
    """Runs of row numbers whose texts have about limit characters together; a longer text is a run of its own."""
    run, size = [], 0
    for i, t in enumerate(texts):
        if run and size + len(t) > limit:
            yield run
            run, size = [], 0
        run.append(i)
        size += len(t)
    if run:
        yield run


def arrow_runs(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about limit bytes together; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    a, total = 0, 0
    for i, n in enumerate(size):
        if i > a and total + n > limit:
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += n
    if a < batch.num_rows:
        yield batch.slice(a)

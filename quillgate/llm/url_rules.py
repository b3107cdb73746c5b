r"""URL filters by a sort-merge range join with a stack of nested rules.

A host's canonical key is its labels in reverse, ended by ``\0``: what lies below a host starts with the host's key, so
a rule's host is the interval [key, key + '\1'). Rules and pages go into one table that is range-partitioned and sorted
by (key, kind, path, id); a sweep pushes a rule when it meets its start, pops the rules whose interval is over, and
gives each page the longest rule on the stack whose path starts the page's path. Pages of one hot host spread over many
partitions, as path and id are parts of the sort key. A first sweep tells each partition which rules are still open
where it ends; the driver, holding only these (nested prefixes of one key for each partition), hands them on.

Defined cases: a url that is null or without ``://`` has an empty host and path and gets the default verdict; equal
rules count once, and of two verdicts for one rule ``block`` wins; of two rules of one length the more specific host
wins; a null rule host or path is no rule; repeated page rows are all returned; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgate.llm.common import LOWER, UPPER, checkpointed, partitions

DEFAULT = "allow"
PAGE_OUT = "id long, host string, path string, rule string, verdict string"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    r"""Reversed labels, each ended by \0; \0 and \1 inside a label are written \1\2 and \1\3, so order and prefixes hold."""
    safe = F.replace(F.replace(host, F.lit("\1"), F.lit("\1\3")), F.lit("\0"), F.lit("\1\2"))
    return F.concat(F.array_join(F.reverse(F.split(safe, r"\.")), "\0"), F.lit("\0"))


class _Stack:
    """Active rules, outermost first: (key, path, rule, verdict)."""

    def __init__(self, open_rules: list[tuple[str, str, str, str]]):
        self.rules = list(open_rules)

    def at(self, key: str) -> None:
        while self.rules and not key.startswith(self.rules[-1][0]):
            self.rules.pop()

    def best(self, path: str) -> tuple[str | None, str]:
        fits = [(len(r[2]), len(r[0]), r[3] == "block", r) for r in self.rules if path.startswith(r[1])]
        return max(fits)[3][2:] if fits else (None, DEFAULT)


def classify(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id_col, host, path, rule, verdict of every page. rules: host, path, verdict."""
    null = F.lit(None).cast("string")
    p = pages.select(F.col(id_col).cast("long").alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    p = p.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "path", "id", "host", null.alias("verdict"))
    r = rules.where("host is not null and path is not null").select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").distinct()
    r = r.select(host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), "path", F.lit(None).cast("long").alias("id"), "host", "verdict")
    sort = ["key", "kind", "path", "id"]
    both = p.unionByName(r).repartitionByRange(partitions(pages.sparkSession), *sort).sortWithinPartitions(*sort)
    both = checkpointed(both)  # both sweeps must see the same partitions

    def rows(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
        return zip(*(b.column(n).to_pylist() for n in names), strict=True)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, stack = None, None, _Stack([])
        for b in batches:
            if b.num_rows:
                first, last = first if first is not None else b.column("key")[0].as_py(), b.column("key")[-1].as_py()
                for k, path, host, v in rows(b.filter(pc.equal(b.column("kind"), 0)), "key", "path", "host", "verdict"):
                    stack.at(k)
                    stack.rules.append((k, path, host + path, v))
        if first is not None:
            stack.at(last)
            own = stack.rules or [(None, None, None, None)]
            part = pa.array([TaskContext.get().partitionId()] * len(own), pa.int32())
            yield pa.record_batch([part, *(pa.array(c, pa.string()) for c in ([first] * len(own), [last] * len(own), *zip(*own, strict=True)))], ["part", "first", "last", "key", "path", "rule", "verdict"])

    found: dict[int, tuple[str, str, list]] = {}
    for x in both.mapInArrow(ends, "part int, first string, last string, key string, path string, rule string, verdict string").collect():
        own = found.setdefault(x.part, (x.first, x.last, []))[2]
        if x.key is not None:
            own.append((x.key, x.path, x.rule, x.verdict))
    seeds, stack = {}, _Stack([])
    for part in sorted(found):
        first, last, own = found[part]
        stack.at(first)
        seeds[part] = list(stack.rules)
        stack.at(last)
        stack.rules += own

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = _Stack(seeds.get(TaskContext.get().partitionId(), []))
        for b in batches:
            found, key, before = [], None, None
            for k, kind, path, host, v in rows(b, "key", "kind", "path", "host", "verdict"):
                if k != key:
                    stack.at(k)
                    key, before = k, None
                if kind == 0:
                    stack.rules.append((k, path, host + path, v))
                    before = None
                else:
                    if before is None or before[0] != path:  # pages of one key and path follow one another
                        before = path, stack.best(path)
                    found.append(before[1])
            own = b.filter(pc.equal(b.column("kind"), 1)).select(["id", "host", "path"])
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], ["id", "host", "path", "rule", "verdict"])

    return both.mapInArrow(sweep, PAGE_OUT).withColumnRenamed("id", id_col)

"""Documents, files, blobs and refs as tables.

Everything is read by Spark's own readers, so any store that Spark reaches will do. A document is a row ``name, path, raw``;
``raw`` is JSON text, whatever the file was.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.operators.graphs import reached

STEM = r"([^/]*?)(\.[^./]*)?$"


def stem(path: Column | str) -> Column:
    """The file's name without its last suffix."""
    return F.regexp_extract(path, STEM, 1)


def suffix(path: Column | str) -> Column:
    """The last suffix, lower-cased, with its dot; a name that only begins with a dot has none."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))


def _texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    t = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))  # it comes as a URI
    return t.select(path.alias("path"), F.col("value").alias("raw"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """name, path, raw of every .json file under path."""
    return _texts(spark, path, "*.json").select(stem("path").alias("name"), "path", "raw")


def yaml_to_json(texts: DataFrame) -> DataFrame:
    """path, raw with YAML text made JSON; null where it can't be read. Needs PyYAML on the executors."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        def one(text: str | None) -> str | None:
            try:
                return None if text is None else json.dumps(yaml.safe_load(text), default=str)
            except yaml.YAMLError:
                return None

        for b in batches:
            yield b.assign(raw=[one(t) for t in b.raw])

    return texts.select("path", "raw").mapInPandas(work, "path string, raw string")


def yaml_documents(spark: SparkSession, path: str) -> DataFrame:
    """name, path, raw of every .yaml file under path."""
    return yaml_to_json(_texts(spark, path, "*.yaml")).select(stem("path").alias("name"), "path", "raw")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON by suffix, else YAML."""
    return json_documents(spark, path).unionByName(yaml_documents(spark, path))


def files(spark: SparkSession, path: str, pattern: str = "*", ignored: str | None = None) -> DataFrame:
    """path, size, content of all files under path, apart from those whose path the regex `ignored` finds."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    f = f.select("path", F.col("length").alias("size"), "content")
    return f.where(~F.col("path").rlike(ignored)) if ignored else f


def markdown_table(texts: DataFrame, row: str, cells: list[str], text_col: str = "raw") -> DataFrame:
    """The pipe-delimited lines that the regex `row` matches, a column for each cell; missing cells are null, `n_cells` tells."""
    line = texts.select("path", F.explode(F.split(text_col, r"\r?\n")).alias("line")).where(F.col("line").rlike(row))
    c = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    out = line.select("path", c.alias("c"))
    return out.select("path", F.size("c").alias("n_cells"), *[F.try_element_at("c", F.lit(i + 1)).alias(n) for i, n in enumerate(cells)])


def blob(blobs: DataFrame, commit: str, path: str) -> DataFrame:
    """content of a path at a commit; blobs: commit, path, content."""
    return blobs.where((F.col("commit") == commit) & (F.col("path") == path)).select("content")


def hashed(table: DataFrame, content: str = "content") -> DataFrame:
    return table.withColumn("sha256", F.sha2(content, 256))


def yaml_at(blobs: DataFrame, commit: str, path: str) -> DataFrame:
    """path, raw (JSON) of a YAML file at a commit."""
    own = blobs.where((F.col("commit") == commit) & (F.col("path") == path))
    return yaml_to_json(own.select("path", F.decode("content", "UTF-8").alias("raw")))


def refs(lines: DataFrame) -> DataFrame:
    """name, object of a captured listing of remote refs: lines of id, tab, name; of one name the last line counts.
    lines: n (order), value. A name with ^{} is the commit that an annotated tag stands for."""
    part = F.split("value", "\t", 2)
    own = lines.where(F.col("value").contains("\t")).select("n", part[1].alias("name"), part[0].alias("object"))
    return own.groupBy("name").agg(F.max_by("object", "n").alias("object"))


def tags(listed: DataFrame) -> DataFrame:
    """name, object, peeled of the tags of refs()."""
    own = listed.where(F.col("name").startswith("refs/tags/"))
    peeled = own.where(F.col("name").endswith("^{}")).select(F.regexp_replace("name", r"\^\{\}$", "").alias("name"), F.col("object").alias("peeled"))
    return own.where(~F.col("name").endswith("^{}")).join(peeled, "name", "left")


def ancestors(commits: DataFrame, tip: str) -> DataFrame:
    """sha, depth (least) of all that tip reaches, itself included if it is a commit. commits: sha, parent (a row for each parent)."""
    known = commits.select("sha").unionByName(commits.select(F.col("parent").alias("sha"))).distinct()
    found = reached(commits.select(F.col("sha").alias("child"), "parent"), tip)
    return found.withColumnRenamed("node", "sha").join(known, "sha", "left_semi")


def repository_of(url: Column | str) -> Column:
    """owner/name of an SSH or HTTPS remote."""
    u = F.regexp_replace(url, r"\.git$", "")
    return F.when(u.rlike(r"^git@[^:/]+:"), F.regexp_extract(u, r"^git@[^:/]+:(.*)$", 1)).when(u.rlike(r"^https?://[^/]+/"), F.regexp_extract(u, r"^https?://[^/]+/(.*)$", 1)).otherwise(u)


def policy(captured: DataFrame, *fields: str) -> DataFrame:
    """Fields of captured JSON answers (raw) as VARIANT columns."""
    doc = F.try_parse_json("raw")
    return captured.select(*[F.try_variant_get(doc, f"$.{f}", "variant").alias(f) for f in fields])


def first_line(text: Column | str) -> Column:
    return F.split_part(F.trim(text), F.lit("\n"), F.lit(1))

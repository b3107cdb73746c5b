"""Audits as relations: each returns failures (what, detail), and ``check`` makes one row of them.

Inputs are tables: documents (name, path, raw), files (path, size, content), blobs (commit, path, content), commits (sha,
parent), local and remote tags (name, object, peeled), history entries. All checks of a run are evaluated; the first failure
in order is what a run that stops early would report.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgate.sources.documents import ancestors, hashed, suffix
from quillgate.tables import checkpointed

CHECK = "n int, name string, status string, detail string"

# Fixed values of the repository policy.
FORBIDDEN_SUFFIXES = (".key", ".pem", ".p12", ".wav", ".mp3", ".flac", ".ogg", ".mp4", ".mkv", ".vrm", ".pt", ".pth", ".ckpt", ".safetensors", ".onnx", ".engine", ".plan")
FORBIDDEN_PREFIXES = (".env", "checkpoints/", "data/raw/", "data/processed/", "artifacts/", "secrets/", "credentials/", "models/cache/")
SECRET_PATTERNS = {"private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----", "GitHub token": r"\b(?:ghp|github_pat)_[A-Za-z0-9_]{20,}", "generic live secret": r"\b(?:sk_live|sk-[A-Za-z0-9]{20,})"}
SCAN_BYTES = 2_000_000
OPEN_MARKS = r"(?i)\b(TBD|TODO|FIXME)\b"
LINK = r"\[[^\]]*\]\(([^)]+)\)"


def failures(df: DataFrame, what: Column | str, detail: Column | str) -> DataFrame:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return df.select(c(what).cast("string").alias("what"), c(detail).cast("string").alias("detail"))


def check(n: int, name: str, found: DataFrame, passed: str) -> DataFrame:
    """One row: PASS with `passed`, or FAIL with the number of failures and the first of them."""
    x = found.agg(F.count("*").alias("k"), F.min(F.struct("what", "detail")).alias("first"))
    bad = F.concat_ws(" ", F.col("k").cast("string"), F.lit("failed, first:"), F.concat_ws(": ", "first.what", "first.detail"))
    return x.select(F.lit(n).alias("n"), F.lit(name).alias("name"), F.when(F.col("k") == 0, "PASS").otherwise("FAIL").alias("status"), F.when(F.col("k") == 0, F.lit(passed)).otherwise(bad).alias("detail"))


def run(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def values(spark: SparkSession, items: list[str], name: str = "name") -> DataFrame:
    return spark.createDataFrame([(x,) for x in items], f"{name} string")


def set_difference(have: DataFrame, want: DataFrame, key: str = "name") -> DataFrame:
    """Keys that only one side has."""
    both = have.select(key, F.lit(1).alias("h")).distinct().join(want.select(key, F.lit(1).alias("w")).distinct(), key, "full_outer")
    return failures(both.where("h is null or w is null"), key, F.when(F.col("h").isNull(), "missing").otherwise("unexpected"))


def without_match(left: DataFrame, right: DataFrame, key: str = "name", says: str = "has no match") -> DataFrame:
    return failures(left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti"), key, F.lit(says))


def expected_reasons(errors: DataFrame, expected: DataFrame) -> DataFrame:
    """expected: name, reason. A document fails if none of its violated rules (id, rule) contains the reason."""
    told = errors.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("rule")), "; ").alias("told"))
    both = expected.join(told, F.col("name") == F.col("id"), "left")
    return failures(both.where(~F.coalesce(F.contains("told", "reason"), F.lit(False))), "name", F.coalesce("told", F.lit("no violation")))


def invariants(row: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Each condition over one row that isn't true."""
    one = row.select(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in named.items()])
    return failures(one.unpivot([], list(named), "what", "ok").where("not ok"), "what", F.lit("doesn't hold"))


PARTS_MOST = 10_000


def lacking(texts: DataFrame, parts: DataFrame, fold: bool = False) -> DataFrame:
    """Documents (path, raw) that lack one of the wanted texts (path, part); a path of null wants it in every document. Wanted
    texts are collected by path, so each document is read once; those for every document are a short list (`PARTS_MOST`)."""
    low = F.lower if fold else (lambda c: F.col(c) if isinstance(c, str) else c)
    every = [x["part"] for x in parts.where("path is null").select("part").distinct().limit(PARTS_MOST + 1).collect()]
    if len(every) > PARTS_MOST:
        raise ValueError("too many texts are wanted in every document")
    own = parts.where("path is not null").groupBy("path").agg(F.collect_set("part").alias("wanted"))
    both = texts.join(own, "path", "full_outer")
    common = F.when(F.col("raw").isNotNull(), F.array(*map(F.lit, every)).cast("array<string>")).otherwise(F.array().cast("array<string>"))
    want = F.array_union(F.coalesce("wanted", F.array().cast("array<string>")), common)
    lack = F.filter(want, lambda x: ~F.coalesce(F.contains(low("raw"), low(x)), F.lit(False)))
    return failures(both.select("path", F.explode(lack).alias("part")), "path", "part")


def count_is(df: DataFrame, least: int, most: int | None = None) -> DataFrame:
    n = df.agg(F.count("*").alias("n"))
    bad = F.col("n") < least if most is None else ~F.col("n").between(least, most)
    return failures(n.where(bad), F.lit("rows"), "n")


def table_rows(rows: DataFrame, n_cells: int, filled: list[str], fixed: dict[str, str]) -> DataFrame:
    """Rows of markdown_table() with another number of cells, an empty cell among `filled`, or another value in `fixed`."""
    bad = [F.col("n_cells") != n_cells, *[F.coalesce(F.col(c), F.lit("")) == "" for c in filled], *[~F.col(c).eqNullSafe(v) for c, v in fixed.items()]]
    return failures(rows.where(reduce(Column.__or__, bad)), "path", F.coalesce(*[c for c in rows.columns if c not in ("path", "n_cells")], F.lit("")))


def forbidden_keys(docs: DataFrame, prohibited: list[str]) -> DataFrame:
    """Where a key of the list stands in a document (name, raw), at any depth. A round for each level, as SQL's recursion has a limit of
    rows and of levels; what goes on is what holds others."""
    level, found = docs.select("name", F.lit("root").alias("path"), F.col("raw").alias("v")), None
    while True:
        nodes = docs.sparkSession.sql(
            """SELECT n.name, concat(n.path, coalesce('.' || x.key, '[' || x.pos || ']')) AS path, x.key, to_json(x.value) AS v
               FROM {level} n, LATERAL variant_explode(try_parse_json(n.v)) x""",
            level=level,
        )
        own, holds = F.col("key").isin(*prohibited), F.col("v").rlike(r"^[\[{]") & ~F.col("v").isin("{}", "[]")
        nodes = checkpointed(nodes.where(own | holds).select("name", "path", "key", F.when(holds, F.col("v")).alias("v")))
        here = nodes.where(own).select("name", "path")
        found = here if found is None else found.unionByName(here)
        level = nodes.where("v is not null").select("name", "path", "v")
        if level.isEmpty():
            return failures(found, "name", "path")


#: What a sound binding may be.
PREPARATION, RELEASE = "release-preparation", "release-commit"
#: What can be wrong with one, by code.
BINDING_FAULTS = {"unknown": "no such commit", "unreached": "the release doesn't descend from it", "not the parent": "the release's first parent is another commit"}


def binding(commits: DataFrame, definition: str, release: str, allow_preparation: bool = True) -> DataFrame:
    """One row: fault (a code of BINDING_FAULTS, or null), mode if there is none, and the release's first parent. commits: sha,
    parent, and nth where a commit has several parents."""
    nth = F.coalesce("nth", F.lit(0)) if "nth" in commits.columns else F.lit(0)
    facts = commits.agg(F.count_if(F.col("sha") == definition).alias("known"), F.min_by("parent", F.when((F.col("sha") == release) & F.col("parent").isNotNull(), nth)).alias("parent"))
    reach = ancestors(commits, release).agg(F.count_if(F.col("sha") == definition).alias("met"))
    same, parent = F.lit(allow_preparation and definition == release), F.col("parent")
    fault = F.when(F.col("known") == 0, "unknown").when(F.col("met") == 0, "unreached").when(~same & ~parent.eqNullSafe(F.lit(definition)), "not the parent")
    one = facts.crossJoin(F.broadcast(reach)).select(fault.alias("fault"), "parent")  # aggregates without groups: one row each
    return one.select("fault", F.when(F.col("fault").isNull(), F.when(same, PREPARATION).otherwise(RELEASE)).alias("mode"), "parent")


def binding_failures(bound: DataFrame) -> DataFrame:
    says = F.create_map(*[F.lit(x) for kv in BINDING_FAULTS.items() for x in kv])[F.col("fault")]
    return failures(bound.where("fault is not null"), "fault", F.concat(says, F.lit(", parent: "), F.coalesce("parent", F.lit("none"))))


def hash_mismatches(recorded: DataFrame, blobs: DataFrame, commit: str) -> DataFrame:
    """recorded: path, sha256. Missing and differing blobs of a commit."""
    have = hashed(blobs.where(F.col("commit") == commit)).select("path", F.col("sha256").alias("actual"))
    both = recorded.join(have, "path", "left")
    return failures(both.where(~F.col("sha256").eqNullSafe(F.col("actual"))), "path", F.when(F.col("actual").isNull(), "missing").otherwise("hash mismatch"))


def unresolved(left: DataFrame, ids: str, right: DataFrame, key: str) -> DataFrame:
    """Members of an array column that the other table's key lacks."""
    used = left.select(F.explode(ids).alias(key)).distinct()
    return failures(used.join(right.select(key), key, "left_anti"), key, F.lit("isn't defined"))


def falsy(value: Column, kind: str) -> Column:
    """Null, empty text, zero, false, empty array or map."""
    empty = {"string": value == "", "boolean": ~value if kind == "boolean" else F.lit(False)}.get(kind)
    if empty is None:
        empty = F.size(value) == 0 if kind.startswith(("array", "map")) else value == 0 if kind not in ("date", "timestamp", "timestamp_ntz", "binary") and not kind.startswith("struct") else F.lit(False)
    return F.coalesce(empty, F.lit(True))


def incomplete(df: DataFrame, id_col: str, required: list[str]) -> DataFrame:
    """Rows with a required field that is missing or falsy."""
    kinds = dict(df.dtypes)
    lack = F.filter(F.array(*[F.when(falsy(F.col(c), kinds[c]), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    return failures(df.select(F.col(id_col).alias("i"), F.explode(lack).alias("c")), "i", "c")


def open_marks(texts: DataFrame, but: str | None = None) -> DataFrame:
    own = texts.where(F.col("raw").rlike(OPEN_MARKS))
    return failures(own if but is None else own.where(~F.col("path").endswith(but)), "path", F.regexp_extract("raw", OPEN_MARKS, 1))


def links(texts: DataFrame, pattern: str = LINK) -> DataFrame:
    """path, target of relative links, fragments cut off."""
    t = texts.select("path", F.explode(F.regexp_extract_all("raw", F.lit(pattern), F.lit(1))).alias("target"))
    t = t.select("path", F.regexp_replace("target", r"#.*$", "").alias("target"))
    return t.where((F.col("target") != "") & ~F.col("target").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|//)"))


def normalised(path: Column) -> Column:
    """A relative path without . and .. parts."""
    zero = F.array().cast("array<string>")
    up = lambda a: F.when(F.size(a) > 0, F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)
    step = lambda a, x: F.when(x.isin("", "."), a).when(x == "..", up(a)).otherwise(F.array_append(a, x))
    return F.array_join(F.aggregate(F.split(path, "/"), zero, step), "/")


def dead_links(texts: DataFrame, paths: DataFrame, pattern: str = LINK) -> DataFrame:
    """Relative links of texts (path, raw) that lead to none of paths (path: files and folders)."""
    at = links(texts, pattern).withColumn("to", normalised(F.concat(F.regexp_extract("path", r"^(.*/)?[^/]*$", 1), F.lit("/"), F.col("target"))))
    return failures(at.join(paths.select(F.col("path").alias("to")), "to", "left_anti"), "path", "target")


def forbidden_paths(paths: DataFrame) -> DataFrame:
    bad = suffix("path").isin(*FORBIDDEN_SUFFIXES) | reduce(Column.__or__, [F.col("path").startswith(p) for p in FORBIDDEN_PREFIXES])
    return failures(paths.where(bad), "path", F.lit("is forbidden"))


def secrets(files: DataFrame, patterns: dict[str, str] | None = None, most: int = SCAN_BYTES) -> DataFrame:
    """Labels that files (path, content) match; larger files and those that aren't UTF-8 are skipped. One scan for all labels."""
    own = files.where((F.length("content") <= most) & F.is_valid_utf8(F.col("content").cast("string"))).select("path", F.decode("content", "UTF-8").alias("t"))
    hit = F.filter(F.array(*[F.when(F.col("t").rlike(p), F.lit(k)) for k, p in (patterns or SECRET_PATTERNS).items()]), lambda x: x.isNotNull())
    return failures(own.select("path", F.explode(hit).alias("label")), "path", "label")


def history_entry(history: DataFrame, version: str, expected: dict[str, str | int | None]) -> DataFrame:
    """Fields of a version's first entry (by n) that differ from what is expected, or the version if it has no entry."""
    entry = history.where(F.col("version") == version).orderBy("n").limit(1)
    found = invariants(entry, {k: F.col(k).eqNullSafe(F.lit(v)) for k, v in expected.items()})
    return found.unionByName(without_match(values(history.sparkSession, [version], "version"), entry, "version", "has no entry"))


def tag_states(local: DataFrame, remote: DataFrame) -> DataFrame:
    """name, state of every tag that either side has: absent here, absent there, equal or different."""
    r = remote.select("name", F.col("object").alias("r_object"), F.col("peeled").alias("r_peeled"))
    both = local.join(r, "name", "full_outer")
    state = F.when(F.col("object").isNull(), "remote only").when(F.col("r_object").isNull(), "local only").when((F.col("object") == F.col("r_object")) & F.col("peeled").eqNullSafe(F.col("r_peeled")), "equal").otherwise("different")
    return both.select("name", state.alias("state"))


def tag_failures(local: DataFrame, remote: DataFrame, allowed: dict[str, set[str]]) -> DataFrame:
    """Tags whose state isn't among those allowed for them; a tag that both sides lack has the state absent."""
    names = values(local.sparkSession, list(allowed))
    s = names.join(tag_states(local, remote), "name", "left").fillna("absent", ["state"])
    ok = reduce(Column.__or__, [(F.col("name") == k) & F.col("state").isin(*v) for k, v in allowed.items()])
    return failures(s.where(~ok), "name", "state")


def unreachable(commits: DataFrame, tip: str, wanted: str) -> DataFrame:
    """A row if tip doesn't reach the wanted commit."""
    return without_match(values(commits.sparkSession, [wanted], "sha"), ancestors(commits, tip), "sha", f"isn't reached from {tip}")


def proven_absent(status: DataFrame) -> DataFrame:
    """status: what, code. Absence is proven by 404 alone."""
    return failures(status.where(~F.col("code").eqNullSafe(404)), "what", F.when(F.col("code").between(200, 299), "is there").otherwise("isn't known"))


def lacking_values(message: DataFrame, wanted: list[str]) -> DataFrame:
    """Wanted texts that a message (text) lacks."""
    w = values(message.sparkSession, wanted, "part")
    return failures(w.join(message, F.contains(F.col("text"), F.col("part")), "left_anti"), F.lit("message"), "part")


def locked_values(docs: DataFrame, locked: dict[str, tuple[str, str, object]]) -> DataFrame:
    """locked: name of the rule to document name, JSON path and the value that must stand there. Each that doesn't hold; a
    document that is missing fails all its rules. docs: name, raw. One pass, one row."""
    if not locked:
        return failures(docs.limit(0), "name", "name")
    held = {k: F.max(F.when(F.col("name") == d, F.to_json(F.try_variant_get(F.try_parse_json("raw"), path, "variant")) == json.dumps(v, separators=(",", ":"), ensure_ascii=False))) for k, (d, path, v) in locked.items()}
    return invariants(docs.agg(*[c.alias(f"h{i}") for i, c in enumerate(held.values())]), {k: F.col(f"h{i}") for i, k in enumerate(held)})


def tag_facts(tags: DataFrame, name: str, target: str | None) -> DataFrame:
    """exists, annotated, resolves that don't hold for a tag (name, object, peeled)."""
    own = tags.where(F.col("name") == name)
    kinds = {"exists": F.count("*") == 1, "annotated": F.max("peeled").isNotNull(), "resolves": F.max("peeled") == F.lit(target)}
    return invariants(own.agg(*[c.alias(k) for k, c in kinds.items()]), {k: F.col(k) for k in kinds})

"""The composed runs: offline validation, remote audit, release audit, report.

A snapshot is a folder of captured tables; each run turns it into one row for each check. Names, tags and expected values
come in a Policy, so nothing here is tied to one project.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgate.operators import audits as A
from quillgate.operators import contracts as C
from quillgate.sources.documents import markdown_table, stem


@dataclass
class Snapshot:
    """documents: name, contract, path, raw, valid; texts: path, raw; files: path, content; paths: path; blobs: commit, path,
    content; commits: sha, parent; local_tags, remote_tags: name, object, peeled; history: n, version and entry fields; repo:
    repository, visibility, default_branch, has_wiki; status: what, code; runs: id; tag_message: text."""

    documents: DataFrame | None = None
    texts: DataFrame | None = None
    files: DataFrame | None = None
    paths: DataFrame | None = None
    blobs: DataFrame | None = None
    commits: DataFrame | None = None
    local_tags: DataFrame | None = None
    remote_tags: DataFrame | None = None
    history: DataFrame | None = None
    repo: DataFrame | None = None
    status: DataFrame | None = None
    runs: DataFrame | None = None
    tag_message: DataFrame | None = None
    capabilities: DataFrame | None = None
    gates: DataFrame | None = None
    manifest: DataFrame | None = None  # name, raw of the release manifest as the tag has it


@dataclass
class Policy:
    contracts: dict[str, C.Record] = field(default_factory=dict)
    reasons: dict[str, str] = field(default_factory=dict)  # invalid document: part of a violated rule's name
    anchors: list[tuple[str | None, str]] = field(default_factory=list)  # path, text that must be there
    prohibited_keys: list[str] = field(default_factory=list)
    hashes: dict[str, str] = field(default_factory=dict)
    definition: str = ""
    release: str = ""
    repository: str = ""
    baseline: dict[str, dict[str, str | int | None]] = field(default_factory=dict)  # version: entry fields
    tags: dict[str, set[str]] = field(default_factory=dict)  # tag: states that are fine
    message_parts: list[str] = field(default_factory=list)
    marks_but: str | None = None
    roots: list[str] = field(default_factory=list)  # documents that must be there and hold, unless `legacy` names them
    legacy: list[str] = field(default_factory=list)
    locked: dict[str, tuple[str, str, Any]] = field(default_factory=dict)  # invariant: document, JSON path, value
    decisions: str = ""  # where decision records lie: a prefix of paths
    decision_count: int = 0
    decision_headings: list[str] = field(default_factory=list)
    trace: str = ""  # the traceability document's path
    trace_row: str = r"^\| *[A-Z]+-?[0-9]+"
    trace_least: int = 0
    trace_cells: int = 9
    trace_status: str = "accepted"
    historical: tuple[str, str] | None = None  # a tag that must stay, and the commit it stands for


def contract_errors(s: Snapshot, p: Policy) -> DataFrame:
    """id, path, keyword, rule of all documents against their contracts, one scan for each contract."""
    docs = C.parsed(s.documents)
    found = [C.violations(docs.where(F.col("contract") == k), c) for k, c in p.contracts.items()]
    return reduce(DataFrame.unionByName, found)


def root_failures(s: Snapshot, p: Policy, errors: DataFrame) -> DataFrame:
    """Root documents that are missing or break their contract; those that an old release may lack are let off."""
    wanted = A.values(s.documents.sparkSession, [x for x in p.roots if x not in p.legacy])
    broken = errors.join(wanted.withColumnRenamed("name", "id"), "id", "left_semi")
    return A.without_match(wanted, s.documents.where("valid"), says="is missing").unionByName(A.failures(broken, "id", "rule"))


CELLS = [f"c{i}" for i in range(1, 10)]


def decision_failures(s: Snapshot, p: Policy) -> list[tuple[str, DataFrame, str]]:
    """The checks of decision records and the traceability document."""
    spark = s.texts.sparkSession
    records = s.texts.where(F.col("path").startswith(p.decisions))
    headings = spark.createDataFrame([(None, h) for h in p.decision_headings] or [(None, "")], "path string, part string").where("part <> ''")
    ids = records.select(F.lit(p.trace).alias("path"), F.concat(F.lit("ADR-"), F.regexp_extract(stem("path"), r"^([0-9]+)", 1)).alias("part"))
    trace = s.texts.where(F.col("path") == p.trace)
    rows = markdown_table(trace, p.trace_row, CELLS)
    return [
        ("decision records", A.count_is(records, p.decision_count, p.decision_count), f"{p.decision_count} records"),
        ("decision headings", A.lacking(records, headings), f"{len(p.decision_headings)} headings each"),
        ("decisions are traced", A.lacking(trace, ids), "all"),
        ("trace rows", A.count_is(rows, p.trace_least), f"{p.trace_least} at least"),
        ("trace cells", A.table_rows(rows, p.trace_cells, CELLS[2:6], {CELLS[7]: p.trace_status} if p.trace_status else {}), "complete"),
    ]


def ledger_failures(s: Snapshot, p: Policy) -> DataFrame:
    spark = s.history.sparkSession
    return reduce(DataFrame.unionByName, [A.history_entry(s.history, v, e) for v, e in p.baseline.items()], spark.createDataFrame([], "what string, detail string"))


def validate(s: Snapshot, p: Policy) -> DataFrame:
    """n, name, status, detail of the offline checks."""
    spark = s.documents.sparkSession
    for k, c in p.contracts.items():
        C.check_contract(k, c)
    errors = contract_errors(s, p)
    valid, invalid = s.documents.where("valid"), s.documents.where("not valid")
    names = A.values(spark, list(p.contracts), "contract")
    reasons = spark.createDataFrame(list(p.reasons.items()) or [("", "")], "name string, reason string").where("name <> ''")
    wrong = errors.join(valid.select(F.col("name").alias("id")), "id", "left_semi")
    parts = spark.createDataFrame(p.anchors or [(None, "")], "path string, part string").where("part <> ''")
    recorded = spark.createDataFrame(list(p.hashes.items()) or [("", "")], "path string, sha256 string").where("path <> ''")
    checks = [
        ("contract inventory", A.set_difference(s.documents.select("contract"), names, "contract"), f"{len(p.contracts)} contracts"),
        ("valid documents", A.failures(wrong, "id", "rule"), "all hold"),
        ("every contract has a valid document", A.without_match(names, valid, "contract"), "all have"),
        ("invalid inventory", A.set_difference(invalid, reasons), f"{len(p.reasons)} documents"),
        ("invalid documents fail", A.without_match(invalid, errors.select(F.col("id").alias("name")), "name", "has no violation"), "all fail"),
        ("invalid documents fail as intended", A.expected_reasons(errors, reasons), "all reasons"),
        ("anchors", A.lacking(s.texts, parts, fold=True), f"{len(p.anchors)} texts"),
        ("root documents", root_failures(s, p, errors), f"{len(p.roots)} hold"),
        ("locked values", A.locked_values(s.documents.where("valid"), p.locked), f"{len(p.locked)} hold"),
        *(decision_failures(s, p) if p.decisions else []),
        ("ledger", ledger_failures(s, p), f"{len(p.baseline)} entries"),
        ("self-reference", A.forbidden_keys(s.documents.where("valid"), p.prohibited_keys or [""]), "none"),
        ("definition binding", A.binding_failures(A.binding(s.commits, p.definition, p.release)), "bound"),
        ("document hashes", A.hash_mismatches(recorded, s.blobs, p.definition), f"{len(p.hashes)} hashes"),
        ("capability gates", A.unresolved(s.capabilities, "evaluation_id", s.gates, "evaluation_id"), "all defined"),
        ("gate fields", A.incomplete(s.gates, "evaluation_id", [c for c in s.gates.columns if c != "evaluation_id"]), "complete"),
        ("open marks", A.open_marks(s.texts, p.marks_but), "none"),
        ("links", A.dead_links(s.texts, s.paths), "all resolve"),
        ("forbidden paths", A.forbidden_paths(s.paths), "none"),
        ("secrets", A.secrets(s.files), "none"),
        ("release commit", A.without_match(A.values(spark, [p.release], "sha"), s.commits, "sha", "isn't a commit"), "is there"),
        *([("historical tag", A.tag_facts(s.local_tags, f"refs/tags/{p.historical[0]}", p.historical[1]), p.historical[0])] if p.historical else []),
    ]
    return A.run([A.check(i, *c) for i, c in enumerate(checks, 1)])


def audit_remote(s: Snapshot, p: Policy) -> DataFrame:
    """n, name, status, detail of the checks against captured hosting state."""
    closed = {"visibility": F.upper("visibility") == "PRIVATE", "default branch": F.col("default_branch") == "main", "wiki": F.col("has_wiki").eqNullSafe(F.lit(False))}
    checks = [
        ("origin", A.invariants(s.repo, {"repository": F.col("repository") == p.repository}), p.repository),
        ("hosting policy", A.invariants(s.repo, closed), "closed"),
        ("pages", A.proven_absent(s.status), "absent"),
        ("workflows", A.failures(s.runs, "id", F.lit("ran")).unionByName(A.failures(s.paths.where(F.col("path").startswith(".github/workflows/")), "path", F.lit("is a workflow"))), "none"),
        ("tags", A.tag_failures(s.local_tags, s.remote_tags, p.tags), "as allowed"),
        ("main is reached", A.unreachable(s.commits, p.release, p.definition), "yes"),
    ]
    return A.run([A.check(i, *c) for i, c in enumerate(checks, 1)])


def audit_release(s: Snapshot, p: Policy, tag: str) -> DataFrame:
    """n, name, status, detail of the checks of one annotated tag."""
    recorded = s.documents.sparkSession.createDataFrame(list(p.hashes.items()) or [("", "")], "path string, sha256 string").where("path <> ''")
    checks = [
        ("tag", A.tag_facts(s.local_tags, f"refs/tags/{tag}", p.release), tag),
        ("local and remote tag", A.tag_failures(s.local_tags, s.remote_tags, {f"refs/tags/{tag}": {"equal"}}), "equal"),
        ("definition binding", A.binding_failures(A.binding(s.commits, p.definition, p.release, allow_preparation=False)), "bound"),
        ("document hashes", A.hash_mismatches(recorded, s.blobs, p.definition), f"{len(p.hashes)} hashes"),
        *([("tagged manifest", A.forbidden_keys(s.manifest, p.prohibited_keys or [""]), "no self-reference")] if s.manifest is not None else []),
        ("ledger", ledger_failures(s, p), f"{len(p.baseline)} entries"),
        ("tag message", A.lacking_values(s.tag_message, p.message_parts), f"{len(p.message_parts)} values"),
    ]
    return A.run([A.check(i, *c) for i, c in enumerate(checks, 1)])

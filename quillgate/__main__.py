"""The composed runs on a command line: ``python -m quillgate validate|audit-remote|audit-release``.

``--snapshot`` is a folder with a Parquet table for each field of a Snapshot that there is; ``--policy`` names a Policy as
``module:attribute``. A line is printed for each check; the exit code is 1 if one fails, 2 if the run itself can't be made.
"""

from __future__ import annotations

import argparse
import importlib
import sys
from dataclasses import fields

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from quillgate.plans import release
from quillgate.sources import reports


def snapshot(spark: SparkSession, folder: str) -> release.Snapshot:
    found = {}
    for f in fields(release.Snapshot):
        try:
            found[f.name] = spark.read.parquet(f"{folder}/{f.name}")
        except AnalysisException:  # a table that this run doesn't need
            continue
    return release.Snapshot(**found)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = argparse.ArgumentParser(prog="quillgate", description=__doc__)
    a.add_argument("run", choices=["validate", "audit-remote", "audit-release"])
    a.add_argument("--snapshot", required=True)
    a.add_argument("--policy", required=True)
    a.add_argument("--tag")
    a.add_argument("--report", help="folder for a Markdown report")
    o = a.parse_args(args)
    if o.run == "audit-release" and not o.tag:
        a.error("audit-release needs --tag")
    spark = spark or SparkSession.builder.appName("quillgate").getOrCreate()
    module, _, name = o.policy.partition(":")
    policy = getattr(importlib.import_module(module), name or "POLICY")
    s = snapshot(spark, o.snapshot)
    runs = {"validate": lambda: release.validate(s, policy), "audit-remote": lambda: release.audit_remote(s, policy), "audit-release": lambda: release.audit_release(s, policy, o.tag)}
    checks = runs[o.run]().collect()
    checks = spark.createDataFrame(checks, "n int, name string, status string, detail string")
    for line in reports.lines(checks):
        print(line)
    if o.report:
        reports.write_markdown(checks, o.report, f"{o.run} report", {"snapshot": o.snapshot, **({"tag": o.tag} if o.tag else {})})
    return reports.exit_code(checks)


if __name__ == "__main__":
    sys.exit(main())

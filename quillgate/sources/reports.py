"""Sinks for check results: console lines with an exit code, and a Markdown report. A check table has a row for each check of
a run, some dozens, and is the only thing that is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lines(checks: DataFrame) -> list[str]:
    """One line for each check, in order."""
    return [f"{x['status']}: {x['name']}: {x['detail']}" for x in checks.orderBy("n").collect()]


def first_failure(checks: DataFrame) -> DataFrame:
    """The line of a run that stops at its first failing check."""
    return checks.where("status <> 'PASS'").orderBy("n").limit(1)


def exit_code(checks: DataFrame) -> int:
    return int(not checks.where("status <> 'PASS'").isEmpty())


def markdown(checks: DataFrame, title: str, facts: dict[str, str]) -> str:
    """A report whose every line comes from data."""
    rows = checks.orderBy("n").collect()
    failed = sum(x["status"] != "PASS" for x in rows)
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}", "", f"Result: {'FAIL' if failed else 'PASS'} ({len(rows)} checks, {failed} failed)", ""]
    out += [f"- {k}: {v}" for k, v in facts.items()]
    out += ["", "| check | status | detail |", "|---|---|---|", *[f"| {cell(x['name'])} | {x['status']} | {cell(x['detail'])} |" for x in rows], ""]
    return "\n".join(out)


def write_markdown(checks: DataFrame, path: str, title: str, facts: dict[str, str]) -> None:
    """Writes the report as one text file in the folder `path`, through Spark, so any store will do."""
    spark = checks.sparkSession
    spark.createDataFrame([(markdown(checks, title, facts),)], "value string").coalesce(1).write.mode("overwrite").text(path)

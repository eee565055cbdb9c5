"""Jobs: SQL files, statistics, rule sets and derived tables, run step by step."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ruleframe.operators.checks import (
    FORMAT_PROBLEM_CODE,
    check_rules,
    format_problems,
    report_lines,
)
from ruleframe.operators.derive import derive
from ruleframe.operators.stats import analyze
from ruleframe.session import run_folder, session_settings, stage
from ruleframe.sources.rules import (
    TIME_FORMAT,
    clean_rules,
    load_rules,
    publish_rules,
    read_rules,
    select_rules,
)
from ruleframe.sources.sqltext import source_from_sql
from ruleframe.sources.tables import read_back, write_result

# Keys of step records. The store keys may also be given as rules and rulestable.
STORE_KEYS = {"rules": "maprdbtablepath", "rulestable": "maprdbtablefilter"}


class RulesRun(NamedTuple):
    """Outcome of a rules job: the problems, the published rules if there were none, the code."""

    problems: DataFrame
    published: DataFrame | None
    code: int


def run_sql(spark: SparkSession, path: str) -> DataFrame:
    """Run the statement of a SQL file. Commands act at once; a query is returned unexecuted."""
    return source_from_sql(spark, path)


def run_stats(spark: SparkSession, step: Mapping) -> None:
    """Statistics step: tablename, and optionally partitionkeys and columns."""
    analyze(spark, step["tablename"], step.get("partitionkeys", ()), step.get("columns", ()))


def run_aggregate(
    spark: SparkSession, step: Mapping, rules: DataFrame | None = None
) -> DataFrame:
    """Derive a table from a SQL file and published rules, store it and read it back.

    Keys: sqlfile, viewname, tablename, location, and levels ("low,high"), rules (path or table
    of published rules) and rulestable (the TableName to select). Optional: numpartition (shuffle
    width of this step, 0 keeps the session's), ansi, windows, stagesource and partitionby. ``rules``
    replaces the published rules. Intermediate tables are deleted after the write.
    """
    if rules is None:
        rules = load_published(spark, _value(step, "rules"))
    if "levels" not in step:
        raise ValueError("an aggregator step needs levels")
    low, high = (int(level) for level in step["levels"].split(","))
    rules = select_rules(rules, _value(step, "rulestable"), low, high)
    settings = {}
    if int(step.get("numpartition", 0)) > 0:
        settings["spark.sql.shuffle.partitions"] = step["numpartition"]
    with session_settings(spark, settings), run_folder(spark):
        result = derive(
            source_from_sql(spark, step["sqlfile"]),
            rules,
            view=step.get("viewname"),
            windows=step.get("windows", "join"),
            stage_source=step.get("stagesource", False),
            ansi=step.get("ansi"),
        )
        write_result(result, step["tablename"], step["location"], step.get("partitionby", ()))
    stored = read_back(spark, step["location"])
    if "viewname" in step:
        stored.createOrReplaceTempView(step["viewname"])  # the derivation's tables are gone
    return stored


def load_published(spark: SparkSession, source: str) -> DataFrame:
    """Published rules from a catalog table, or else from a Parquet path."""
    is_path = "/" in source or not spark.catalog.tableExists(source)
    return load_rules(spark, path=source) if is_path else load_rules(spark, table=source)


def run_steps(spark: SparkSession, steps: Iterable[Mapping]) -> list[DataFrame | None]:
    """Run step records in list order; the result of each, None for statistics."""
    run = {
        "stats": run_stats,
        "analyze": run_stats,
        "execsql": lambda spark, step: run_sql(spark, step["sqlfile"]),
        "aggregator": run_aggregate,
    }
    steps = list(steps)
    unknown = [step["type"] for step in steps if step["type"] not in run]
    if unknown:
        raise ValueError(f"unknown step types: {', '.join(unknown)}")
    return [run[step["type"]](spark, step) for step in steps]


def run_rules(
    spark: SparkSession,
    path: str,
    target: str | None = None,
    table: str | None = None,
    source_columns: Sequence[str] | None = None,
    report: str | None = None,
) -> RulesRun:
    """Read a rules file, check it and publish it to a path or table if nothing is wrong.

    Format problems end the run with code 100 before anything else is checked; other problems
    only block publishing. ``report`` is a folder for the problems as text lines.
    """
    at = datetime.now().strftime(TIME_FORMAT)
    rules = stage(read_rules(spark, path), "rules")  # read and numbered once, used by every check
    problems, code = format_problems(rules), FORMAT_PROBLEM_CODE
    if problems.isEmpty():
        problems, code = check_rules(rules, source_columns), 0
    blocked = code != 0 or not problems.isEmpty()
    if report is not None:
        report_lines(problems, at).write.mode("overwrite").text(report)
    published = None if blocked else publish_rules(clean_rules(rules), target, table, at)
    return RulesRun(problems, published, code)


def _value(step: Mapping, key: str) -> str:
    return step[key] if key in step else step[STORE_KEYS[key]]

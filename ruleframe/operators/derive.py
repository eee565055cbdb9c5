"""Levelled column derivation: the rules of one table applied to a DataFrame."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleframe.functions.calls import calls_any, expand_calls, replace_calls
from ruleframe.functions.levels import level_number
from ruleframe.operators.distinct import RunningDistincts, attach_running_distinct
from ruleframe.operators.groups import AGGREGATES, GroupValues, attach_groups, group_table, group_tables
from ruleframe.operators.running import RunningValues, attach_running, by_running_values
from ruleframe.operators.sliding import SlidingValues, attach_sliding, by_sliding_sums
from ruleframe.session import session_settings, stage

FILTERED = re.compile(r"\bFILTER\s*\(\s*WHERE\b", re.I)
# A star that stands for all columns, as in struct(*) or v.*; count(*) needs none
STAR = re.compile(r"(?<!\bcount)\s*[(]\s*\*|[,.]\s*\*")
# Aggregates that are not taken apart
OTHER_AGGREGATES = frozenset(
    "array_agg collect_list first first_value histogram_numeric last last_value listagg median "
    "percentile percentile_approx string_agg".split()
)


class Rule(NamedTuple):
    """One derived column: ``CAST(expression AS type) AS column`` at a level."""

    seq_no: int
    column: str
    type: str
    level: int
    expression: str


def rule_list(rules: DataFrame | Iterable[Sequence]) -> list[Rule]:
    """Rules in order of level and sequence number, repeated rows once.

    The rules become the text of one plan, so they are read to the driver; the data is not.
    """
    if isinstance(rules, DataFrame):
        names = [F.trim(c) for c in ("ColumnName", "DataType", "Expression")]
        column, data_type, expression = names
        level = level_number("Level")
        rules = rules.select("seq_no", column, data_type, level, expression).distinct().collect()
    ordered = dict.fromkeys(Rule(*rule) for rule in rules)
    for rule in ordered:
        if rule.level is None:
            raise ValueError(f"rule {rule.seq_no} has no level")
    return sorted(ordered, key=lambda rule: (rule.level, rule.seq_no))


def derive(
    df: DataFrame,
    rules: DataFrame | Iterable[Sequence],
    *,
    view: str | None = None,
    windows: str = "join",
    stage_groups: bool = True,
    stage_source: bool = False,
    blocks: int = 0,
    ansi: bool | None = None,
) -> DataFrame:
    """Apply rules level by level.

    Level 0 replaces the columns of ``df``; every later level keeps all columns and adds its own,
    which may use the columns of lower levels only. Levels without rules change nothing, and no
    rules at all give ``df`` back. Values that do not fit a rule's type become null.

    view: name under which rule text may refer to the relation; the view is registered per level.
    windows: "join" keeps a large key from landing in one task: whole-group windows become a
        grouped aggregate joined back, running values and sliding frames are computed in blocks. "spark" leaves every
        window to Spark, which reads the source once and suits evenly spread keys.
    blocks: the least number of blocks in which "join" computes running values; 0 leaves it to the
        session's shuffle partitions. Other ordered windows are always Spark's, and a RuntimeWarning
        names each.
    stage_groups: write each group table to the shared folder before it is joined, so that the
        planner knows its size and broadcasts a small one without shuffling the rows. Without it
        nothing is computed here, but the rows are shuffled before the size is known.
    stage_source: write the rows to the shared folder before the first group values, so that a source
        with joins or windows of its own is evaluated once. Without it every group table evaluates
        the source again, which is the better plan for a bare scan.
    ansi: run the rule text with or without ANSI errors; by default as the session does. Without
        them a division by zero or a bad cast inside an expression is null.
    """
    if windows not in ("join", "spark"):
        raise ValueError(f"windows must be 'join' or 'spark', not {windows!r}")
    rules = rule_list(rules)
    if not any(rule.level > 0 for rule in rules):
        rules = [rule for rule in rules if rule.level == 0]
    # A column of the same level must not be visible, which implicit lateral aliases would allow.
    settings = {"spark.sql.lateralColumnAlias.enableImplicitResolution": "false"}
    if ansi is not None:
        settings["spark.sql.ansi.enabled"] = str(ansi).lower()
    joined = stage_source
    with session_settings(df.sparkSession, settings):
        df = _named(df, view)
        for level in dict.fromkeys(rule.level for rule in rules):
            step = [rule for rule in rules if rule.level == level]
            _refuse_redefinition(df.columns if level else [], step)
            df, joined = _apply(df, step, level, view, windows, stage_groups, blocks, joined)
            df = _named(df, view)
    return df


def project_level(df: DataFrame, rules: Iterable[Sequence], windows: str = "join") -> DataFrame:
    """Level 0: exactly the rules' columns. A rule with an aggregate gives a single row."""
    return derive(df, [Rule(*r)._replace(level=0) for r in rules], windows=windows)


def append_level(df: DataFrame, rules: Iterable[Sequence], windows: str = "join") -> DataFrame:
    """A later level: all columns of ``df`` and the rules' columns after them."""
    return derive(df, [Rule(*r)._replace(level=1) for r in rules], windows=windows)


def _apply(
    df: DataFrame,
    rules: list[Rule],
    level: int,
    view: str | None,
    windows: str,
    stage_groups: bool,
    blocks: int,
    joined: bool,
) -> tuple[DataFrame, bool]:
    found, running, sliding = GroupValues(), RunningValues(), SlidingValues()
    distinct = RunningDistincts()
    texts = [distinct.extract(rule.expression) for rule in rules]
    total = level == 0 and _collapses(df, texts)
    if windows == "join" and total:
        return _grand_total(df, rules), False
    if windows == "join":
        texts = [by_sliding_sums(by_running_values(text, df), df) for text in texts]
        texts = [found.extract(text) for text in texts]
        texts = [sliding.extract(running.extract(text)) for text in texts]
        for rule, text in zip(rules, texts):
            _warn_of_windows(rule, text)
    in_blocks = [*running.names, *sliding.names, *distinct.names]
    if level == 0 and (in_blocks or joined and found.names):
        df = _aliased(_needed(df, [rule.expression for rule in rules]), view)
    if joined and found.names:
        # The rows already hang on one join back. Grouping them again would compute everything
        # below once more per level, doubling the work each time; a written table is read instead.
        df = _aliased(stage(df, "level"), view)
    source = df
    keep = (lambda groups: stage(groups, "groups")) if stage_groups else None
    for keys, groups, values in group_tables(source, found.by_keys(), keep):
        df = attach_groups(df, keys, groups, values)
    for window, values in running.by_window().items():
        df = _aliased(attach_running(df, window, values, view, blocks), view)
    for (window, frame), values in sliding.by_frame().items():
        df = _aliased(attach_sliding(df, window, frame, values, view, blocks), view)
    for window, values in distinct.by_window().items():
        df = _aliased(attach_running_distinct(df, window, values, view, blocks), view)
    columns = _columns(rules, texts)
    helpers = [*found.names, *in_blocks]
    result = df.select(*columns) if level == 0 else df.select("*", *columns).drop(*helpers)
    # running values have written the rows, so nothing hangs on a join back any more
    return result, (joined or bool(found.names)) and not running.names or bool(sliding.names or distinct.names)


def _columns(rules: list[Rule], texts: list[str]) -> list[Column]:
    return [
        F.expr(expand_calls(text)).try_cast(rule.type).alias(rule.column)
        for rule, text in zip(rules, texts)
    ]


def _warn_of_windows(rule: Rule, text: str) -> None:
    """Name the windows that stay Spark's: all rows of a key, or of the table, meet in one task."""

    def one(name: str, args: str, over: str | None) -> None:
        if over is not None:
            rows = "a key" if re.match(r"\s*PARTITION\b", over, re.I) else "the whole table"
            warnings.warn(
                f"rule {rule.seq_no}, column {rule.column}: {name} OVER ({over}) takes all rows of "
                f"{rows} to one task",
                RuntimeWarning,
                stacklevel=2,
            )

    replace_calls(text, one)


def _needed(df: DataFrame, texts: list[str]) -> DataFrame:
    """The columns whose names occur anywhere in level 0, before rows are written for running values.

    Names that the source repeats go as well, since no rule can refer to them.
    """
    names = [name.lower() for name in df.columns]
    once = df
    if len(set(names)) < len(names):
        once = df.toDF(*[
            f"__repeated_{i}" if names.count(name.lower()) > 1 else name
            for i, name in enumerate(df.columns)
        ])
    whole = " ".join(texts).lower()
    every = STAR.search(whole)
    kept = [
        name for name in once.columns
        if not name.startswith("__repeated_") and (every or "`" in name or name.lower() in whole)
    ]
    return once.select(*[F.col("`" + name.replace("`", "``") + "`") for name in kept or once.columns[:1]])


def _grand_total(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Level 0 with aggregates: one row. Most common values are counted before they meet."""
    found = GroupValues()
    texts = [found.extract_totals(rule.expression) for rule in rules]
    values = found.by_keys().get((), {})
    modes = [value for value in values.values() if value.mode_input() is not None]
    if not modes or _aggregates(texts) or any(FILTERED.search(text) for text in texts):
        return df.select(*_columns(rules, [rule.expression for rule in rules]))
    return group_table(df, (), values).select(*_columns(rules, texts))


def _collapses(df: DataFrame, texts: list[str]) -> bool:
    """Whether a level 0 is a grand total, whose windows see its single row only.

    The analyzer knows: next to a column of the source an aggregate would need a grouping.
    """
    if not df.columns:
        return _aggregates(texts)
    beside = [F.expr(expand_calls(text)) for text in texts]
    try:
        df.select(F.col(f"`{df.columns[0]}`") if len(set(df.columns)) == len(df.columns) else "*", *beside).schema
    except AnalysisException as error:
        return error.getCondition() in ("MISSING_GROUP_BY", "MISSING_AGGREGATION")
    return False


def _aggregates(texts: list[str]) -> bool:
    return any(calls_any(text, AGGREGATES | OTHER_AGGREGATES) for text in texts)


def _named(df: DataFrame, view: str | None) -> DataFrame:
    if view is not None:
        df.createOrReplaceTempView(view)
    return _aliased(df, view)


def _aliased(df: DataFrame, view: str | None) -> DataFrame:
    return df if view is None else df.alias(view)


def _refuse_redefinition(existing: Iterable[str], rules: list[Rule]) -> None:
    seen = {name.lower() for name in existing}
    for rule in rules:
        if rule.column.lower() in seen:
            raise ValueError(
                f"rule {rule.seq_no}: column {rule.column} of level {rule.level} exists already"
            )
        seen.add(rule.column.lower())

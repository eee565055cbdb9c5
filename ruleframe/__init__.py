"""Derived analytical tables from declared rules, on Spark."""

from ruleframe.functions.aggregates import (
    collect_ws,
    most_common,
    most_common_by,
    register_functions,
    weighted_average,
)
from ruleframe.functions.calls import expand_calls
from ruleframe.operators.checks import (
    Field,
    check_duplicates,
    check_fields,
    check_rules,
    duplicate_rows,
    report_lines,
)
from ruleframe.operators.derive import Rule, append_level, derive, project_level
from ruleframe.operators.groups import with_group_values
from ruleframe.operators.increment import attach_increment, group_state, merge_states
from ruleframe.operators.lineage import lowest_levels, rule_lineage
from ruleframe.operators.references import check_references, expression_references
from ruleframe.operators.sketches import (
    column_histogram,
    merged_statistics,
    partition_statistics,
    replaced_partitions,
)
from ruleframe.operators.stats import analyze, profile, read_stats
from ruleframe.operators.temporal import join_as_of, join_intervals
from ruleframe.plans.jobs import run_aggregate, run_rules, run_sql, run_stats, run_steps
from ruleframe.session import run_folder
from ruleframe.sources.rules import (
    clean_rules,
    load_rules,
    number_rows,
    publish_rules,
    read_rules,
    select_rules,
)
from ruleframe.sources.sqltext import run_sql_text as sql
from ruleframe.sources.sqltext import source_from_sql
from ruleframe.sources.tables import (
    create_table_from_rules,
    drop_table,
    read_back,
    write_result,
)

__all__ = [
    "Field", "Rule", "analyze", "append_level", "attach_increment", "check_duplicates",
    "check_fields", "check_references", "check_rules", "clean_rules", "collect_ws",
    "column_histogram", "create_table_from_rules", "derive", "drop_table", "duplicate_rows",
    "expand_calls", "expression_references", "group_state", "join_as_of", "join_intervals",
    "load_rules", "lowest_levels", "merge_states", "merged_statistics", "most_common",
    "most_common_by", "number_rows", "partition_statistics", "profile", "project_level",
    "publish_rules", "read_back", "read_rules", "read_stats", "register_functions",
    "replaced_partitions", "report_lines", "rule_lineage", "run_aggregate", "run_folder",
    "run_rules", "run_sql", "run_stats", "run_steps", "select_rules", "source_from_sql", "sql",
    "weighted_average", "with_group_values", "write_result",
]

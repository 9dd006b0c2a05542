"""Row labelling: every row with all the rules it breaks.

One projection evaluates every row-level rule. Splitting a batch filters on the
plain boolean predicates first, so the reasons array is only built for the few
rows that need one. The array is made with ``concat`` of constant arrays: unlike
the lambda-based array functions it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsieve.functions.predicates import literal, quoted
from feedsieve.operators.references import mark_unknown_keys
from feedsieve.rules import Rule, readable, row_rules

References = Mapping[str, DataFrame] | DataFrame


def as_references(references: References | None) -> Mapping[str, DataFrame]:
    """A lone DataFrame stands for the ``instrument`` table."""
    if references is None:
        return {}
    if isinstance(references, DataFrame):
        return {"instrument": references}
    return references


def rule_flags(
    df: DataFrame, references: References | None, rules: Sequence[Rule]
) -> tuple[DataFrame, dict[str, str]]:
    """Input with its reference markers, and one failure flag per readable row rule.

    Flags are SQL text, true for an offending row and never null.
    """
    usable = [r for r in row_rules(rules) if readable(r, df.columns)]
    marked, unknown = mark_unknown_keys(df, usable, as_references(references))
    return marked, {r.name: unknown[r.name] if r.name in unknown else _flag(r) for r in usable}


def _flag(rule: Rule) -> str:
    return rule.failure if rule.never_null else f"coalesce({rule.failure}, false)"


def any_failure(flags: Mapping[str, str]) -> str:
    return "(" + (" OR ".join(f"({flag})" for flag in flags.values()) or "false") + ")"


def reasons_column(flags: Mapping[str, str]) -> str:
    """Names of the broken rules, in declaration order."""
    none = "slice(array(''), 1, 0)"  # empty, and known to hold no nulls
    parts = [
        f"CASE WHEN {flag} THEN array({literal(name)}) ELSE {none} END"
        for name, flag in flags.items()
    ]
    return f"concat({', '.join(parts)})" if parts else none


def _require_row_rules(rules: Sequence[Rule]) -> None:
    if not row_rules(rules):
        raise ValueError("no quarantinable rules")


def _labelled(marked: DataFrame, columns: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    # A column of that name in a drifted input gives way.
    kept = [quoted(c) for c in columns if c != "reasons"]
    return marked.selectExpr(*kept, f"{reasons_column(flags)} AS reasons")


def with_reasons(
    df: DataFrame, references: References | None, rules: Sequence[Rule]
) -> DataFrame:
    """Every row with its ``reasons`` array; empty for a valid row."""
    _require_row_rules(rules)
    marked, flags = rule_flags(df, references, rules)
    return _labelled(marked, df.columns, flags)


def failing_rows(
    df: DataFrame, references: References | None, rules: Sequence[Rule]
) -> DataFrame:
    """Rows breaking at least one rule, with ``reasons``."""
    _require_row_rules(rules)
    marked, flags = rule_flags(df, references, rules)
    return _labelled(marked.where(any_failure(flags)), df.columns, flags)


def valid_rows(df: DataFrame, references: References | None, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking no row-level rule; table-level failures exclude nothing."""
    _require_row_rules(rules)
    marked, flags = rule_flags(df, references, rules)
    return marked.where(f"NOT {any_failure(flags)}").select(*df.columns)


def batch_split(
    df: DataFrame, references: References | None, rules: Sequence[Rule]
) -> DataFrame:
    """Counts of one pass over the batch; valid and rejected add up to the input."""
    _require_row_rules(rules)
    marked, flags = rule_flags(df, references, rules)
    broken = any_failure(flags)
    return marked.agg(
        F.expr("count(1) AS rows_total"),
        F.expr(f"count_if(NOT {broken}) AS rows_valid"),
        F.expr(f"count_if({broken}) AS rows_rejected"),
    )


def offenders(
    df: DataFrame, references: References | None, rule: Rule, columns: Sequence[str]
) -> DataFrame:
    """Rows breaking one row-level rule, reading only the columns that needs."""
    wanted = [c for c in dict.fromkeys([*columns, *rule.columns]) if c in df.columns]
    source = df.select(*wanted) if rule.columns else df
    return failing_rows(source, references, [rule]).select(*columns)

"""Data quality rules, declared once.

A rule is data: a kind, the columns it reads and, for row-level kinds, one SQL
predicate that is true for an offending row. The report counts that predicate
and the quarantine labels rows with that same predicate, so the two cannot
drift apart. A caller adds a check by appending a ``Rule`` to the list; no
operator needs to change.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from feedsieve.functions import predicates as P
from feedsieve.schemas import TRADE_COLUMNS

PREDICATE = "predicate"
EXISTS_IN = "exists_in"
UNIQUE = "unique"
FRESH = "fresh"
COLUMNS = "columns"

ROW_KINDS = frozenset({PREDICATE, EXISTS_IN})

# Fixed value: the age given to a table without any execution time.
NEVER_TRADED_DAYS = 99999


@dataclass(frozen=True)
class Rule:
    """One quality rule.

    ``columns`` are the input columns the rule reads; when one is missing from
    the input the rule is reported as failed instead of breaking the run.
    ``failure`` is the SQL predicate of a ``predicate`` rule. ``reference``
    names the lookup table and its key column for an ``exists_in`` rule.
    ``never_null`` says that ``failure`` is true or false for every row; other
    predicates are read as false where they are null, which keeps them from
    being pushed to the scan.
    """

    name: str
    category: str
    description: str
    kind: str
    columns: tuple[str, ...] = ()
    failure: str | None = None
    reference: tuple[str, str] | None = None
    max_age_days: int | None = None
    expected_columns: tuple[str, ...] = ()
    never_null: bool = False

    @property
    def scope(self) -> str:
        return "row" if self.kind in ROW_KINDS else "table"

    @property
    def quarantinable(self) -> bool:
        """Whether the rule can be blamed on individual rows."""
        return self.kind in ROW_KINDS


def _guarded(name: str, column: str, failure: str, description: str, category: str) -> Rule:
    return Rule(name, category, description, PREDICATE, (column,), failure, never_null=True)


def not_null(name: str, column: str, description: str, category: str = "completeness") -> Rule:
    return _guarded(name, column, P.missing(column), description, category)


def positive(name: str, column: str, description: str, category: str = "value_range") -> Rule:
    return _guarded(name, column, P.not_positive(column), description, category)


def in_set(
    name: str,
    column: str,
    values: Sequence[str],
    description: str,
    category: str = "value_range",
) -> Rule:
    """Case-insensitive membership; nulls are left to a ``not_null`` rule."""
    return _guarded(name, column, P.outside(column, values), description, category)


def exists_in(
    name: str,
    column: str,
    reference: str,
    reference_key: str,
    description: str,
    category: str = "referential_integrity",
) -> Rule:
    return Rule(
        name, category, description, EXISTS_IN, (column,), reference=(reference, reference_key)
    )


def predicate(
    name: str,
    failure: str,
    description: str,
    category: str,
    columns: Sequence[str] = (),
) -> Rule:
    """A rule from any SQL predicate that is true for an offending row."""
    return Rule(name, category, description, PREDICATE, tuple(columns), failure)


def unique(name: str, column: str, description: str, category: str = "uniqueness") -> Rule:
    return Rule(name, category, description, UNIQUE, (column,))


def fresh(
    name: str, column: str, max_age_days: int, description: str, category: str = "freshness"
) -> Rule:
    return Rule(name, category, description, FRESH, (column,), max_age_days=max_age_days)


def columns_match(
    name: str, expected: Sequence[str], description: str, category: str = "schema_drift"
) -> Rule:
    return Rule(name, category, description, COLUMNS, expected_columns=tuple(expected))


def trade_rules(freshness_days: int = 400) -> list[Rule]:
    """The rules of the trade table, in declaration order.

    Names, categories and order are fixed values: reports and quarantine
    records made from them must stay comparable.
    """
    return [
        unique(
            "trade_id_unique",
            "trade_id",
            "Each trade_id is one execution, so the load must have merged re-sent rows.",
        ),
        not_null(
            "instrument_id_present",
            "instrument_id",
            "Every trade names the instrument it belongs to.",
        ),
        not_null("price_present", "price", "Every trade has a price to value it with."),
        not_null(
            "quantity_present",
            "quantity",
            "Every trade has a quantity; a gap would understate the position.",
        ),
        not_null(
            "executed_at_present",
            "executed_at",
            "Every trade has an execution time that places it on a day.",
        ),
        positive(
            "quantity_positive",
            "quantity",
            "Quantity is above zero, because side alone carries the direction.",
        ),
        positive("price_positive", "price", "Price is above zero."),
        not_null("side_present", "side", "Every trade says whether it bought or sold."),
        in_set(
            "side_recognised",
            "side",
            ("BUY", "SELL"),
            "Side is one of the agreed values, in any letter case.",
        ),
        exists_in(
            "instrument_exists",
            "instrument_id",
            "instrument",
            "instrument_id",
            "The instrument is known to the reference data.",
        ),
        fresh(
            "feed_is_fresh",
            "executed_at",
            freshness_days,
            f"The newest trade is between 0 and {freshness_days} days old.",
        ),
        columns_match(
            "schema_unchanged",
            TRADE_COLUMNS,
            "The table has the expected columns and no others.",
        ),
    ]


# Beside the twelve: for feeds in which ids can be missing.
KEY_PRESENT = not_null("trade_id_present", "trade_id", "Every trade has an id.")


def row_rules(rules: Iterable[Rule]) -> list[Rule]:
    """The rules whose offenders can be quarantined."""
    return [r for r in rules if r.quarantinable]


def table_rules(rules: Iterable[Rule]) -> list[Rule]:
    return [r for r in rules if not r.quarantinable]


def readable(rule: Rule, columns: Iterable[str]) -> bool:
    """Whether the input has every column the rule reads."""
    return set(rule.columns) <= set(columns)


def schema_drift(actual: Iterable[str], expected: Iterable[str] = TRADE_COLUMNS) -> dict:
    """Columns added to and missing from the expected set; order is ignored."""
    have, want = list(actual), list(expected)
    return {
        "added": sorted(set(have) - set(want)),
        "missing": sorted(set(want) - set(have)),
    }

from feedsieve.rules import row_rules, schema_drift, table_rules, trade_rules

EXPECTED = [
    ("trade_id_unique", "uniqueness", "table"),
    ("instrument_id_present", "completeness", "row"),
    ("price_present", "completeness", "row"),
    ("quantity_present", "completeness", "row"),
    ("executed_at_present", "completeness", "row"),
    ("quantity_positive", "value_range", "row"),
    ("price_positive", "value_range", "row"),
    ("side_present", "completeness", "row"),
    ("side_recognised", "value_range", "row"),
    ("instrument_exists", "referential_integrity", "row"),
    ("feed_is_fresh", "freshness", "table"),
    ("schema_unchanged", "schema_drift", "table"),
]


def test_catalogue_names_categories_and_order():
    assert [(r.name, r.category, r.scope) for r in trade_rules()] == EXPECTED
    assert all(r.description for r in trade_rules())


def test_freshness_limit_is_a_parameter():
    limits = [r.max_age_days for r in trade_rules(freshness_days=2) if r.kind == "fresh"]
    assert limits == [2]
    assert [r.max_age_days for r in trade_rules() if r.kind == "fresh"] == [400]


def test_only_row_rules_can_be_quarantined():
    assert {r.name for r in table_rules(trade_rules())} == {
        "trade_id_unique",
        "feed_is_fresh",
        "schema_unchanged",
    }
    assert all(r.quarantinable for r in row_rules(trade_rules()))


def test_drift_ignores_order():
    assert schema_drift(["b", "a"], ["a", "b"]) == {"added": [], "missing": []}
    assert schema_drift(["a", "c"], ["a", "b"]) == {"added": ["c"], "missing": ["b"]}

"""DuckDB statements giving the expected result of every named query.

Written from the rule definitions by hand, not generated from the package, so
that the two check each other.
"""

from __future__ import annotations

_AS_OF = "DATE '2001-12-01'"
_STALE_AS_OF = "DATE '2004-01-01'"
_SPLIT = "TIMESTAMP '1999-01-01 00:00:00'"

_ROW_RULES = {
    "instrument_id_present": "instrument_id IS NULL",
    "price_present": "price IS NULL",
    "quantity_present": "quantity IS NULL",
    "executed_at_present": "executed_at IS NULL",
    "quantity_positive": "coalesce(quantity <= 0, false)",
    "price_positive": "coalesce(price <= 0, false)",
    "side_present": "side IS NULL",
    "side_recognised": "coalesce(upper(side) NOT IN ('BUY', 'SELL'), false)",
    "instrument_exists": (
        "(instrument_id IS NOT NULL AND instrument_id NOT IN (SELECT k FROM known))"
    ),
}
_RULE_COLUMN = {
    "instrument_id_present": "instrument_id",
    "price_present": "price",
    "quantity_present": "quantity",
    "executed_at_present": "executed_at",
    "quantity_positive": "quantity",
    "price_positive": "price",
    "side_present": "side",
    "side_recognised": "side",
    "instrument_exists": "instrument_id",
}
_CATEGORY = {
    "trade_id_unique": "uniqueness",
    "instrument_id_present": "completeness",
    "price_present": "completeness",
    "quantity_present": "completeness",
    "executed_at_present": "completeness",
    "quantity_positive": "value_range",
    "price_positive": "value_range",
    "side_present": "completeness",
    "side_recognised": "value_range",
    "instrument_exists": "referential_integrity",
    "feed_is_fresh": "freshness",
    "schema_unchanged": "schema_drift",
}
_ORDER = list(_CATEGORY)
_DESCRIPTION = {
    "trade_id_unique": "Each trade_id is one execution, so the load must have merged re-sent rows.",
    "instrument_id_present": "Every trade names the instrument it belongs to.",
    "price_present": "Every trade has a price to value it with.",
    "quantity_present": "Every trade has a quantity; a gap would understate the position.",
    "executed_at_present": "Every trade has an execution time that places it on a day.",
    "quantity_positive": "Quantity is above zero, because side alone carries the direction.",
    "price_positive": "Price is above zero.",
    "side_present": "Every trade says whether it bought or sold.",
    "side_recognised": "Side is one of the agreed values, in any letter case.",
    "instrument_exists": "The instrument is known to the reference data.",
    "feed_is_fresh": "The newest trade is between 0 and 400 days old.",
    "schema_unchanged": "The table has the expected columns and no others.",
}
_TRADE_COLUMNS = (
    "trade_id",
    "instrument_id",
    "side",
    "quantity",
    "price",
    "executed_at",
    "source_file",
    "ingested_at",
)
_TABLE_RULES = ("trade_id_unique", "feed_is_fresh", "schema_unchanged")
_RESEND = (
    "executed_at DESC NULLS LAST, instrument_id DESC NULLS LAST, side DESC NULLS LAST, "
    "quantity DESC NULLS LAST, price DESC NULLS LAST, source_file DESC NULLS LAST, "
    "ingested_at DESC NULLS LAST"
)


def _latest(source: str, where: str = "true") -> str:
    return (
        f"SELECT {', '.join(_TRADE_COLUMNS)} FROM (SELECT *, row_number() OVER ("
        f"PARTITION BY trade_id ORDER BY {_RESEND}) AS rn FROM {source} WHERE {where}) WHERE rn = 1"
    )


def _flagged(source: str, extra: str = "") -> str:
    flags = ", ".join(f"{p} AS f_{n}" for n, p in _ROW_RULES.items())
    return f"SELECT *{extra}, {flags} FROM {source}"


_REASONS = (
    "concat_ws(','," + ", ".join(f"CASE WHEN f_{n} THEN '{n}' END" for n in _ROW_RULES) + ")"
)
_REASONS_BUT_ORPHAN = (
    "concat_ws(',',"
    + ", ".join(f"CASE WHEN f_{n} THEN '{n}' END" for n in _ROW_RULES if n != "instrument_exists")
    + ")"
)
_PACED_MARKS = (
    "SELECT source_file, max(executed_at) AS mark FROM landed WHERE ingested_at < CASE WHEN source_file = 'feed_F' "
    f"THEN TIMESTAMP '1997-01-01 00:00:00' ELSE {_SPLIT} END GROUP BY source_file"
)
_BROKEN = "(" + " OR ".join(f"f_{n}" for n in _ROW_RULES) + ")"

_BASE = f"""
WITH hashed AS (
  SELECT *, l_orderkey * 7 + l_partkey * 13 + l_suppkey * 31 + l_linenumber AS h FROM lineitem
),
feed AS (
  SELECT 'T' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS trade_id,
    CASE WHEN h % 997 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS instrument_id,
    CASE WHEN h % 211 = 0 THEN '' WHEN h % 223 = 0 THEN 'X' WHEN h % 227 = 0 THEN 'buy'
         WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
    CASE WHEN h % 101 = 0 THEN '' WHEN h % 103 = 0 THEN CAST(-l_quantity AS VARCHAR)
         ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
    CASE WHEN h % 109 = 0 THEN '' WHEN h % 113 = 0 THEN '-1'
         ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
    CASE WHEN h % 127 = 0 THEN '' ELSE CAST(l_shipdate AS VARCHAR) END AS executed_at,
    'feed_' || l_linestatus AS source_file,
    l_shipdate + INTERVAL 1 DAY AS ingested_at
  FROM hashed
),
landed AS MATERIALIZED (
  SELECT nullif(trade_id, '') AS trade_id,
    TRY_CAST(nullif(instrument_id, '') AS INTEGER) AS instrument_id,
    nullif(side, '') AS side,
    TRY_CAST(nullif(quantity, '') AS DECIMAL(18,4)) AS quantity,
    TRY_CAST(nullif(price, '') AS DECIMAL(18,6)) AS price,
    TRY_CAST(nullif(executed_at, '') AS TIMESTAMP) AS executed_at,
    source_file, ingested_at
  FROM feed
),
instrument AS (
  SELECT TRY_CAST(p_partkey AS INTEGER) AS instrument_id, p_name AS symbol, p_type AS asset_class,
    'USD' AS currency
  FROM part WHERE p_partkey % 97 <> 5
),
known AS MATERIALIZED (SELECT DISTINCT instrument_id AS k FROM instrument WHERE instrument_id IS NOT NULL),
trade AS MATERIALIZED ({_latest("landed")}),
flagged AS ({_flagged("landed")}),
stored AS ({_flagged("trade")}),
valid AS (SELECT {", ".join(_TRADE_COLUMNS)} FROM stored WHERE NOT {_BROKEN}),
flagged_valid AS (SELECT * FROM stored WHERE NOT {_BROKEN}),
first_batch AS MATERIALIZED ({_latest("landed", f"ingested_at < {_SPLIT}")}),
second_batch AS MATERIALIZED ({_latest("landed", f"ingested_at >= {_SPLIT}")}),
loaded AS MATERIALIZED (
  SELECT * FROM first_batch WHERE trade_id NOT IN (SELECT trade_id FROM second_batch)
  UNION ALL SELECT * FROM second_batch
),
flagged_first AS ({_flagged("first_batch")}),
flagged_second AS ({_flagged("second_batch")}),
yearly AS (
  SELECT *, 'run-' || CAST(year(ingested_at) AS VARCHAR) AS run_id FROM flagged
)
"""


def _report(
    source: str = "flagged", as_of: str = _AS_OF, rules: list[str] | None = None, by: str = ""
) -> str:
    """Long report: position, rule, failing, observed, success, rows_checked."""
    group = f"GROUP BY {by}" if by else ""
    tag = f"{by}, " if by else ""
    key = "trade_id"
    parts = []
    for name in rules or _ORDER:
        position = _ORDER.index(name)
        if name in _ROW_RULES:
            failing = f"count(*) FILTER (WHERE f_{name})"
            body = f"SELECT {tag}count(*) AS rows_checked, {failing} AS failing FROM {source} {group}"
        elif name == "trade_id_unique":
            body = (
                f"SELECT {tag}CAST(sum(n) AS BIGINT) AS rows_checked, "
                f"CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failing FROM "
                f"(SELECT {tag}{key}, count(*) AS n FROM {source} GROUP BY {tag}{key}) {group}"
            )
        elif name == "feed_is_fresh":
            age = f"coalesce(date_diff('day', CAST(max(executed_at) AS DATE), {as_of}), 99999)"
            body = (
                f"SELECT {tag}count(*) AS rows_checked, CAST(CASE WHEN {age} BETWEEN 0 AND 400 "
                f"THEN 0 ELSE 1 END AS BIGINT) AS failing FROM {source} {group}"
            )
        else:
            body = (
                f"SELECT {tag}count(*) AS rows_checked, CAST(0 AS BIGINT) AS failing "
                f"FROM {source} {group}"
            )
        observed = "CAST(failing AS VARCHAR)"
        if name == "schema_unchanged":
            observed = "'[" + ", ".join(f'"{c}"' for c in _TRADE_COLUMNS) + "]'"
        scope = "table" if name in _TABLE_RULES else "row"
        parts.append(
            f"SELECT {tag}{position} AS position, '{name}' AS rule, '{_CATEGORY[name]}' AS category, "
            f"'{scope}' AS scope, failing = 0 AS success, failing AS failing_rows, "
            f"{observed} AS observed, rows_checked FROM ({body})"
        )
    return " UNION ALL ".join(parts)


def _verdict(report: str, by: str = "") -> str:
    tag, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return (
        f"SELECT {tag}bool_and(success) AS success, max(rows_checked) AS rows_checked, "
        "CAST(count(*) AS INTEGER) AS rules_total, "
        "CAST(count(*) FILTER (WHERE NOT success) AS INTEGER) AS rules_failed, "
        "coalesce(string_agg(rule, ',' ORDER BY rule) FILTER (WHERE NOT success), '') "
        f"AS failed_rules FROM ({report}) {group}"
    )


def _counts(source: str, rules: dict[str, str] | None = None, tag: str = "") -> str:
    """Long reason counts of flagged rows, reasons that occur only."""
    group = f"GROUP BY {tag[:-2]}" if tag else ""
    parts = [
        f"SELECT {tag}'{n}' AS reason, count(*) AS n FROM {source} WHERE {p} {group}"
        for n, p in (rules or {n: f"f_{n}" for n in _ROW_RULES}).items()
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n > 0"


def _quarantine(source: str, run: str, time: str) -> str:
    return (
        "SELECT trade_id, instrument_id, side, quantity, price, executed_at, source_file, "
        f"{_REASONS} AS reasons, '{run}' AS run_id, TIMESTAMP '{time}' AS rejected_at "
        f"FROM ({_flagged(source)}) WHERE {_BROKEN}"
    )


_LACKING = "(CAST(substr(trade_id, 2) AS BIGINT) % 101 = 0)"
_FIRST = ("run-a", "2001-11-30 06:00:00")
_SECOND = ("run-b", "2001-12-01 06:00:00")

_YEAR_AS_OF = "max(CAST(substr(run_id, 5, 4) || '-12-31' AS DATE))"
_YEAR_REPORT = _report("yearly", _YEAR_AS_OF, by="run_id")
_RUNS = f"""
SELECT v.run_id, t.started_at, t.started_at + INTERVAL 10 MINUTE AS finished_at,
  CASE WHEN success THEN 'passed' ELSE 'failed' END AS status, v.rows_checked,
  coalesce(q.n, 0) AS rows_rejected, v.rules_total, v.rules_failed
FROM ({_verdict(_YEAR_REPORT, "run_id")}) v
JOIN (SELECT DISTINCT run_id, make_timestamp(CAST(substr(run_id, 5, 4) AS BIGINT) + 1, 1, 2, 6, 0, 0)
      AS started_at FROM yearly) t ON t.run_id = v.run_id
LEFT JOIN (SELECT run_id, count(*) AS n FROM yearly WHERE {_BROKEN} GROUP BY run_id) q
  ON q.run_id = v.run_id
"""
_RECENT = (
    "SELECT run_id, status, rows_checked, rows_rejected, rules_failed, started_at "
    f"FROM ({_RUNS}) ORDER BY started_at DESC, run_id DESC LIMIT 10"
)

_FLOWS = """
  count(*) AS trades,
  CAST(coalesce(sum(quantity) FILTER (WHERE upper(side) = 'BUY'), 0) AS DECIMAL(28,4)) AS buy_qty,
  CAST(coalesce(sum(quantity) FILTER (WHERE upper(side) = 'SELL'), 0) AS DECIMAL(28,4)) AS sell_qty,
  CAST(coalesce(sum(quantity * price), 0) AS DECIMAL(38,10)) AS gross_notional,
  CAST(coalesce(sum(CASE WHEN upper(side) = 'BUY' THEN -(quantity * price)
    ELSE quantity * price END), 0) AS DECIMAL(38,10)) AS net_cash
"""
_DAILY = f"""
SELECT d.trade_date, d.instrument_id, trades, buy_qty, sell_qty,
  CAST(buy_qty - sell_qty AS DECIMAL(28,4)) AS net_qty, gross_notional, net_cash, close_price,
  CAST(CAST(CAST(buy_qty - sell_qty AS DECIMAL(18,4)) * close_price AS DECIMAL(37,10))
    + CAST(net_cash AS DECIMAL(37,10)) AS DECIMAL(38,10)) AS pnl
FROM (SELECT CAST(executed_at AS DATE) AS trade_date, instrument_id, {_FLOWS}
      FROM valid GROUP BY 1, 2) d
JOIN (SELECT CAST(executed_at AS DATE) AS trade_date, instrument_id, price AS close_price,
        row_number() OVER (PARTITION BY CAST(executed_at AS DATE), instrument_id
          ORDER BY executed_at DESC, trade_id DESC) AS rn FROM valid) c
  ON c.trade_date = d.trade_date AND c.instrument_id = d.instrument_id AND rn = 1
"""
_VALID_FLOWS = (
    f"count(*) FILTER (WHERE NOT {_BROKEN}) AS trades, "
    f"CAST(coalesce(sum(quantity * price) FILTER (WHERE NOT {_BROKEN}), 0) AS DECIMAL(38,10)) "
    "AS gross_notional"
)
_PARTITIONS = (
    "SELECT CAST(executed_at AS DATE) AS trade_date, count(*) AS rows_checked, "
    + ", ".join(f"count(*) FILTER (WHERE f_{n}) AS n_{n}" for n in _ROW_RULES)
    + ", max(executed_at) AS newest_feed_is_fresh FROM flagged GROUP BY 1"
)
_LINE = (
    "format('{:s}  {:<7s} checked={:<7d} rejected={:<5d} rules_failed={:d}', "
    "run_id, status, rows_checked, rows_rejected, rules_failed)"
)


def _positions(daily: str) -> str:
    return f"""
SELECT *, CAST(market_value + CAST(cash AS DECIMAL(37,10)) AS DECIMAL(38,10)) AS total_pnl
FROM (SELECT *,
    CAST(CAST(position AS DECIMAL(18,4)) * close_price AS DECIMAL(37,10)) AS market_value
  FROM (SELECT trade_date, instrument_id, close_price,
      CAST(sum(net_qty) OVER w AS DECIMAL(28,4)) AS position,
      CAST(sum(net_cash) OVER w AS DECIMAL(38,10)) AS cash,
      lag(close_price) OVER (PARTITION BY instrument_id ORDER BY trade_date) AS previous_close
    FROM ({daily})
    WINDOW w AS (PARTITION BY instrument_id ORDER BY trade_date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


def _drifted() -> str:
    """Report of a table whose price is renamed and whose trade_id is gone."""
    columns = [{"price": "px"}.get(c, c) for c in _TRADE_COLUMNS if c != "trade_id"]
    listed = "[" + ", ".join(f'"{c}"' for c in columns) + "]"
    return f"""
SELECT position, rule, category, scope,
  CASE WHEN rule IN ('price_present', 'price_positive', 'trade_id_unique', 'schema_unchanged')
    THEN false ELSE success END AS success,
  CASE WHEN rule IN ('price_present', 'price_positive', 'trade_id_unique') THEN NULL
    WHEN rule = 'schema_unchanged' THEN 3 ELSE failing_rows END AS failing_rows,
  CASE WHEN rule IN ('price_present', 'price_positive', 'trade_id_unique') THEN NULL
    WHEN rule = 'schema_unchanged' THEN '{listed}' ELSE observed END AS observed,
  rows_checked
FROM ({_report()})"""


def _catalog() -> str:
    texts = " ".join(f"WHEN '{name}' THEN '{text}'" for name, text in _DESCRIPTION.items())
    return (
        f"SELECT position, rule, category, scope, CASE rule {texts} END AS description, "
        f"failing_rows FROM ({_report()})"
    )


def _freshness(as_of: str) -> str:
    age = f"coalesce(date_diff('day', CAST(newest AS DATE), {as_of}), 99999)"
    return (
        f"SELECT newest, CAST({age} AS INTEGER) AS days_since_latest, {age} BETWEEN 0 AND 400 "
        "AS success FROM (SELECT max(executed_at) AS newest FROM landed)"
    )


def _drift() -> str:
    parts = []
    for name in _TRADE_COLUMNS:
        filled = "0" if name == "source_file" else f"count({name})"
        status = "missing" if name == "source_file" else "expected"
        parts.append((name, status, filled))
    parts.append(("origin", "added", "count(source_file)"))
    parts.append(("venue", "added", "count(*) FILTER (WHERE side = 'SELL')"))
    return " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, '{s}' AS status, CAST({f} AS BIGINT) AS rows_filled, "
        "count(*) AS rows_checked FROM landed"
        for n, s, f in parts
    )


def oracle_sql() -> dict[str, str]:
    trade_columns = ", ".join(_TRADE_COLUMNS)
    custom = {n: f"f_{n}" for n in _ROW_RULES}
    custom["notional_bounded"] = "coalesce(quantity * price > 2000000, false)"
    custom["instrument_positive"] = "coalesce(instrument_id <= 0, false)"
    unscoped = [n for n in _ORDER if n != "trade_id_unique"]
    statements = {
        "typed_feed": "SELECT * FROM landed",
        "collapse_retries": "SELECT * FROM trade",
        "incremental_load": (
            "SELECT * FROM landed WHERE executed_at IS NULL OR executed_at >= "
            f"(SELECT max(executed_at) FROM landed WHERE ingested_at < {_SPLIT})"
        ),
        "collapse_many_retries": "SELECT * FROM trade",
        "incremental_load_by_source": (
            f"SELECT l.* FROM landed l LEFT JOIN ({_PACED_MARKS}) m "
            "ON m.source_file IS NOT DISTINCT FROM l.source_file "
            "WHERE executed_at IS NULL OR mark IS NULL OR executed_at >= mark"
        ),
        "late_by_source": (
            "SELECT l.source_file, count(*) AS late_rows, min(executed_at) AS oldest, max(mark) AS high_watermark "
            f"FROM landed l JOIN ({_PACED_MARKS}) m ON m.source_file = l.source_file "
            "WHERE executed_at < mark GROUP BY l.source_file"
        ),
        "loaded_as_of": (
            f"SELECT {trade_columns}, 1 AS version FROM first_batch "
            f"UNION ALL SELECT {trade_columns}, 2 AS version FROM loaded"
        ),
        "indexed_duplicates": (
            "SELECT trade_id, count(*) AS n FROM landed GROUP BY trade_id HAVING count(*) > 1 "
            f"AND count(*) FILTER (WHERE ingested_at >= {_SPLIT}) > 0"
        ),
        "late_rows": (
            "SELECT source_file, count(*) AS late_rows, min(executed_at) AS oldest FROM landed "
            f"WHERE executed_at < (SELECT max(executed_at) FROM landed WHERE ingested_at < {_SPLIT}) "
            "GROUP BY source_file"
        ),
        "load_balance": (
            "SELECT count(*) AS rows_in, count(DISTINCT id) AS rows_upserted, "
            "count(id) - count(DISTINCT id) AS rows_superseded, "
            "count(*) - count(id) AS rows_unkeyed, count(DISTINCT CASE WHEN id NOT IN "
            "(SELECT trade_id FROM first_batch) THEN id END) AS rows_new "
            f"FROM (SELECT CASE WHEN NOT {_LACKING} THEN trade_id END AS id FROM landed "
            f"WHERE ingested_at >= {_SPLIT})"
        ),
        "unkeyed_rejected": (
            "SELECT DISTINCT CAST(NULL AS VARCHAR) AS trade_id, instrument_id, side, quantity, price, "
            f"executed_at, source_file, concat_ws(',', nullif({_REASONS}, ''), 'trade_id_present') "
            f"AS reasons, '{_FIRST[0]}' AS run_id, TIMESTAMP '{_FIRST[1]}' AS rejected_at "
            f"FROM flagged WHERE {_LACKING}"
        ),
        "trade_upsert": "SELECT * FROM loaded",
        "feed_watermark": (
            "SELECT source_file, max(executed_at) AS high_watermark FROM landed "
            "GROUP BY source_file"
        ),
        "rule_report": _report(),
        "rule_report_loaded": _report("stored", _STALE_AS_OF),
        "rule_report_drifted": _drifted(),
        "rule_report_clashing": (
            "SELECT position, rule, category, scope, success AND rule <> 'schema_unchanged' AS success, "
            "CASE WHEN rule = 'schema_unchanged' THEN 3 ELSE failing_rows END AS failing_rows, "
            f"rows_checked FROM ({_report()})"
        ),
        "rule_catalog": _catalog(),
        "rule_labels": (
            "SELECT trade_id, instrument_id, side, quantity, price, executed_at, "
            f"{_REASONS} AS reasons FROM flagged"
        ),
        "rule_trade_id_unique": (
            "SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, "
            "count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(0 AS BIGINT) AS null_keys, "
            "CAST(sum(n) AS BIGINT) AS rows_checked "
            "FROM (SELECT trade_id, count(*) AS n FROM landed GROUP BY trade_id)"
        ),
        "duplicate_keys": (
            "SELECT trade_id, count(*) AS n FROM landed GROUP BY trade_id HAVING count(*) > 1"
        ),
        "custom_rules": _counts("flagged", custom),
        "feed_freshness": _freshness(_AS_OF),
        "feed_freshness_stale": _freshness(_STALE_AS_OF),
        "schema_drift": _drift(),
        "validation_verdict": _verdict(_report()),
        "category_report": (
            "SELECT category, count(*) AS rules, count(*) FILTER (WHERE NOT success) AS "
            "rules_failed, CAST(sum(failing_rows) AS BIGINT) AS failing_rows, "
            f"bool_and(success) AS success FROM ({_report()}) GROUP BY category"
        ),
        "rule_agreement": (
            "SELECT r.rule, r.failing_rows AS reported, coalesce(c.n, 0) AS quarantined, "
            "r.failing_rows = coalesce(c.n, 0) AS agree "
            f"FROM ({_report(rules=list(_ROW_RULES))}) r "
            f"LEFT JOIN ({_counts('flagged')}) c ON c.reason = r.rule"
        ),
        "quarantine_rows": _quarantine("trade", *_FIRST),
        "quarantine_upsert": (
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trade_id "
            f"ORDER BY run_id DESC) AS rn FROM ({_quarantine('first_batch', *_FIRST)} "
            f"UNION ALL {_quarantine('loaded', *_SECOND)})) WHERE rn = 1"
        ),
        "current_rejected_compacted": (
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trade_id "
            f"ORDER BY rejected_at DESC) AS rn FROM ({_quarantine('first_batch', *_FIRST)} "
            f"UNION ALL {_quarantine('second_batch', *_SECOND)})) WHERE rn = 1"
        ),
        "orphans_resolved": (
            "SELECT trade_id, instrument_id, side, quantity, price, executed_at, source_file, "
            f"{_REASONS_BUT_ORPHAN} AS reasons, '{_SECOND[0]}' AS run_id, TIMESTAMP '{_SECOND[1]}' AS rejected_at, "
            f"{_REASONS_BUT_ORPHAN} = '' AS resolved FROM stored WHERE f_instrument_exists AND instrument_id IN "
            "(SELECT p_partkey FROM part WHERE p_partkey % 97 = 5 AND p_partkey % 2 = 1)"
        ),
        "current_rejected": (
            f"SELECT * FROM ({_quarantine('first_batch', *_FIRST)}) a WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({_quarantine('second_batch', *_SECOND)}) b WHERE b.trade_id = a.trade_id) "
            f"UNION ALL {_quarantine('second_batch', *_SECOND)}"
        ),
        "valid_trades": f"SELECT {trade_columns} FROM valid",
        "batch_split": (
            f"SELECT count(*) AS rows_total, count(*) FILTER (WHERE NOT {_BROKEN}) AS rows_valid, "
            f"count(*) FILTER (WHERE {_BROKEN}) AS rows_rejected FROM stored"
        ),
        "orphan_trades": "SELECT trade_id, instrument_id FROM flagged WHERE f_instrument_exists",
        "orphan_keys": (
            "SELECT instrument_id, count(*) AS n FROM flagged WHERE f_instrument_exists "
            "GROUP BY instrument_id"
        ),
        "orphan_row_count": (
            "SELECT count(*) AS observed, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS success "
            "FROM flagged WHERE f_instrument_exists"
        ),
        "reason_counts": _counts("stored"),
        "rows_rejected": (
            f"SELECT run_id, count(*) AS rows_rejected FROM yearly WHERE {_BROKEN} GROUP BY run_id"
        ),
        "worst_reason": (
            f"SELECT reason, n FROM ({_counts('stored')}) ORDER BY n DESC, reason LIMIT 1"
        ),
        "quality_routes": f"""
SELECT m.name || '-' || r.route AS run_id, CASE WHEN v.success THEN 'passed' ELSE 'failed' END AS status,
  v.rows_checked, CASE WHEN r.route = 'never' OR (r.route = 'on_failure' AND v.success) THEN 0 ELSE m.n END
    AS rows_rejected, v.rules_total, v.rules_failed,
  CASE WHEN r.route = 'never' OR (r.route = 'on_failure' AND v.success) THEN 0 ELSE m.n END AS rows_stored
FROM (SELECT 'sound' AS name, CAST(0 AS BIGINT) AS n UNION ALL
      SELECT 'unsound', count(*) FROM stored WHERE {_BROKEN}) m
JOIN (SELECT 'sound' AS name, * FROM ({_verdict(_report("flagged_valid"))}) UNION ALL
      SELECT 'unsound', * FROM ({_verdict(_report("stored"))})) v ON v.name = m.name,
  (SELECT unnest(['always', 'on_failure', 'never']) AS route) r""",
        "rule_results": f"""
SELECT b.run_id, b.rule, b.category, b.scope, b.success, b.failing_rows, b.observed, b.rows_checked,
  CASE WHEN b.success THEN NULL WHEN b.run_id = 'run-a' OR a.success THEN b.run_id ELSE 'run-a' END AS failing_since
FROM (SELECT 'run-a' AS run_id, * FROM ({_report("flagged_first")}) UNION ALL
      SELECT 'run-b', * FROM ({_report("flagged_second")})) b
JOIN ({_report("flagged_first")}) a ON a.rule = b.rule""",
        "owned_tables": f"""
SELECT 'rejected_trades' AS table_name, count(*) AS after_run, count(*) AS after_ensure, CAST(0 AS BIGINT) AS after_reset
FROM flagged WHERE {_BROKEN}
UNION ALL SELECT 'validation_run', 1, 1, 0
UNION ALL SELECT 'etl_watermark', count(DISTINCT source_file), count(DISTINCT source_file), 0 FROM landed""",
        "run_start": f"""
SELECT run_id, started_at,
  CASE WHEN started_at < {_SPLIT} THEN finished_at END AS finished_at,
  CASE WHEN started_at < {_SPLIT} THEN status ELSE 'running' END AS status,
  CASE WHEN started_at < {_SPLIT} THEN rows_checked ELSE 0 END AS rows_checked,
  CASE WHEN started_at < {_SPLIT} THEN rows_rejected ELSE 0 END AS rows_rejected,
  CASE WHEN started_at < {_SPLIT} THEN rules_total ELSE 0 END AS rules_total,
  CASE WHEN started_at < {_SPLIT} THEN rules_failed ELSE 0 END AS rules_failed
FROM (SELECT * REPLACE (CASE WHEN started_at + INTERVAL 10 MINUTE < {_SPLIT}
  THEN started_at + INTERVAL 10 MINUTE ELSE started_at END AS started_at) FROM ({_RUNS}))""",
        "run_history": _RECENT,
        "history_lines": f"SELECT {_LINE} AS line FROM ({_RECENT})",
        "rejection_trend": f"""
SELECT run_id, started_at, rows_checked, rows_rejected, rate,
  rate - lag(rate) OVER (ORDER BY started_at, run_id) AS change
FROM (SELECT *, CAST(rows_rejected AS DOUBLE) / CAST(rows_checked AS DOUBLE) AS rate
  FROM ({_RUNS}))""",
        "rejection_alarm": f"""
SELECT run_id, started_at, ppm, expected_ppm, cusum_ppm, cusum_ppm > 1000 AS alarm FROM (
  WITH RECURSIVE rated AS (
    SELECT *, row_number() OVER (ORDER BY started_at, run_id) AS n,
      CAST(rows_rejected * 1000000 // rows_checked AS BIGINT) AS ppm
    FROM ({_RUNS}) WHERE rows_checked > 0),
  expected AS (SELECT CAST(sum(ppm) // count(*) AS BIGINT) AS e FROM rated WHERE n <= 3),
  walked(n, s) AS (
    SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    UNION ALL
    SELECT r.n, CAST(greatest(0, w.s + r.ppm - e - 100) AS BIGINT)
    FROM walked w JOIN rated r ON r.n = w.n + 1, expected)
  SELECT run_id, started_at, ppm, e AS expected_ppm, s AS cusum_ppm
  FROM rated JOIN walked USING (n), expected)""",
        "run_details": """
SELECT run_id,
  CASE WHEN count(*) FILTER (WHERE f_price_present) = 0 THEN 'true' ELSE 'false' END
    AS price_success,
  'completeness' AS price_category,
  count(*) FILTER (WHERE f_price_present) AS price_observed,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM yearly i
    WHERE i.run_id = y.run_id GROUP BY trade_id HAVING count(*) > 1)) AS unique_observed,
  'ingested_at' AS last_column,
  nullif(count(*) FILTER (WHERE f_price_present), 0) AS price_rejected,
  nullif(count(*) FILTER (WHERE f_instrument_exists), 0) AS orphans_rejected
FROM yearly y GROUP BY run_id""",
        "run_summary": f"""
SELECT v.run_id,
  CASE WHEN v.success THEN format('all {{:d}} rules passed over {{:d}} rows', rules_total,
      rows_checked)
    ELSE format('{{:d}} of {{:d}} rules failed over {{:d}} rows: {{:s}}', rules_failed,
      rules_total, rows_checked, replace(failed_rules, ',', ', ')) END AS outcome,
  format('quarantined {{:d}} rows ({{:s}})', q.n, q.listed) AS quarantine
FROM ({_verdict(_YEAR_REPORT, "run_id")}) v
JOIN (SELECT r.run_id, any_value(r.total) AS n, string_agg(c.reason || '=' || CAST(c.n AS VARCHAR),
        ', ' ORDER BY c.reason) AS listed
      FROM (SELECT run_id, count(*) AS total FROM yearly WHERE {_BROKEN} GROUP BY run_id) r
      JOIN ({_counts("yearly", tag="run_id, ")}) c ON c.run_id = r.run_id GROUP BY r.run_id) q
  ON q.run_id = v.run_id""",
        "daily_pnl": _DAILY,
        "daily_refresh": _DAILY.replace(
            "FROM valid", f"FROM (SELECT * FROM ({_flagged('loaded')}) WHERE NOT {_BROKEN})"
        ),
        "daily_pnl_by_asset_class": f"""
SELECT trade_date, asset_class, trades, buy_qty, sell_qty, gross_notional, net_cash,
  CAST(buy_qty - sell_qty AS DECIMAL(28,4)) AS net_qty
FROM (SELECT CAST(executed_at AS DATE) AS trade_date, asset_class, {_FLOWS}
  FROM valid JOIN (SELECT instrument_id AS k, min(asset_class) AS asset_class FROM instrument
    GROUP BY 1) i ON i.k = valid.instrument_id GROUP BY 1, 2)""",
        "daily_position": _positions(_DAILY),
        "position_refresh": _positions(
            _DAILY.replace("FROM valid", f"FROM (SELECT * FROM ({_flagged('loaded')}) WHERE NOT {_BROKEN})")
        ),
        "position_marked_daily": f"""
SELECT CAST(stamp AS DATE) AS day, count(*) AS instruments,
  count(*) FILTER (WHERE CAST(stamp AS DATE) > trade_date) AS marked_at_older_close,
  CAST(sum(market_value) AS DECIMAL(38,10)) AS market_value,
  CAST(max(CAST(stamp AS DATE) - trade_date) AS INTEGER) AS oldest_close_days
FROM (SELECT *, unnest(generate_series(CAST(trade_date AS TIMESTAMP),
    CAST(coalesce(next_date - 1, trade_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS stamp
  FROM (SELECT *, lead(trade_date) OVER (PARTITION BY instrument_id ORDER BY trade_date) AS next_date
    FROM ({_positions(_DAILY)})))
GROUP BY 1""",
        "stored_freshness": _freshness(_AS_OF).replace(
            "SELECT newest,", "SELECT newest, (SELECT count(*) FROM landed) AS rows_checked,"
        ),
        "coverage_gap": f"""
SELECT d.trade_date, d.instrument_id, trades, gross_notional, rows_rejected, reason,
  n AS reason_rows
FROM (SELECT CAST(executed_at AS DATE) AS trade_date, instrument_id, {_VALID_FLOWS},
    count(*) FILTER (WHERE {_BROKEN}) AS rows_rejected FROM stored GROUP BY 1, 2) d
LEFT JOIN ({_counts("stored", tag="CAST(executed_at AS DATE) AS trade_date, instrument_id, ")
           .replace("GROUP BY CAST(executed_at AS DATE) AS trade_date, instrument_id", "GROUP BY 1, 2")}) g
  ON g.trade_date IS NOT DISTINCT FROM d.trade_date
  AND g.instrument_id IS NOT DISTINCT FROM d.instrument_id""",
        "partition_report": _PARTITIONS,
        "scoped_report": (
            "SELECT rule, category, scope, success, failing_rows, observed, rows_checked "
            f"FROM ({_report(rules=unscoped)})"
        ),
        "scoped_run": _report(),
        "touched_duplicates": (
            "SELECT trade_id, count(*) AS n FROM landed WHERE trade_id IN (SELECT trade_id FROM "
            f"landed WHERE ingested_at >= {_SPLIT}) GROUP BY trade_id HAVING count(*) > 1"
        ),
    }
    for name, column in _RULE_COLUMN.items():
        statements[f"rule_{name}"] = f"SELECT trade_id, {column} FROM flagged WHERE f_{name}"
    return {name: _BASE + text for name, text in statements.items()}

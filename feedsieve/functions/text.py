"""One-line summaries of a run as Columns.

The wording and field widths below are fixed formats: people grep for them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats.
PASSED_LINE = "all %d rules passed over %d rows"
FAILED_LINE = "%d of %d rules failed over %d rows: %s"
NOTHING_QUARANTINED_LINE = "no rows quarantined"
QUARANTINED_LINE = "quarantined %d rows (%s)"
HISTORY_LINE = "%s  %-7s checked=%-7d rejected=%-5d rules_failed=%d"


def outcome_line() -> Column:
    """Summary of a ``verdict`` row."""
    return F.when(
        F.col("success"), F.format_string(PASSED_LINE, F.col("rules_total"), F.col("rows_checked"))
    ).otherwise(
        F.format_string(
            FAILED_LINE,
            F.col("rules_failed"),
            F.col("rules_total"),
            F.col("rows_checked"),
            F.array_join("failed_rules", ", "),
        )
    )


def quarantine_line(rows_rejected: Column, counts: Column) -> Column:
    """Summary of a quarantine; ``counts`` is a name-sorted array of (reason, n)."""
    breakdown = F.array_join(
        F.transform(counts, lambda c: F.concat(c["reason"], F.lit("="), c["n"].cast("string"))),
        ", ",
    )
    return F.when(rows_rejected == 0, F.lit(NOTHING_QUARANTINED_LINE)).otherwise(
        F.format_string(QUARANTINED_LINE, rows_rejected, breakdown)
    )


def history_line() -> Column:
    """Listing line of one run."""
    return F.format_string(
        HISTORY_LINE,
        F.col("run_id"),
        F.col("status"),
        F.col("rows_checked"),
        F.col("rows_rejected"),
        F.col("rules_failed"),
    )

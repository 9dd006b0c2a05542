"""The tables this package owns, as Parquet folders below one root.

``rejected_trades`` is partitioned by run: a repeated run overwrites its own
partition and no other, so it converges without reading what it replaces. The
quarantine of today is the latest record per trade: compacted runs are read from a
snapshot that holds it, later ones from their partitions. ``validation_run`` and
``etl_watermark`` are appended to and folded when read; they hold one or two
rows per run and source. ``partition_counters`` has a row per load and partition it touched and is
compacted to the latest ones; ``duplicate_changes`` has a row per load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.operators.load import source_watermarks
from feedsieve.operators.quarantine import current_rejected, quarantine_result
from feedsieve.operators.runs import (
    finish_states,
    fold_runs,
    recent_runs,
    run_results,
    start_states,
)
from feedsieve.rules import Rule
from feedsieve.schemas import (
    counter_schema,
    duplicate_schema,
    rejected_schema,
    result_schema,
    run_schema,
    watermark_schema,
)
from feedsieve.sources.files import delete_folder, names_in
from feedsieve.sources.versions import VersionedTable


BUCKET = "bucket"
SNAPSHOT_BUCKETS = 16


def write_by_day(rows: DataFrame, path: str, column: str = "trade_date") -> None:
    """Store rows in one folder per day, replacing only the days they hold.

    Rebalancing by day gives each day few files and still splits a heavy day.
    """
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


class QualityTables:
    """Handle on the owned tables. Creating it touches nothing."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._layouts: dict[str, tuple[T.StructType, list[str]]] = {
            "rejected_trades": (rejected_schema(), ["run_id"]),
            "validation_run": (run_schema(), []),
            "etl_watermark": (watermark_schema(), []),
            "rule_result": (result_schema(), []),
            "partition_counters": (counter_schema(), []),
            "duplicate_changes": (duplicate_schema(), []),
        }

        kept = T.StructType([*rejected_schema().fields, T.StructField(BUCKET, T.IntegerType())])
        self.snapshot = VersionedTable(spark, self.path("rejected_snapshot"), kept, BUCKET)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def ensure(self) -> None:
        """Create what is absent; existing tables are left as they are."""
        self._write_empty("ignore")

    def reset(self) -> None:
        """Empty the owned tables. Other tables are never touched."""
        self._write_empty("overwrite")
        delete_folder(self.spark, self.snapshot.path)

    def drop(self) -> None:
        """Remove the owned tables with their folders."""
        for name in self._layouts:
            delete_folder(self.spark, self.path(name))
        delete_folder(self.spark, self.snapshot.path)

    def _write_empty(self, mode: str) -> None:
        for name, (schema, partitions) in self._layouts.items():
            (
                self.spark.createDataFrame([], schema)
                .write.mode(mode)
                .option("partitionOverwriteMode", "static")
                .partitionBy(*partitions)
                .parquet(self.path(name))
            )

    def _read(self, name: str) -> DataFrame:
        schema, _ = self._layouts[name]
        rows = self.spark.read.schema(schema).parquet(self.path(name))
        return rows.select(*schema.fieldNames())

    # Quarantine

    def write_rejected(self, rejected: DataFrame) -> None:
        """Store the records of one or more runs, replacing those runs only.

        A run that rejects nothing writes no partition; ``clear_rejected`` removes
        an older one of the same run. Rebalancing sizes the files: the few failing
        rows of many scan tasks would otherwise become as many tiny files. A snapshot that holds an
        older repeat of these runs is given up.
        """
        compacted = self._compacted()
        if compacted:
            again = rejected.select("run_id").distinct().collect()  # the runs written, normally one
            if any(r["run_id"] in compacted for r in again):
                self.forget_snapshot()
        (
            rejected.hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(self.path("rejected_trades"))
        )

    def clear_rejected(self, run_id: str) -> None:
        """Remove the records of a run that, repeated, rejects nothing."""
        if run_id in self._compacted():
            self.forget_snapshot()
        if not self.rejected(run_id).isEmpty():
            name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
            folder = f"{self.path('rejected_trades')}/run_id={name.escapePathName(run_id)}"
            delete_folder(self.spark, folder)

    def rejected(self, run_id: str | None = None) -> DataFrame:
        """Records of all runs, or of one by partition pruning."""
        records = self._read("rejected_trades")
        return records if run_id is None else records.where(F.col("run_id") == run_id)

    def _compacted(self) -> set[str]:
        """The runs the snapshot holds: a name per run, like the history."""
        return set(self.snapshot.manifest().notes.get("runs", []))

    def _stored_runs(self) -> set[str]:
        """The runs with a partition."""
        names = names_in(self.spark, self.path("rejected_trades"))
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {unescape(n.split("=", 1)[1]) for n in names if n.startswith("run_id=")}

    def compact_rejected(self) -> int:
        """Fold all runs so far into the snapshot; the number of runs it holds then.

        The records of the runs stay where they are. The snapshot becomes current by one rename, so readers and
        interrupted compactions see the old one or the new one. It is laid out in buckets by trade.
        """
        runs = self._compacted() | self._stored_runs()
        bucket = F.pmod(F.hash("trade_id"), F.lit(SNAPSHOT_BUCKETS))
        self.snapshot.overwrite(
            self._latest_rejected(runs - self._compacted()).withColumn(BUCKET, bucket), {"runs": sorted(runs)}
        )
        return len(runs)

    def forget_snapshot(self) -> None:
        """Read every run again, until the next compaction."""
        self.snapshot.overwrite(self.snapshot.rows().limit(0))

    def _latest_rejected(self, later: set[str]) -> DataFrame:
        held = self.snapshot.rows().drop(BUCKET)
        # Run names prune partitions: those the snapshot holds are not listed, let alone read.
        new = self._read("rejected_trades").where(F.col("run_id").isin(sorted(later)))
        return current_rejected(held.unionByName(new))

    def current_rejected(self) -> DataFrame:
        """The latest record per trade, from the snapshot and the runs since."""
        return self._latest_rejected(self._stored_runs() - self._compacted())

    def rejected_trade(self, trade_id: str) -> DataFrame:
        """The current record of one trade: one bucket of the snapshot and the runs since."""
        one = self.spark.createDataFrame([(trade_id,)], "trade_id string")
        bucket = one.select(F.pmod(F.hash("trade_id"), F.lit(SNAPSHOT_BUCKETS))).first()[0]
        held = self.snapshot.rows_of(self.snapshot.manifest(), [str(bucket)]).drop(BUCKET)
        later = sorted(self._stored_runs() - self._compacted())
        new = self._read("rejected_trades").where(F.col("run_id").isin(later))
        wanted = F.col("trade_id") == trade_id
        return current_rejected(held.where(wanted).unionByName(new.where(wanted)))

    # Run history

    def start_run(self, run_id: str, started_at: dt.datetime) -> None:
        """Record a run as running, so that a crashed one stays visible."""
        starts = self.spark.createDataFrame(
            [(run_id, started_at)], "run_id string, started_at timestamp"
        )
        self._append("validation_run", start_states(starts))

    def finish_run(
        self,
        run_id: str,
        report: DataFrame,
        rules: Sequence[Rule],
        finished_at: dt.datetime,
    ) -> None:
        """Close a run. What it rejected is read from the quarantine table itself."""
        rejected = quarantine_result(self.rejected(run_id), rules, ["run_id"])
        results = run_results(report.withColumn("run_id", F.lit(run_id)), rejected)
        # Before the run row: a run that shows as finished has its results.
        stamps = {"run_id": F.lit(run_id), "finished_at": F.lit(finished_at)}
        self._append("rule_result", report.withColumns(stamps))
        self._append("validation_run", finish_states(results, F.lit(finished_at)))

    def runs(self) -> DataFrame:
        return fold_runs(self._read("validation_run"))

    def recent_runs(self, limit: int = 10) -> DataFrame:
        return recent_runs(self.runs(), limit)

    def rule_results(self) -> DataFrame:
        """What each rule found in each run, and since which run it has been failing without a break.

        A repeated run counts as it ended last. There is a row per rule and run; the history of a rule is ordered in one task.
        """
        rows = self._read("rule_result")
        found = [c for c in rows.columns if c not in ("run_id", "rule")]
        latest = (
            rows.groupBy("run_id", "rule")
            .agg(F.max_by(F.struct(*found), "finished_at").alias("r"))
            .select("run_id", "rule", "r.*")
        )
        so_far = Window.partitionBy("rule").orderBy("finished_at", "run_id")
        spell = F.count_if(F.col("success")).over(so_far)
        failing = Window.partitionBy("rule", "_spell", "success").orderBy("finished_at", "run_id")
        since = F.when(~F.col("success"), F.first("run_id").over(failing))
        return latest.withColumn("_spell", spell).withColumn("failing_since", since).drop("_spell")

    # Watermarks

    def advance_watermarks(self, trades: DataFrame) -> None:
        self._append("etl_watermark", source_watermarks(trades))

    def watermarks(self) -> DataFrame:
        marks = self._read("etl_watermark")
        return marks.groupBy("source_file").agg(F.max("high_watermark").alias("high_watermark"))

    # Counters of partitions

    def add_counters(self, state: DataFrame) -> None:
        """Store counters of the partitions a load touched (``partitions.counter_state``)."""
        self._append("partition_counters", state)

    def counters(self) -> DataFrame:
        return self._read("partition_counters")

    def add_duplicate_change(self, change: DataFrame) -> None:
        self._append("duplicate_changes", change)

    def duplicate_rows(self) -> DataFrame:
        """One row: rows in duplicate groups after all loads; a load stored twice counts once."""
        own = self._read("duplicate_changes").groupBy("load").agg(F.max("duplicate_rows").alias("n"))
        return own.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"))

    def _append(self, name: str, rows: DataFrame) -> None:
        schema, _ = self._layouts[name]
        rows.select(*schema.fieldNames()).coalesce(1).write.mode("append").parquet(self.path(name))

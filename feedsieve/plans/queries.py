"""Named queries over the given tables, one per operator of the survey.

Every query reads the derived feed of the directory it is given and returns a
lazy DataFrame; those about stored state first write it to a new folder below ``spark.checkpoint.dir``. Reason
arrays are joined to text so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsieve.functions.text import outcome_line, quarantine_line
from feedsieve.operators import labels, load, partitions, pnl, quarantine, report, runs, upsert
from feedsieve.operators.references import small_enough
from feedsieve.plans import scoped_run as scoped
from feedsieve.plans import tables as T
from feedsieve.plans.quality_run import ALWAYS, NEVER, ON_FAILURE, run_quality
from feedsieve.rules import KEY_PRESENT, Rule, positive, predicate, row_rules, trade_rules
from feedsieve.schemas import TRADE_COLUMNS, trade_schema
from feedsieve.sources.files import shared_folder
from feedsieve.sources.key_index import KeyIndex, duplicates_after
from feedsieve.sources.readers import read_query
from feedsieve.sources.tables import QualityTables
from feedsieve.sources.versions import VersionedTable, partition_text

RULES = trade_rules()
BY_NAME = {r.name: r for r in RULES}

# The day results are measured at, and a later one at which the feed is stale.
AS_OF = "2001-12-01"
STALE_AS_OF = "2004-01-01"
# Loads before and from this day are the first and the second batch.
SECOND_BATCH_FROM = "1999-01-01"
SLOW_FROM = "1997-01-01"
FIRST_RUN, SECOND_RUN = "run-a", "run-b"
FIRST_TIME, SECOND_TIME = "2001-11-30 06:00:00", "2001-12-01 06:00:00"


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", ","))


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return T.landed(spark, d), T.instruments(spark, d)


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return T.trades(spark, d), T.instruments(spark, d)


def _batches(landed: DataFrame, unwanted: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The two batches, re-sends merged. Columns that come after the order of re-sends may be left out: it alone decides the others."""
    second = F.col("ingested_at") >= _time(SECOND_BATCH_FROM)
    return tuple(
        load.latest_per_key(landed.where(batch).drop(*unwanted), "trade_id", load.RESEND_ORDER)
        for batch in (~second, second)
    )


# Load


def typed_feed(spark: SparkSession, d: str) -> DataFrame:
    return load.typed_feed(T.feed(spark, d), T.NTZ)


def collapse_retries(spark: SparkSession, d: str) -> DataFrame:
    return load.collapse_retries(T.landed(spark, d), measure=True)


def collapse_many_retries(spark: SparkSession, d: str) -> DataFrame:
    """Without counting first, as for tables in which many trades were re-sent."""
    return load.collapse_retries(T.landed(spark, d))


def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    arrived = load.typed_feed(T.feed(spark, d), T.NTZ)
    return load.newer_than(arrived, _stored_mark(spark, d))


def _stored_mark(spark: SparkSession, d: str) -> Column:
    """The mark that the first batch left in ``etl_watermark``."""
    loaded = T.landed(spark, d).where(F.col("ingested_at") < _time(SECOND_BATCH_FROM))
    return load.high_watermark(load.source_watermarks(loaded), "high_watermark").scalar()


def late_rows(spark: SparkSession, d: str) -> DataFrame:
    return load.late_rows(T.landed(spark, d), _stored_mark(spark, d))


def _paced(landed: DataFrame) -> Column:
    """What was loaded of each source: one is two years behind the other."""
    slow = F.col("source_file") == "feed_F"
    return F.col("ingested_at") < F.when(slow, _time(SLOW_FROM)).otherwise(_time(SECOND_BATCH_FROM))


def incremental_load_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Each row against the mark of its own source."""
    landed = T.landed(spark, d)
    marks = load.source_watermarks(landed.where(_paced(landed)))
    return load.newer_by_source(load.typed_feed(T.feed(spark, d), T.NTZ), marks)


def late_by_source(spark: SparkSession, d: str) -> DataFrame:
    landed = T.landed(spark, d)
    return load.late_by_source(landed, load.source_watermarks(landed.where(_paced(landed))))


MONTH = "trade_month"


def _monthly_store(spark: SparkSession, folder: str) -> VersionedTable:
    layout = trade_schema(T.NTZ).add(MONTH, "date")
    return VersionedTable(spark, f"{folder}/trade", layout, MONTH)


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.trunc(pnl.trade_date(), "month"))


def _months(rows: DataFrame) -> list[str]:
    """Folder names of the months of some rows: one per month."""
    return [r[0] for r in _by_month(rows).select(partition_text(MONTH)).distinct().collect()]


def loaded_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The trade table after its first load and after its second, from one versioned table."""
    first, second = _batches(T.landed(spark, d))
    store = _monthly_store(spark, shared_folder(spark))
    before = store.overwrite(_by_month(first))
    second = _written(spark, second, "second")
    # The keys grow with the batch: measured before they are broadcast.
    keys = second.select("trade_id")
    few = small_enough(keys)
    # Months that hold an older version of an arriving trade are touched as well.
    known = store.rows_of(before).join(F.broadcast(keys) if few else keys, "trade_id", "left_semi")
    touched = sorted({*_months(second), *_months(known)})
    after = upsert.upsert(
        store.rows_of(before, touched), _by_month(second), ["trade_id"], few
    )
    version = store.begin()
    store.commit(before, version, store.write(version, after), touched)
    return (
        store.rows(before.version)
        .withColumn("version", F.lit(1))
        .unionByName(store.rows().withColumn("version", F.lit(2)))
        .drop(MONTH)
    )


def indexed_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates that the second batch causes, asked of a key index that holds the first."""
    landed = T.landed(spark, d)
    later = F.col("ingested_at") >= _time(SECOND_BATCH_FROM)
    index = KeyIndex(spark, f"{shared_folder(spark)}/keys", buckets=8, expected_keys=100_000)
    index.add(landed.where(~later), F.col("source_file"), 1)
    finished = spark.createDataFrame([(1,)], "load long")
    return duplicates_after(index, landed.where(later), finished).select("trade_id", "n")


def _nameless(feed: DataFrame) -> DataFrame:
    """The feed with some ids missing."""
    lacking = F.substring("trade_id", 2, 20).cast("long") % 101 == 0
    return feed.withColumn("trade_id", F.when(~lacking, F.col("trade_id")).otherwise(F.lit("")))


def load_balance(spark: SparkSession, d: str) -> DataFrame:
    first, _ = _batches(T.landed(spark, d))
    later = T.feed(spark, d).where(F.col("ingested_at") >= _time(SECOND_BATCH_FROM))
    return load.load_balance(first, _nameless(later), T.NTZ)


def unkeyed_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine of a loaded feed in which ids are missing."""
    empty = T.landed(spark, d).limit(0)
    loaded = load.load_trades(empty, _nameless(T.feed(spark, d)), timestamp=T.NTZ)
    rules = [*RULES, KEY_PRESENT]
    records = quarantine.quarantine(
        loaded, T.instruments(spark, d), rules, FIRST_RUN, _time(FIRST_TIME)
    )
    return _joined(quarantine.current_rejected(records).where("trade_id IS NULL"))


def trade_upsert(spark: SparkSession, d: str) -> DataFrame:
    first, _ = _batches(T.landed(spark, d))
    later = T.feed(spark, d).where(F.col("ingested_at") >= _time(SECOND_BATCH_FROM))
    return load.load_trades(first, later, incremental=False, timestamp=T.NTZ)


def feed_watermark(spark: SparkSession, d: str) -> DataFrame:
    landed = T.landed(spark, d)
    second = F.col("ingested_at") >= _time(SECOND_BATCH_FROM)
    marks = load.source_watermarks(landed.where(~second))
    return load.advance_watermarks(marks, landed.where(second))


# Rules


def rule_report(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    return report.rule_report(landed, instruments, RULES, AS_OF).drop("description")


def rule_report_loaded(spark: SparkSession, d: str) -> DataFrame:
    trades, instruments = _stored(spark, d)
    return report.rule_report(trades, instruments, RULES, STALE_AS_OF).drop("description")


def rule_report_drifted(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    drifted = landed.withColumnRenamed("price", "px").drop("trade_id")
    return report.rule_report(drifted, instruments, RULES, AS_OF).drop("description")


def rule_catalog(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    found = report.rule_report(landed, instruments, RULES, AS_OF)
    return found.select("position", "rule", "category", "scope", "description", "failing_rows")


def rule_labels(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    wanted = landed.drop("source_file", "ingested_at")
    return _joined(labels.with_reasons(wanted, instruments, RULES))


def _offenders(rule: Rule) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        landed, instruments = _both(spark, d)
        return labels.offenders(landed, instruments, rule, ["trade_id", *rule.columns])

    return run


def rule_trade_id_unique(spark: SparkSession, d: str) -> DataFrame:
    return report.duplicate_summary(T.landed(spark, d))


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return report.duplicate_keys(T.landed(spark, d))


def custom_rules(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    extra = [
        predicate(
            "notional_bounded",
            "quantity * price > 2000000",
            "No single trade is worth more than two million.",
            "value_range",
            ["quantity", "price"],
        ),
        positive("instrument_positive", "instrument_id", "Instrument numbers start at one."),
    ]
    rejected = labels.failing_rows(landed, instruments, [*RULES, *extra])
    return quarantine.reason_counts(rejected)


def feed_freshness(spark: SparkSession, d: str) -> DataFrame:
    return report.feed_freshness(T.landed(spark, d), BY_NAME["feed_is_fresh"], AS_OF)


def feed_freshness_stale(spark: SparkSession, d: str) -> DataFrame:
    return report.feed_freshness(T.landed(spark, d), BY_NAME["feed_is_fresh"], STALE_AS_OF)


def rule_report_clashing(spark: SparkSession, d: str) -> DataFrame:
    """Input with columns named like those a run adds."""
    landed, instruments = _both(spark, d)
    clashing = landed.selectExpr("*", "side AS run_id", "price AS reasons", "quantity AS rejected_at")
    return report.rule_report(clashing, instruments, RULES, AS_OF).drop("description", "observed")


def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    drifted = (
        T.landed(spark, d)
        .withColumnRenamed("source_file", "origin")
        .withColumn("venue", F.when(F.col("side") == "SELL", F.lit("OTC")))
    )
    return report.drift_report(drifted, TRADE_COLUMNS)


def validation_verdict(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    found = report.verdict(report.rule_report(landed, instruments, RULES, AS_OF))
    return found.withColumn("failed_rules", F.array_join("failed_rules", ","))


def category_report(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    return report.category_report(report.rule_report(landed, instruments, RULES, AS_OF))


def rule_agreement(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    counts = quarantine.reason_counts(labels.failing_rows(landed, instruments, RULES))
    checks = row_rules(RULES)
    return report.rule_agreement(report.rule_report(landed, instruments, checks), counts)


# Quarantine


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    trades, instruments = _stored(spark, d)
    return quarantine.quarantine(trades, instruments, RULES, FIRST_RUN, _time(FIRST_TIME))


def quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    return _joined(_rejected(spark, d))


def _written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows as a stored table, for what reads them more than once."""
    path = f"{shared_folder(spark)}/{name}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _two_loads(
    spark: SparkSession, landed: DataFrame, unwanted: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first batch, the second and the table after both, stored."""
    first, second = (
        _written(spark, batch, name)
        for batch, name in zip(_batches(landed, unwanted), ("first", "second"), strict=True)
    )
    few = small_enough(second.select("trade_id"))
    return first, second, _written(spark, upsert.upsert(first, second, ["trade_id"], few), "loaded")


def quarantine_upsert(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    first, _, loaded = _two_loads(spark, landed)
    before = quarantine.quarantine(first, instruments, RULES, FIRST_RUN, _time(FIRST_TIME))
    again = quarantine.quarantine(loaded, instruments, RULES, SECOND_RUN, _time(SECOND_TIME))
    return _joined(quarantine.quarantine_upsert(before, again))


def current_rejected(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    first, second = _batches(landed)
    records = quarantine.quarantine(
        first, instruments, RULES, FIRST_RUN, _time(FIRST_TIME)
    ).unionByName(
        quarantine.quarantine(second, instruments, RULES, SECOND_RUN, _time(SECOND_TIME))
    )
    return _joined(quarantine.current_rejected(records))


def current_rejected_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The quarantine from a snapshot of the first run and the records of the second."""
    landed, instruments = _both(spark, d)
    owned = QualityTables(spark, shared_folder(spark))
    owned.ensure()
    for run, time, batch in zip((FIRST_RUN, SECOND_RUN), (FIRST_TIME, SECOND_TIME), _batches(landed), strict=True):
        stamp = F.lit(time).cast("timestamp")
        owned.write_rejected(quarantine.quarantine(batch, instruments, RULES, run, stamp))
        if run == FIRST_RUN:
            owned.compact_rejected()
    zone_free = {c: F.col(c).cast("timestamp_ntz") for c in ("executed_at", "rejected_at")}
    return _joined(owned.current_rejected().withColumns(zone_free))


def orphans_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Orphan records of instruments that arrived late, labelled again without the trades."""
    late = T.late_instruments(spark, d)
    return _joined(
        quarantine.resolve_orphans(
            _rejected(spark, d), late, "instrument_exists", SECOND_RUN, _time(SECOND_TIME)
        )
    )


def valid_trades(spark: SparkSession, d: str) -> DataFrame:
    return labels.valid_rows(*_stored(spark, d), RULES)


def batch_split(spark: SparkSession, d: str) -> DataFrame:
    return labels.batch_split(*_stored(spark, d), RULES)


def orphan_trades(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.orphan_trades(*_both(spark, d))


def orphan_keys(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.orphan_keys(*_both(spark, d))


def orphan_row_count(spark: SparkSession, d: str) -> DataFrame:
    landed, instruments = _both(spark, d)
    orphans = read_query(
        spark,
        "SELECT trade_id, instrument_id FROM {trade} t WHERE instrument_id IS NOT NULL AND"
        " NOT EXISTS (SELECT 1 FROM {instrument} i WHERE i.instrument_id = t.instrument_id)",
        trade=landed,
        instrument=instruments,
    )
    return report.row_count_check(orphans, 0)


def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    trades, instruments = _stored(spark, d)
    return quarantine.reason_counts(labels.failing_rows(trades, instruments, RULES))


def rows_rejected(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.rows_rejected(_yearly_rejected(spark, d))


def worst_reason(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.worst_reason(reason_counts(spark, d))


# Runs: one per year of load time


def _yearly(spark: SparkSession, d: str) -> DataFrame:
    year = F.year("ingested_at").cast("string")
    return T.landed(spark, d).withColumn("run_id", F.concat(F.lit("run-"), year))


def _run_year() -> Column:
    return F.substring("run_id", 5, 4).cast("int")


def _yearly_rejected(spark: SparkSession, d: str) -> DataFrame:
    rows = _yearly(spark, d)
    return labels.failing_rows(rows, T.instruments(spark, d), RULES)


def _yearly_report(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.make_date(_run_year(), F.lit(12), F.lit(31))
    return report.rule_report(
        _yearly(spark, d), T.instruments(spark, d), RULES, as_of, by=["run_id"]
    )


def _opened() -> Column:
    return F.make_timestamp_ntz(
        _run_year() + 1, F.lit(1), F.lit(2), F.lit(6), F.lit(0), F.lit(0)
    )


def _starts(spark: SparkSession, d: str) -> DataFrame:
    return _yearly(spark, d).select("run_id").distinct().withColumn("started_at", _opened())


def _results(spark: SparkSession, d: str) -> DataFrame:
    rejected = quarantine.quarantine_result(_yearly_rejected(spark, d), RULES, ["run_id"])
    return runs.run_results(_yearly_report(spark, d), rejected)


def _finished(spark: SparkSession, d: str) -> DataFrame:
    return runs.finish_states(_results(spark, d), _opened() + F.expr("INTERVAL 10 MINUTES"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    return runs.finish_run(runs.start_states(_starts(spark, d)), _finished(spark, d))


def quality_routes(spark: SparkSession, d: str) -> DataFrame:
    """Whole runs over sound and over unsound trades, and what each way of routing quarantined."""
    trades, instruments = _stored(spark, d)
    zoned = {c: F.col(c).cast("timestamp") for c in ("executed_at", "ingested_at")}
    # The trades are merged once; no row rule depends on the zone of a time.
    unsound = _written(spark, trades.withColumns(zoned), "trades")
    sound = _written(spark, labels.valid_rows(unsound, instruments, RULES), "sound")
    owned = QualityTables(spark, shared_folder(spark))
    for name, rows in (("sound", sound), ("unsound", unsound)):
        for route in (ALWAYS, ON_FAILURE, NEVER):
            run_quality(rows, instruments, owned, RULES, f"{name}-{route}", AS_OF, quarantine_when=route)
    stored = owned.rejected().groupBy("run_id").agg(F.count(F.lit(1)).alias("rows_stored"))
    return (
        owned.runs()
        .join(stored, "run_id", "left")
        .select(
            "run_id",
            "status",
            "rows_checked",
            "rows_rejected",
            "rules_total",
            "rules_failed",
            F.coalesce("rows_stored", F.lit(0).cast("long")).alias("rows_stored"),
        )
    )


def rule_results(spark: SparkSession, d: str) -> DataFrame:
    """What each rule found in the runs over two batches, and since when it fails."""
    landed, instruments = _both(spark, d)
    owned = QualityTables(spark, shared_folder(spark))
    for run, time, batch in zip((FIRST_RUN, SECOND_RUN), (FIRST_TIME, SECOND_TIME), _batches(landed), strict=True):
        stamp = dt.datetime.fromisoformat(time)
        run_quality(_written(spark, batch, run), instruments, owned, RULES, run, AS_OF, stamp)
    return owned.rule_results().drop("finished_at")


def owned_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each owned table after a run, after a second ``ensure`` and after a reset."""
    trades, instruments = _both(spark, d)
    owned = QualityTables(spark, shared_folder(spark))
    owned.drop()
    run_quality(_written(spark, trades, "trades"), instruments, owned, RULES, FIRST_RUN, AS_OF)
    owned.advance_watermarks(trades)

    def counts() -> list[int]:
        return [rows.count() for rows in (owned.rejected(), owned.runs(), owned.watermarks())]

    after_run = counts()
    owned.ensure()
    again = counts()
    owned.reset()
    rows = list(zip(("rejected_trades", "validation_run", "etl_watermark"), after_run, again, counts(), strict=True))
    return spark.createDataFrame(
        rows, "table_name string, after_run long, after_ensure long, after_reset long"
    )


def run_start(spark: SparkSession, d: str) -> DataFrame:
    finished = runs.fold_runs(_finished(spark, d)).where(
        F.col("started_at") < _time(SECOND_BATCH_FROM)
    )
    return runs.start_run(finished, _starts(spark, d)).drop("details")


def run_history(spark: SparkSession, d: str) -> DataFrame:
    return runs.recent_runs(_history(spark, d))


def history_lines(spark: SparkSession, d: str) -> DataFrame:
    return runs.history_lines(_history(spark, d))


def rejection_trend(spark: SparkSession, d: str) -> DataFrame:
    return runs.rejection_trend(_history(spark, d))


def rejection_alarm(spark: SparkSession, d: str) -> DataFrame:
    """Is rejection getting worse from run to run?"""
    return runs.rejection_alarm(_history(spark, d), baseline=3, slack_ppm=100, limit_ppm=1_000)


def run_details(spark: SparkSession, d: str) -> DataFrame:
    def at(path: str) -> Column:
        return F.get_json_object("details", path)

    return _results(spark, d).select(
        "run_id",
        at("$.rules.price_present.success").alias("price_success"),
        at("$.rules.price_present.category").alias("price_category"),
        at("$.rules.price_present.observed").cast("long").alias("price_observed"),
        at("$.rules.trade_id_unique.observed").cast("long").alias("unique_observed"),
        at("$.rules.schema_unchanged.observed[7]").alias("last_column"),
        at("$.reason_counts.price_present").cast("long").alias("price_rejected"),
        at("$.reason_counts.instrument_exists").cast("long").alias("orphans_rejected"),
    )


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    line = quarantine_line(F.col("rows_rejected"), F.col("reason_counts"))
    return _results(spark, d).select(
        "run_id", outcome_line().alias("outcome"), line.alias("quarantine")
    )


# Downstream


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return labels.valid_rows(*_stored(spark, d), RULES)


def daily_pnl(spark: SparkSession, d: str) -> DataFrame:
    return pnl.daily_pnl(_valid(spark, d))


def daily_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Daily figures after a second batch, recomputed for the days it touched."""
    landed, instruments = _both(spark, d)
    # Daily figures need neither of these, and every row is moved several times.
    first, second, loaded = _two_loads(spark, landed, ("source_file", "ingested_at"))
    days = _written(spark, pnl.days_of_batch(first, second), "days")
    before = pnl.daily_pnl(labels.valid_rows(first, instruments, RULES))
    dated = loaded.withColumn("trade_date", pnl.trade_date())
    again = partitions.touched_partitions(dated, days, "trade_date").drop("trade_date")
    fresh = pnl.daily_pnl(labels.valid_rows(again, instruments, RULES))
    return pnl.replace_days(before, fresh, days)


def daily_pnl_by_asset_class(spark: SparkSession, d: str) -> DataFrame:
    return pnl.daily_pnl_by(_valid(spark, d), T.instruments(spark, d))


def daily_position(spark: SparkSession, d: str) -> DataFrame:
    return pnl.daily_position(pnl.daily_pnl(_valid(spark, d)))


def position_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Running positions after a second batch, from the first month it touched on."""
    landed, instruments = _both(spark, d)
    # Read three times and more: for the first positions, for what the load touched and for the new positions.
    first, _, loaded = _two_loads(spark, landed)
    folder = shared_folder(spark)
    layout = pnl.daily_position(pnl.daily_pnl(first.limit(0))).schema.add(MONTH, "date")
    store = VersionedTable(spark, f"{folder}/position", layout, MONTH)
    month = F.trunc("trade_date", "month")

    def placed(positions: DataFrame) -> DataFrame:
        return positions.withColumn(MONTH, month)

    held = placed(pnl.daily_position(pnl.daily_pnl(labels.valid_rows(first, instruments, RULES))))
    before = store.overwrite(held)
    carries = f"{folder}/carry"
    pnl.position_carry(store.rows_of(before), MONTH).write.partitionBy(MONTH).parquet(carries)

    since = pnl.touched_days(first, loaded).where("trade_date IS NOT NULL").agg(F.min(month)).first()[0]
    if since is None:
        return store.rows().drop(MONTH)
    daily = pnl.daily_pnl(
        labels.valid_rows(loaded.where(pnl.trade_date() >= F.lit(since)), instruments, RULES)
    )
    earlier = spark.read.parquet(carries).where(F.col(MONTH) < F.lit(since))
    again = placed(pnl.resumed_position(daily, earlier, MONTH))
    touched = [value for value in before.partitions if value >= str(since)]
    version = store.begin()
    store.commit(before, version, store.write(version, again), touched)
    return store.rows().drop(MONTH)


def position_marked_daily(spark: SparkSession, d: str) -> DataFrame:
    """The whole book on every calendar day, instruments without a trade at their last close."""
    return pnl.daily_book(pnl.marked_daily(pnl.daily_position(pnl.daily_pnl(_valid(spark, d))), together=True))


def stored_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Freshness and row count of a stored table, from its manifest and its newest month."""
    store = _monthly_store(spark, shared_folder(spark))
    store.overwrite(_by_month(T.landed(spark, d)))
    found = report.feed_freshness(store.greatest("executed_at"), BY_NAME["feed_is_fresh"], AS_OF)
    return found.withColumn("rows_checked", F.lit(store.row_count()).cast("long"))


def coverage_gap(spark: SparkSession, d: str) -> DataFrame:
    return pnl.coverage_gap(*_stored(spark, d), RULES)


# Partitions


def _dated(spark: SparkSession, d: str) -> DataFrame:
    return T.landed(spark, d).withColumn("trade_date", pnl.trade_date())


def _touched(dated: DataFrame) -> DataFrame:
    """The days of the rows loaded in the second batch."""
    second = F.col("ingested_at") >= _time(SECOND_BATCH_FROM)
    return dated.where(second).select("trade_date").distinct()


def partition_report(spark: SparkSession, d: str) -> DataFrame:
    dated = _dated(spark, d)
    return partitions.partition_counters(dated, T.instruments(spark, d), RULES, "trade_date")


def scoped_report(spark: SparkSession, d: str) -> DataFrame:
    """The touched days checked again, merged with the counters kept of the others."""
    dated, instruments = _dated(spark, d), T.instruments(spark, d)
    first = F.col("ingested_at") < _time(SECOND_BATCH_FROM)
    stored = partitions.partition_counters(dated.where(first), instruments, RULES, "trade_date")
    fresh = partitions.partition_counters(
        partitions.touched_partitions(dated, _touched(dated), "trade_date"),
        instruments,
        RULES,
        "trade_date",
    )
    whole = report.merge_counters(partitions.replace_partitions(stored, fresh, "trade_date"))
    checked = [r for r in RULES if r.kind != "unique"]
    return report.report_rows(whole, checked, list(TRADE_COLUMNS), AS_OF).drop(
        "description", "position"
    )


def scoped_run(spark: SparkSession, d: str) -> DataFrame:
    """The full report after a second load that only adds rows, from counters and the months it touched."""
    landed, instruments = _both(spark, d)
    later = F.col("ingested_at") >= _time(SECOND_BATCH_FROM)
    folder = shared_folder(spark)
    owned, store = QualityTables(spark, f"{folder}/quality"), _monthly_store(spark, folder)
    index = KeyIndex(spark, f"{folder}/keys", buckets=8, expected_keys=100_000)
    owned.ensure()
    before = store.manifest()
    for batch in (landed.where(~later), landed.where(later)):
        touched = _months(batch)
        rows = store.rows_of(before, touched).unionByName(_by_month(batch))
        version = store.begin()
        after = store.commit(before, version, store.write(version, rows), touched)
        places = spark.createDataFrame([(m,) for m in touched], "place string")
        scoped.record_partitions(owned, store.rows_of(after, touched), places, instruments, RULES, MONTH, version)
        finished = spark.createDataFrame([(v,) for v in store.versions() if v < version], "load long")
        scoped.record_keys(owned, index, _by_month(batch), finished, partition_text(MONTH), version)
        before = after
    return scoped.scoped_report(owned, RULES, TRADE_COLUMNS, AS_OF).drop("description")


def touched_duplicates(spark: SparkSession, d: str) -> DataFrame:
    dated = _dated(spark, d)
    second = dated.where(F.col("ingested_at") >= _time(SECOND_BATCH_FROM))
    return partitions.touched_duplicates(dated, second)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        typed_feed,
        collapse_retries,
        collapse_many_retries,
        incremental_load,
        incremental_load_by_source,
        late_rows,
        late_by_source,
        load_balance,
        unkeyed_rejected,
        trade_upsert,
        loaded_as_of,
        indexed_duplicates,
        feed_watermark,
        rule_report,
        rule_report_loaded,
        rule_report_drifted,
        rule_report_clashing,
        rule_catalog,
        rule_labels,
        rule_trade_id_unique,
        duplicate_keys,
        custom_rules,
        feed_freshness,
        feed_freshness_stale,
        schema_drift,
        validation_verdict,
        category_report,
        rule_agreement,
        quarantine_rows,
        quarantine_upsert,
        current_rejected,
        current_rejected_compacted,
        orphans_resolved,
        valid_trades,
        batch_split,
        orphan_trades,
        orphan_keys,
        orphan_row_count,
        reason_counts,
        rows_rejected,
        worst_reason,
        quality_routes,
        owned_tables,
        rule_results,
        run_start,
        run_history,
        history_lines,
        rejection_trend,
        rejection_alarm,
        run_details,
        run_summary,
        daily_pnl,
        daily_refresh,
        daily_pnl_by_asset_class,
        daily_position,
        position_refresh,
        position_marked_daily,
        stored_freshness,
        coverage_gap,
        partition_report,
        scoped_report,
        scoped_run,
        touched_duplicates,
    )
    named = {f.__name__: f for f in plain}
    named.update({f"rule_{r.name}": _offenders(r) for r in row_rules(RULES)})
    return named

"""Registered queries: every operator over whole tables.

Decimals, dates and instants leave as fixed-format text, so that any engine's
result can be compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.functions.clock import local_clock, localised, names_offset, wall_clock, zoned_instant
from pitbars.functions.text import whole_number
from pitbars.operators import adjust, asof, checks, ledger, merge, monitor, normalize, reconcile
from pitbars.plans import inputs as I
from pitbars.schemas import ASOF_COLUMNS, BAR_COLUMNS, KEYS, VERSION_COLUMNS
from pitbars.session import configure
from pitbars.sources.feed import synthetic_feed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def comparable(frame: DataFrame) -> DataFrame:
    """Render decimals, dates and instants as text of fixed format."""

    def text(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.DecimalType, T.DateType)):
            value = value.cast("string")
        return value.alias(field.name)

    return frame.select(*[text(field) for field in frame.schema.fields])


def query(build: Query) -> Query:
    """Register *build* under its name, with session settings and text output applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(configure(spark), sf_dir))

    REGISTRY[build.__name__] = run
    return build


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.tag(I.feed(spark, sf_dir), I.VENDOR_A, I.NOW, I.ORDER)


def _first_bar(spark: SparkSession, sf_dir: str):
    """Smallest key of the table; its instant as a UTC wall clock.

    Every accepted key lands, so the rows needn't be shuffled to drop repeated ones first.
    """
    landing = normalize.stage(normalize.accepted(_tagged(spark, sf_dir)), I.VENDOR_A)
    least = landing.agg(F.min(F.struct(*KEYS)).alias("k")).select("k.*")
    return least.withColumn("price_ts", F.col("price_ts").cast("timestamp_ntz")).first()


# -- feed to bars -----------------------------------------------------------


@query
def feed_columns_mapped(spark, sf_dir):
    mapped = normalize.map_columns(I.feed_b(spark, sf_dir), I.VENDOR_B, ["o1"])
    return mapped.withColumn("adjusted_close", F.coalesce("adjusted_close", F.lit("none")))


@query
def feed_tagged_reasons(spark, sf_dir):
    return _tagged(spark, sf_dir).select(*I.ORDER, normalize.REASON)


@query
def reject_reason_counts(spark, sf_dir):
    return normalize.reason_counts(_tagged(spark, sf_dir))


@query
def feed_rejected_rows(spark, sf_dir):
    return normalize.rejected(_tagged(spark, sf_dir))


@query
def feed_accepted_dedup(spark, sf_dir):
    return normalize.normalize(I.feed(spark, sf_dir), I.VENDOR_A, I.ORDER, I.NOW)


@query
def run_counters(spark, sf_dir):
    return normalize.run_counters(_tagged(spark, sf_dir))


@query
def staged_bars(spark, sf_dir):
    return I.staged(spark, sf_dir)


@query
def two_feeds_staged(spark, sf_dir):
    second = normalize.normalize(I.feed_b(spark, sf_dir), I.VENDOR_B, ["o1"], I.NOW)
    return normalize.union_feeds([I.staged(spark, sf_dir), normalize.stage(second, I.VENDOR_B)])


@query
def feed_local_to_utc(spark, sf_dir):
    tagged = normalize.tag(I.exchange_feed(spark, sf_dir), I.EXCHANGE, I.NOW, ["o1"])
    return tagged.select("o1", "symbol", "price_ts")


@query
def zone_edges(spark, sf_dir):
    """Night-time wall clocks on every ship date, shifts of summer time included."""
    line = F.col("l_linenumber")
    minutes = F.when(line == 1, 90).when(line == 2, 120).when(line == 3, 150).when(line == 4, 180).otherwise(570)
    local = F.to_date("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)
    clocks = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", local.alias("local_ts"))
    instant = localised(F.col("local_ts"), "America/New_York")
    return clocks.withColumn("price_ts", instant).withColumn("shown", local_clock(F.col("price_ts"), "America/New_York"))


@query
def timestamp_shapes(spark, sf_dir):
    """Event times written in twenty-nine shapes and read back."""
    ts = F.col("ts")
    seconds = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    written = [
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(seconds, F.lit("-05:00")),
        F.date_format(ts, "M/d/yyyy H:mm"),
        F.date_format(ts, "yyyyMMdd"),
        F.date_format(ts, "MMM d, yyyy h:mm a"),
        F.concat(seconds, F.lit(" UTC")),
        F.concat(seconds, F.lit(" GMT")),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'"),
        F.date_format(ts, "yyyy/MM/dd HH:mm"),
        F.date_format(ts, "MM/dd/yyyy h:mm a"),
        F.date_format(ts, "MMMM d, yyyy"),
        F.date_format(ts, "dd-MMM-yyyy"),
        F.date_format(ts, "yyyyMMdd'T'HHmmss"),
        F.date_format(ts, "yyyyMMdd HH:mm"),
        F.concat(F.date_format(ts, "yyyy-MM-dd H:mm"), F.lit("-04:00")),
        F.date_format(ts, "MM/dd/yy"),
        F.date_format(ts, "yyyy-MM-dd h:mm a"),
        F.date_format(ts, "M/d/yyyy HH:mm:ss.SSS"),
        F.date_format(ts, "MMM d yyyy HH:mm"),
        F.date_format(ts, "d MMMM yyyy"),
        F.date_format(ts, "MMMM d yyyy"),
        F.date_format(ts, "EEE MMM d HH:mm:ss yyyy"),
        F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        F.date_format(ts, "yyyy.MM.dd HH:mm"),
        F.concat(F.lit("13."), F.date_format(ts, "MM.yyyy HH:mm")),
        F.date_format(ts, "yyyy-MM-dd HH"),
        F.date_format(ts, "d/MM/yyyy h a"),
        F.date_format(ts, "EEEE, MMMM d, yyyy h:mm:ss a"),
    ]
    text = F.element_at(F.array(*written), (F.col("event_id") % len(written) + 1).cast("int"))
    clock = F.col("text")
    local = localised(wall_clock(clock), "UTC")
    read = F.when(names_offset(clock), zoned_instant(clock)).otherwise(local)
    return I.table(spark, sf_dir, "events").select("event_id", text.alias("text")).select("event_id", read.alias("price_ts"))


@query
def calendar_violations(spark, sf_dir):
    tagged = normalize.tag(I.exchange_feed(spark, sf_dir), I.EXCHANGE, I.NOW, ["o1"])
    return tagged.select("o1", normalize.REASON)


@query
def future_timestamps(spark, sf_dir):
    tagged = normalize.tag(I.exchange_feed(spark, sf_dir), I.FeedContract("exchange", "UTC"), datetime(2024, 1, 15), ["o1"])
    return tagged.select("o1", normalize.REASON)


@query
def missing_column_reasons(spark, sf_dir):
    """A required name the feed does not map is reported on every row."""
    contract = I.FeedContract("vendor_a", "UTC", required=("symbol", "venue"))
    return normalize.reason_counts(normalize.tag(I.feed(spark, sf_dir), contract, I.NOW, I.ORDER))


# -- versions ---------------------------------------------------------------


@query
def temporal_merge_versions(spark, sf_dir):
    return I.merged(spark, sf_dir)


@query
def third_load_versions(spark, sf_dir):
    return I.merged_twice(spark, sf_dir)


@query
def merge_change_counts(spark, sf_dir):
    changed = merge.merge_active(I.loaded(spark, sf_dir), I.staged(spark, sf_dir, True), I.RESTATED)
    return merge.change_counts(changed)


@query
def idempotent_reload(spark, sf_dir):
    changed = merge.merge_active(I.loaded(spark, sf_dir), I.staged(spark, sf_dir), I.RESTATED)
    return merge.change_counts(changed)


@query
def versions_to_close(spark, sf_dir):
    return merge.versions_to_close(I.loaded(spark, sf_dir), I.staged(spark, sf_dir, True), I.RESTATED)


@query
def versions_to_insert(spark, sf_dir):
    return merge.versions_to_insert(I.loaded(spark, sf_dir), I.staged(spark, sf_dir, True), I.RESTATED)


@query
def current_versions(spark, sf_dir):
    return merge.current(I.merged(spark, sf_dir)).select(*BAR_COLUMNS, "valid_from")


@query
def version_counts(spark, sf_dir):
    return merge.version_counts(I.merged(spark, sf_dir), "source_name", "symbol")


@query
def price_as_of_point(spark, sf_dir):
    """The first bar of the table, as believed at five moments around the restatement."""
    bar = _first_bar(spark, sf_dir)
    versions = I.merged_twice(spark, sf_dir, (bar["source_name"], bar["symbol"]))
    moments = (datetime(2023, 12, 31), I.FIRST_LOAD, datetime(2024, 1, 31, 23, 59, 59), I.RESTATED, I.RESENT)
    return asof.price_as_of(versions, bar["source_name"], bar["symbol"].lower(), bar["price_ts"], *moments)


@query
def price_as_of_sql(spark, sf_dir):
    """The same lookup through the SQL table function."""
    bar = _first_bar(spark, sf_dir)
    I.merged_twice(spark, sf_dir, (bar["source_name"], bar["symbol"])).createOrReplaceTempView("pitbars_versions")
    asof.register_sql(spark, "pitbars_versions")
    return spark.sql(
        f"SELECT * FROM market_price_as_of(:source, :symbol, TIMESTAMP '{bar['price_ts']}', TIMESTAMP '2024-02-03 00:00:00')",
        {"source": bar["source_name"], "symbol": bar["symbol"].lower()},
    )


@query
def price_as_of_bulk(spark, sf_dir):
    return asof.price_as_of_many(I.merged_twice_in_place(spark, sf_dir), I.requests(spark, sf_dir), in_place=True)


@query
def snapshot_as_of(spark, sf_dir):
    return asof.snapshot_as_of(I.merged(spark, sf_dir), datetime(2024, 1, 20)).select(*ASOF_COLUMNS)


# -- reconciliation and checks ------------------------------------------------


@query
def symbol_checksums(spark, sf_dir):
    return reconcile.symbol_checksums(I.staged(spark, sf_dir), "md5")


@query
def landed_rows(spark, sf_dir):
    return reconcile.landed_for(I.whole(I.staged(spark, sf_dir, True)), I.merged(spark, sf_dir)).select(*BAR_COLUMNS)


@query
def reconcile_by_symbol(spark, sf_dir):
    return reconcile.reconcile(I.staged(spark, sf_dir, True, by_day=True), I.merged_in_place(spark, sf_dir, True), "md5")


@query
def reconcile_documents(spark, sf_dir):
    return reconcile.documents(reconcile.reconcile(I.staged(spark, sf_dir, True), I.loaded(spark, sf_dir), "md5"))


@query
def reconcile_digest(spark, sf_dir):
    """The scalable comparison against a table that missed the restatement."""
    compared = reconcile.reconcile(I.staged(spark, sf_dir, True), I.loaded(spark, sf_dir))
    return compared.select("symbol", "source_rows", "landed_rows", "matched")


@query
def reconcile_differences(spark, sf_dir):
    """The keys of a restated feed and of a table that missed it under which they differ."""
    return reconcile.differences(I.staged(spark, sf_dir, True), merge.current(I.loaded(spark, sf_dir)))


@query
def reconcile_verdict(spark, sf_dir):
    return reconcile.verdict(reconcile.reconcile(I.staged(spark, sf_dir, True), I.merged(spark, sf_dir)))


@query
def reconcile_verdict_failed(spark, sf_dir):
    return reconcile.verdict(reconcile.reconcile(I.staged(spark, sf_dir, True), I.loaded(spark, sf_dir)))


@query
def landing_violations(spark, sf_dir):
    """Constraints that catch what switched-off row rules let through."""
    bars = normalize.normalize(I.feed(spark, sf_dir), I.VENDOR_A_UNCHECKED, I.ORDER, I.NOW)
    return checks.violations(normalize.stage(bars, I.VENDOR_A_UNCHECKED), checks.bar_rules())


@query
def version_violations(spark, sf_dir):
    """A correction dated before the belief it corrects breaks the knowledge interval."""
    backdated = merge.merge_active(I.loaded(spark, sf_dir), I.staged(spark, sf_dir, True), datetime(2023, 12, 1))
    return checks.violations(backdated, checks.version_rules())


@query
def active_key_duplicates(spark, sf_dir):
    """Loading twice without the merge leaves several active versions per key."""
    twice = I.loaded(spark, sf_dir).unionByName(merge.first_load(I.staged(spark, sf_dir, True), I.RESTATED))
    return checks.duplicate_active(twice)


@query
def interval_overlaps(spark, sf_dir):
    """A third of the beliefs written past the merge, while others of their keys are in force."""
    late = merge.first_load(I.whole(I.staged(spark, sf_dir)), I.BETWEEN)
    return checks.overlapping_intervals(I.merged(spark, sf_dir).unionByName(late.where("volume % 300 = 0")))


@query
def volume_spellings(spark, sf_dir):
    """Quantities of all order lines in twelve spellings, whole and not, as the volume rule reads them."""
    n = F.col("l_quantity").cast("bigint").cast("string")
    plain = [
        n, F.concat(n, F.lit(".")), F.concat(n, F.lit(".000")), F.concat(n, F.lit("e2")), F.concat(n, F.lit("00E-2")),
        F.concat(n, F.lit(".0000000000000000001")), F.concat(n, F.lit(".25e2")), F.concat(n, F.lit(".25e1")), F.concat(F.lit("-"), n, F.lit(".0e0")),
        F.concat(F.lit("."), n), F.concat(n, F.lit("e30")), F.concat(F.lit("0.000000000000000000000"), n, F.lit("e23")),
    ]
    line = I.table(spark, sf_dir, "lineitem")
    text = F.element_at(F.array(*plain), (F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(plain))) + 1).cast("int"))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("spelled")).withColumn("volume", whole_number(F.col("spelled")))


@query
def action_violations(spark, sf_dir):
    broke = F.col("symbol").endswith("7")
    spoiled = I.actions(spark, sf_dir).withColumns(
        {
            "split_ratio": F.when(broke, F.lit(0)).otherwise(F.col("split_ratio")).cast("decimal(18,8)"),
            "dividend_amount": F.when(F.col("symbol").endswith("4"), F.lit(None)).otherwise(F.col("dividend_amount")),
            "action_type": F.when(F.col("symbol").endswith("9"), "merger").otherwise(F.col("action_type")),
        }
    )
    return checks.violations(spoiled, checks.action_rules())


@query
def action_duplicates(spark, sf_dir):
    """Actions moved to the first of their year collide."""
    moved = I.actions(spark, sf_dir).withColumn("symbol", F.substring("symbol", 1, 2))
    return checks.duplicate_actions(moved.withColumn("action_date", F.trunc("action_date", "year")))


@query
def ledger_violations(spark, sf_dir):
    spoiled = I.runs(spark, sf_dir).select(
        "run_id",
        F.when(F.col("source_name") == "error", "crashed").otherwise(F.col("status")).alias("status"),
        F.when(F.col("rows_rejected") == 0, "passed").when(F.col("rows_rejected") == 1, "unknown").otherwise("not_run")
        .alias("reconciliation_status"),
    )
    return checks.violations(spoiled, checks.run_rules())


@query
def run_id_duplicates(spark, sf_dir):
    """Recording failed runs a second time repeats their ids."""
    runs = I.runs(spark, sf_dir)
    return checks.duplicate_runs(runs.unionByName(runs.where("status = 'failed'")))


# -- corporate actions --------------------------------------------------------


@query
def bars_with_actions(spark, sf_dir):
    """How many later actions apply to each version."""
    held = adjust.with_actions(I.merged(spark, sf_dir), I.actions(spark, sf_dir))
    return held.select(*KEYS, "valid_from", F.coalesce(F.size("actions"), F.lit(0)).alias("later_actions"))


@query
def adjusted_close(spark, sf_dir):
    adjusted = adjust.adjust_close(I.merged(spark, sf_dir), I.actions(spark, sf_dir), recorded_at=I.RESENT)
    return adjusted.select(*VERSION_COLUMNS)


@query
def adjusted_close_symbol(spark, sf_dir):
    """One listing, as the maintenance command scopes it."""
    listing = ("vendor_a", "s4")
    adjusted = adjust.adjust_close(I.merged(spark, sf_dir, listing), I.actions(spark, sf_dir), *listing)
    return adjusted.select(*KEYS, "close_price", "adjusted_close", "valid_from")


@query
def adjusted_as_new_belief(spark, sf_dir):
    """Adjustment as a merge: changed closes open a new version instead."""
    versions = I.loaded(spark, sf_dir)
    bars = adjust.adjusted_bars(versions, I.actions(spark, sf_dir))
    return merge.change_counts(merge.merge_active(versions, bars, I.RESTATED))


# -- ledger and monitoring ----------------------------------------------------


@query
def run_rates(spark, sf_dir):
    return I.runs(spark, sf_dir).select("run_id", "throughput_rows_per_sec", "error_rate")


@query
def runs_latest(spark, sf_dir):
    return monitor.latest_runs(I.runs(spark, sf_dir)).select(*monitor.RUN_REPORT)


@query
def runs_last_failed(spark, sf_dir):
    return monitor.last_failed(I.runs(spark, sf_dir)).select(*monitor.FAILURE_REPORT)


@query
def runs_daily_trend(spark, sf_dir):
    return monitor.daily_trend(I.runs(spark, sf_dir))


@query
def runs_retained(spark, sf_dir):
    kept = ledger.retained(I.runs(spark, sf_dir), datetime(2024, 1, 25), 14)
    return kept.select("run_id", "source_name", "created_at")


@query
def ledger_latest_state(spark, sf_dir):
    """Start and finish events of every run; small ones are still running."""
    columns = ("run_id", "source_name", "status", "rows_loaded", "duration_ms")
    runs = I.runs(spark, sf_dir)
    started = runs.select("run_id", "source_name", F.lit("running").alias("status"),
                          F.lit(0).cast("bigint").alias("rows_loaded"),
                          F.lit(None).cast("bigint").alias("duration_ms"), F.lit(0).alias("event_seq"))
    finished = runs.where("value >= 5").select(*columns, F.lit(1).alias("event_seq"))
    return ledger.state(started.unionByName(finished)).withColumn("duration_ms", F.coalesce("duration_ms", F.lit(-1)))


@query
def run_lookup(spark, sf_dir):
    """The ledger row of the last run by id."""
    runs = I.runs(spark, sf_dir)
    newest = runs.agg(F.max(F.col("run_id").cast("bigint")).cast("string").alias("id")).first()["id"]
    return ledger.lookup(runs, newest).select(*monitor.RUN_REPORT, "created_at")


@query
def failure_documents(spark, sf_dir):
    failed = I.runs(spark, sf_dir).where("status = 'failed'")
    message = F.concat(F.lit("feed "), F.col("source_name"), F.lit(" stopped in run "), F.col("run_id"))
    document = ledger.failure_document(F.lit("FeedError"), message)
    return failed.select("run_id", F.to_json(document).alias("failure_summary"))


@query
def bench_summary(spark, sf_dir):
    return monitor.bench_summary(I.runs(spark, sf_dir))


@query
def phase_medians(spark, sf_dir):
    return monitor.phase_medians(I.runs(spark, sf_dir))


@query
def dominant_phase(spark, sf_dir):
    return monitor.dominant_phase(I.runs(spark, sf_dir))


@query
def synthetic_bars(spark, sf_dir):
    """The synthetic feed, one bar per event id."""
    return synthetic_feed(I.table(spark, sf_dir, "events"), "event_id")

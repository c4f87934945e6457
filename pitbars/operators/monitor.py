"""Monitoring reports and bench statistics over the ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Phase columns and the names they are reported under.
PHASES = {
    "csv_parse_ms": "CSV parse",
    "transform_ms": "transform",
    "copy_ms": "COPY",
    "upsert_ms": "UPSERT merge",
}

# Columns of the two run reports.
RUN_REPORT = (
    "run_id", "source_name", "status", "started_at", "duration_ms", "rows_read", "rows_valid", "rows_loaded",
    "rows_rejected", "duplicates_dropped", "throughput_rows_per_sec", "csv_parse_ms", "transform_ms", "copy_ms",
    "upsert_ms", "reconciliation_status", "reconciliation", "error_rate", "error_message",
)
FAILURE_REPORT = ("run_id", "source_name", "started_at", "error_message", "failure_summary")


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The *n* most recently started runs."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def last_failed(runs: DataFrame) -> DataFrame:
    """The most recent failure."""
    return latest_runs(runs.where(F.col("status") == "failed"), 1)


def daily_trend(runs: DataFrame) -> DataFrame:
    """Volume and quality per day and source, newest day first."""

    def mean(name: str, digits: int) -> Column:
        return F.round(F.avg(F.col(name).cast("decimal(30,16)")), digits)

    return (
        runs.groupBy(F.date_trunc("day", "started_at").alias("run_day"), "source_name")
        .agg(
            F.count("*").alias("runs"),
            *[F.sum(name).alias(name) for name in ("rows_read", "rows_loaded", "rows_rejected")],
            mean("throughput_rows_per_sec", 2).alias("avg_throughput_rows_per_sec"),
            mean("error_rate", 6).alias("avg_error_rate"),
        )
        .orderBy(F.desc("run_day"), "source_name")
    )


def truncated(value: Column, digits: int) -> Column:
    """Cut toward zero after *digits* decimals."""
    factor = float(10**digits)
    return (value * factor).cast("bigint") / F.lit(factor)


def exact_percentiles(
    rows: DataFrame, groups: Sequence[str], value: str, points: Mapping[str, int], bins_per_group: int = 1000
) -> DataFrame:
    """Exact percentiles with linear interpolation, one column per entry of *points*.

    Equal values are counted first, then the range of each group is cut into
    bins: a running count over the bins finds the bin that holds each wanted
    rank, and only that bin is ranked value by value.  A group of any size is
    thereby never gathered in one place.
    """
    known = rows.where(F.col(value).isNotNull())
    number = F.col(value).cast("double")
    counts = known.groupBy(*groups, number.alias("x")).agg(F.count("*").alias("n"))
    spans = counts.groupBy(*groups).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    share = F.when(F.col("hi") > F.col("lo"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    counts = counts.join(spans, list(groups)).withColumn("bin", F.floor(share * bins_per_group)).drop("lo", "hi")

    per_bin = counts.groupBy(*groups, "bin").agg(F.sum("n").alias("bin_n"))
    whole = Window.partitionBy(*groups)
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = per_bin.select(
        *groups,
        "bin",
        "bin_n",
        F.coalesce(F.sum("bin_n").over(below), F.lit(0)).alias("before"),
        F.sum("bin_n").over(whole).alias("total"),
    )

    rank = {name: (F.lit(float(p)) / 100) * (F.col("total") - 1).cast("double") for name, p in points.items()}
    entry = [
        F.struct(F.lit(name).alias("point"), F.floor(r).alias("low"), (r - F.floor(r)).alias("weight"))
        for name, r in rank.items()
    ]
    wanted = bins.withColumn("p", F.explode(F.array(*entry))).select(*groups, "bin", "before", "bin_n", "total", "p.*")
    wanted = wanted.withColumn("high", F.least(F.col("low") + 1, F.col("total") - 1))
    wanted = wanted.withColumn("spot", F.explode(F.array("low", "high"))).where(
        "spot >= before AND spot < before + bin_n"
    )

    upto = Window.partitionBy(*groups, "bin").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(wanted.select(*groups, "bin").distinct(), [*groups, "bin"], "left_semi")
    ranked = ranked.withColumn("upto", F.sum("n").over(upto))
    hits = wanted.join(ranked.select(*groups, "bin", "x", "n", "upto"), [*groups, "bin"]).where(
        "spot - before < upto AND spot - before >= upto - n"
    )
    ends = hits.groupBy(*groups, "point", "weight").agg(F.min("x").alias("x_low"), F.max("x").alias("x_high"))
    found = ends.withColumn("y", F.col("x_low") + (F.col("x_high") - F.col("x_low")) * F.col("weight"))
    picked = [F.max(F.when(F.col("point") == name, F.col("y"))).alias(name) for name in points]
    return found.groupBy(*groups).agg(*picked)


def bench_summary(runs: DataFrame, size: str = "source_name") -> DataFrame:
    """Median and 95th percentile of duration and rate per size, and the steady rate of runs 2 and 3."""
    rate = F.col("throughput_rows_per_sec").cast("double")
    metrics = {
        "duration": F.col("duration_ms").cast("double"),
        "rate": rate,
        "steady": F.when(F.col("run_number").isin(2, 3), rate),
    }
    entries = F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("x")) for name, value in metrics.items()])
    long = runs.select(size, F.explode(entries).alias("m")).select(size, "m.*")
    found = exact_percentiles(long, [size, "metric"], "x", {"p50": 50, "p95": 95})
    # Names of the summary's columns.
    reported = {
        "median_duration_ms_all_runs": ("duration", "p50"),
        "p95_duration_ms_all_runs": ("duration", "p95"),
        "median_rows_per_sec_all_runs": ("rate", "p50"),
        "p95_rows_per_sec_all_runs": ("rate", "p95"),
        "median_steady_state_rows_per_sec": ("steady", "p50"),
    }
    picked = [F.max(F.when(F.col("metric") == metric, F.col(point))).alias(name) for name, (metric, point) in reported.items()]
    wide = found.groupBy(size).agg(*picked)
    return wide.select(size, *[truncated(F.col(name), 4).alias(name) for name in reported])


def phase_medians(runs: DataFrame) -> DataFrame:
    """Median milliseconds of every load phase."""
    named = runs.select(*[F.col(column).cast("double").alias(name) for column, name in PHASES.items()])
    long = named.unpivot([], list(PHASES.values()), "phase", "ms")
    return exact_percentiles(long, ["phase"], "ms", {"median_ms": 50})


def dominant_phase(runs: DataFrame) -> DataFrame:
    """The phase with the largest median; on a tie the earlier phase."""
    order = F.create_map(*[part for i, name in enumerate(PHASES.values()) for part in (F.lit(name), F.lit(-i))])
    top = phase_medians(runs).agg(F.max(F.struct("median_ms", order[F.col("phase")].alias("place"), "phase")).alias("top"))
    return top.select("top.phase", truncated(F.col("top.median_ms"), 4).alias("median_ms"))

"""Run ledger as a table of events: start, completion, failure, retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitbars.operators.normalize import instant_literal
from pitbars.schemas import RUN_COLUMNS

# What to look at, what to do and what to pass on, by the error that stopped a load.
ADVICE = {
    "FeedError": (
        (
            "Compare the first line of the file with the column names of the contract.",
            "Open the file with the vendor's own reader; a changed delimiter or encoding shows there.",
            "Ask the vendor whether the layout changed on purpose.",
        ),
        (
            "Adapt the column mapping of the contract if the new layout stays.",
            "Ask for the file again if it was cut off.",
            "Start the load once more; nothing of this run was committed.",
        ),
        (
            "Hand over the file, the contract and the run_id to whoever owns the feed.",
            "Say which columns are absent and since which delivery.",
        ),
    ),
    "ConstraintError": (
        (
            "The message counts the broken rules; filter the staged rows by the same predicate.",
            "valid_window means that valid_from lies before a belief that is already on record.",
            "one_active_version means that two bars fall on one key, often by a fraction of a second.",
        ),
        (
            "Give a later valid_from, or microsecond granularity, if the bars are right.",
            "Switch the row rule on that rejects such rows before they are staged.",
        ),
        ("Show the counts and three of the rows to whoever sets the rules of the source.",),
    ),
    "ReconciliationError": (
        (
            "Read the reconciliation table of the run; only symbols with matched = false matter.",
            "Equal row counts with other checksums point to a changed value, other counts to lost keys.",
        ),
        (
            "Load the file again; readers still see the commit before this run.",
            "Keep the unseen version folder of the run until the difference is explained.",
        ),
        ("A difference that comes back is a fault of the merge: pass on the file and the table.",),
    ),
    "ConflictError": (
        ("Another load of the same source committed while this one was at work.",),
        ("Repeat this load; it will merge with what the other one left.",),
        ("If it goes on, two schedules share a source: find the owner of the second one.",),
    ),
}
OTHER = (
    ("Read the message from its last line upward; the first cause stands at the end.",),
    ("Repeat the load after the cause is gone; no reader has seen this run.",),
    ("Pass on the message, the path of the file and the run_id.",),
)


def failure_document(error_type: Column, summary: Column) -> Column:
    """Incident document of a failed run."""

    def listed(place: int) -> Column:
        lines = F.array(*map(F.lit, OTHER[place]))
        for name, advice in ADVICE.items():
            lines = F.when(error_type == name, F.array(*map(F.lit, advice[place]))).otherwise(lines)
        return lines

    return F.struct(
        error_type.alias("error_type"),
        summary.alias("summary"),
        *[listed(place).alias(name) for place, name in enumerate(("diagnosis", "mitigation", "escalation"))],
    )


def error_rate(refused: Column, read: Column) -> Column:
    """Rejected share of the rows read, six digits; 0 when nothing was read."""
    share = refused.cast("decimal(20,0)") / F.when(read > 0, read).cast("decimal(20,0)")
    return F.coalesce(F.round(share, 6), F.lit(0)).cast("decimal(9,6)")


def throughput(loaded: Column, duration_ms: Column) -> Column:
    """Rows per second, two digits; durations below a millisecond count as one."""
    millis = F.greatest(duration_ms, F.lit(1)).cast("decimal(20,0)")
    return F.round(loaded.cast("decimal(20,0)") * 1000 / millis, 2).cast("decimal(18,2)")


def with_rates(runs: DataFrame) -> DataFrame:
    """Add throughput and error rate to runs that carry their counters."""
    return runs.withColumns(
        {
            "throughput_rows_per_sec": throughput(F.col("rows_loaded"), F.col("duration_ms")),
            "error_rate": error_rate(F.col("rows_rejected"), F.col("rows_read")),
        }
    )


def state(events: DataFrame) -> DataFrame:
    """Latest event per run: the ledger as a table of runs."""
    columns = [c for c in events.columns if c not in ("run_id", "event_seq")]
    newest = F.max_by(F.struct(*columns), F.col("event_seq")).alias("row")
    kept = [c for c in events.columns if c != "event_seq"]
    return events.groupBy("run_id").agg(newest).select("run_id", "row.*").select(*kept)


def retained(runs: DataFrame, now: datetime, days: int) -> DataFrame:
    """Runs that survive a retention of *days*; the boundary instant survives."""
    return runs.where(F.col("created_at") >= retention_cutoff(now, days))


def retention_cutoff(now: datetime, days: int) -> Column:
    if days < 1:
        raise ValueError("retention must be at least one day, or the running load would delete itself")
    return instant_literal(now) - F.make_interval(days=F.lit(days))


def lookup(runs: DataFrame, run_id: str) -> DataFrame:
    """The ledger row of one run."""
    return runs.where(F.col("run_id") == run_id).select(*[c for c in RUN_COLUMNS if c in runs.columns])

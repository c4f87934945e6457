"""Table constraints as violation counts, checked before a commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitbars.schemas import KEYS, PRICES

# Allowed members of the closed domains.
ACTION_TYPES = ("split", "dividend")
RUN_STATUSES = ("running", "completed", "failed")
RECONCILIATION_STATUSES = ("not_run", "passed", "failed")


# Stands for the end of a belief that has none.
ENDLESS = "9999-12-31 00:00:00"


class ConstraintError(RuntimeError):
    """Rows about to be committed break a table constraint."""

    def __init__(self, violations: dict[str, int]) -> None:
        self.violations = violations
        listed = ", ".join(f"{rule}={count}" for rule, count in sorted(violations.items()))
        super().__init__(f"constraint violations: {listed}")


def bar_rules() -> dict[str, Column]:
    """Violation predicate per constraint on a landed bar."""
    required = (*KEYS, *PRICES, "volume", "currency")
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    unpriced = F.coalesce(F.col("adjusted_close") <= 0, F.lit(False))
    for name in PRICES:
        unpriced = unpriced | (F.col(name) <= 0)
    return {
        "not_null": missing,
        "positive_prices": unpriced,
        "non_negative_volume": F.col("volume") < 0,
        "high_low_envelope": (F.col("high_price") < F.greatest(*PRICES))
        | (F.col("low_price") > F.least(*PRICES)),
        "currency_length": F.length("currency") != 3,
    }


def version_rules() -> dict[str, Column]:
    """Bar rules plus the order of the knowledge interval."""
    return {**bar_rules(), "valid_window": F.col("valid_to") <= F.col("valid_from")}


def action_rules() -> dict[str, Column]:
    """Violation predicate per constraint on a corporate action."""
    kind = F.col("action_type")
    return {
        "action_type": ~F.coalesce(kind.isin(*ACTION_TYPES), F.lit(False)),
        "split_ratio": (kind == "split") & ~F.coalesce(F.col("split_ratio") > 0, F.lit(False)),
        "dividend_amount": (kind == "dividend") & ~F.coalesce(F.col("dividend_amount") >= 0, F.lit(False)),
    }


def run_rules() -> dict[str, Column]:
    """Violation predicate per constraint on a ledger row."""
    return {
        "status": ~F.coalesce(F.col("status").isin(*RUN_STATUSES), F.lit(False)),
        "reconciliation_status": ~F.coalesce(
            F.col("reconciliation_status").isin(*RECONCILIATION_STATUSES), F.lit(False)
        ),
    }


def violation_columns(rules: dict[str, Column]) -> list[Column]:
    """Aggregates counting each rule's violations; usable in ``agg`` and ``observe``."""
    return [F.count_if(F.coalesce(broken, F.lit(False))).alias(rule) for rule, broken in rules.items()]


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with its violation count; one pass, no shuffle of rows."""
    counted = rows.agg(*violation_columns(rules))
    return counted.unpivot([], list(rules), "rule", "violations")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (map-side combined)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_active(versions: DataFrame) -> DataFrame:
    """Keys with more than one active version; must be empty."""
    return duplicate_keys(versions.where(F.col("valid_to").isNull()), KEYS)


def overlapping_intervals(versions: DataFrame) -> DataFrame:
    """Versions that begin while an earlier one of their key is still believed, with the time up to which
    one is (NULL: without end). Bulk as-of reads rely on there being none.

    A sweep over each key's versions by their begin, with the latest end so far; empty and backward
    intervals are left to the rules of a row. One shuffle by key, which no popular symbol gathers.
    """
    held = versions.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    end = F.coalesce(F.col("valid_to"), F.lit(ENDLESS).cast("timestamp"))
    before = Window.partitionBy(*KEYS).orderBy("valid_from", end).rowsBetween(Window.unboundedPreceding, -1)
    swept = held.withColumn("held_until", F.max(end).over(before)).where(F.col("held_until") > F.col("valid_from"))
    return swept.select(*KEYS, "valid_from", "valid_to", F.nullif("held_until", F.lit(ENDLESS).cast("timestamp")).alias("held_until"))


def duplicate_actions(actions: DataFrame) -> DataFrame:
    return duplicate_keys(actions, ("source_name", "symbol", "action_date", "action_type"))


def duplicate_runs(runs: DataFrame) -> DataFrame:
    """Run ids recorded more than once; must be empty."""
    return duplicate_keys(runs, ("run_id",))


def demand(counts: dict[str, int]) -> None:
    """Raise when any rule was broken."""
    broken = {rule: int(count) for rule, count in counts.items() if count}
    if broken:
        raise ConstraintError(broken)


def demand_run(event: dict) -> None:
    """A ledger event whose states are known."""
    demand(
        {
            "status": int(event["status"] not in RUN_STATUSES),
            "reconciliation_status": int(event["reconciliation_status"] not in RECONCILIATION_STATUSES),
        }
    )


def demand_actions(actions: DataFrame) -> DataFrame:
    """Actions that are proven to satisfy their constraints."""
    counts = actions.agg(*violation_columns(action_rules())).first().asDict()
    counts["unique_action"] = duplicate_actions(actions).count()
    demand(counts)
    return actions

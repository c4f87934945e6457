"""One load: read, validate, merge, reconcile, commit, record."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from time import perf_counter
from uuid import uuid4

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pitbars.contract import FeedContract, pick
from pitbars.operators import checks, ledger
from pitbars.operators.merge import CHANGE, changed_slots, first_load, merge_active
from pitbars.operators.normalize import REASON, VENDOR_ROW, accepted, dedupe_last, rejected, stage, tag
from pitbars.operators.reconcile import ReconciliationError, reconcile, verdict
from pitbars.schemas import KEYS, RUN_COLUMNS, VERSION_COLUMNS
from pitbars.session import require_utc
from pitbars.sources.feed import FILE_ORDER, read_feed, write_rejections
from pitbars.sources.store import SLOT, ConflictError, Store, bucket, price_month

CHANGES = ("carried", "inserted", "closed", "corrected", "unchanged")


@dataclass(frozen=True)
class LoadReport:
    """Ledger row of the run, plus what the merge did and where rejects went."""

    run: dict
    changes: dict
    rejection_path: str | None
    retention_rows_deleted: int


class _Run:
    """Facts of one run as they become known; always enough for a ledger row."""

    def __init__(self, contract: FeedContract, path: str, now: datetime) -> None:
        self.began = perf_counter()
        self.mark = self.began
        self.facts = dict.fromkeys(RUN_COLUMNS)
        self.facts.update(
            run_id=str(uuid4()), source_name=contract.name, file_path=path, status="running",
            started_at=now, created_at=datetime.now(timezone.utc), rows_read=0, rows_valid=0, rows_loaded=0, rows_rejected=0,
            duplicates_dropped=0, throughput_rows_per_sec=Decimal(0), error_rate=Decimal(0),
            csv_parse_ms=0, transform_ms=0, copy_ms=0, upsert_ms=0,
            reconciliation_status="not_run", reconciliation="{}", failure_summary="{}",
        )

    def lap(self, phase: str) -> None:
        now = perf_counter()
        self.facts[phase] = int((now - self.mark) * 1000)
        self.mark = now

    def finish(self, status: str) -> dict:
        facts = self.facts
        facts["status"] = status
        facts["finished_at"] = datetime.now(timezone.utc)
        facts["duration_ms"] = int((perf_counter() - self.began) * 1000)
        read, refused = facts["rows_read"], facts["rows_rejected"]
        if read:
            facts["error_rate"] = (Decimal(refused) / read).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        if status == "completed":
            rate = Decimal(facts["rows_loaded"]) * 1000 / max(facts["duration_ms"], 1)
            facts["throughput_rows_per_sec"] = rate.quantize(Decimal("0.01"), ROUND_HALF_UP)
        return facts


def run_feeds(store: Store, contracts: Iterable[FeedContract], name: str | None = None, **options) -> list[LoadReport]:
    """Load the chosen feeds in order; the first failure stops the rest."""
    return [run_feed(store, contract, **options) for contract in pick(contracts, name)]


def run_feed(
    store: Store,
    contract: FeedContract,
    now: datetime | None = None,
    valid_from: datetime | None = None,
    retention_days: int = 90,
    rejection_folder: str | None = None,
) -> LoadReport:
    """Load one CSV feed.  On any error the run is recorded as failed and the error re-raised.

    Retention runs after the record: its failure is raised but does not undo it.
    """
    require_utc(store.spark)
    contract.checked()
    ledger.retention_cutoff(datetime.now(timezone.utc), retention_days)
    now = now or datetime.now(timezone.utc)
    run = _Run(contract, str(contract.path), now)
    store.log(run.facts, 0)
    try:
        raw = read_feed(store.spark, contract.path)
        run.lap("csv_parse_ms")
        changes, path = _load(store, contract, raw, run, now, valid_from or now, rejection_folder)
        run.finish("completed")
    except Exception as error:
        if isinstance(error, ReconciliationError):
            run.facts["reconciliation_status"] = "failed"
            run.facts["reconciliation"] = json.dumps(error.summary, sort_keys=True)
        run.facts["rows_loaded"] = 0
        run.facts["error_message"] = str(error)
        run.facts["failure_summary"] = _failure_json(store, error)
        store.log(run.finish("failed"), 1)
        raise
    store.log(run.facts, 1)
    store.remove(store.work_folder(run.facts["run_id"]))
    pruned = store.prune_runs(retention_days)
    return LoadReport(dict(run.facts), changes, path, pruned)


def _failure_json(store: Store, error: BaseException) -> str:
    document = ledger.failure_document(F.lit(type(error).__name__), F.lit(str(error)))
    return store.spark.range(1).select(F.to_json(document).alias("d")).first()["d"]


def _load(
    store: Store, contract: FeedContract, raw: DataFrame, run: _Run, now: datetime, valid_from: datetime,
    rejection_folder: str | None,
) -> tuple[dict, str | None]:
    spark, facts = store.spark, run.facts
    work = store.work_folder(facts["run_id"])
    head = store.head(contract.name)

    # The tagged rows are written once: the CSV is parsed once, and a lost
    # executor later costs a Parquet read instead of the whole lineage.
    seen = Observation()
    good = F.col(REASON) == ""
    tagged = tag(raw, contract, now, FILE_ORDER)
    tagged.observe(
        seen, F.count("*").alias("read"), F.count_if(~good).alias("refused")
    ).withColumn(VENDOR_ROW, F.when(~good, F.col(VENDOR_ROW))).write.parquet(f"{work}/tagged")
    facts["rows_read"], facts["rows_rejected"] = seen.get["read"], seen.get["refused"]
    tagged = spark.read.parquet(f"{work}/tagged")
    path = write_rejections(
        rejected(tagged), rejection_folder or f"{store.root}/rejections",
        contract.name, facts["run_id"], facts["rows_rejected"],
    )
    run.lap("transform_ms")

    if facts["rows_read"] == facts["rows_rejected"]:
        return _passed_empty(facts), path
    staged, months = _stage(store, contract, tagged, f"{work}/staged", facts)
    run.lap("copy_ms")

    folder, changes, kept = _merge(store, contract, staged, months, valid_from, now, facts["run_id"])
    run.lap("upsert_ms")

    active = store.read(kept)
    if folder:
        active = active.select(*VERSION_COLUMNS).unionByName(store.written(folder).where("state = 'active'").select(*VERSION_COLUMNS))
    per_symbol = reconcile(staged, active)
    report = f"{store.root}/reconciliation/run_id={facts['run_id']}"
    per_symbol.write.parquet(report)
    summary = verdict(spark.read.parquet(report)).first().asDict()
    if summary["status"] != "passed":
        raise ReconciliationError(summary)
    if folder:
        store.commit(folder, contract.name, head)
    elif store.head(contract.name) != head:
        raise ConflictError(f"another load of {contract.name!r} committed after {head}")
    facts["rows_loaded"] = facts["rows_valid"]
    facts["reconciliation_status"] = "passed"
    facts["reconciliation"] = json.dumps(summary, sort_keys=True)
    return changes, path


def _passed_empty(facts: dict) -> dict:
    """An empty load changes nothing and counts as reconciled."""
    summary = {"status": "passed", "source_total_rows": 0, "landed_total_rows": 0, "symbols": 0, "mismatched_symbols": 0}
    facts["reconciliation_status"] = "passed"
    facts["reconciliation"] = json.dumps(summary, sort_keys=True)
    return dict.fromkeys(CHANGES, 0)


def _stage(
    store: Store, contract: FeedContract, tagged: DataFrame, path: str, facts: dict
) -> tuple[DataFrame, list[int]]:
    """Deduplicated bars in landing types, written and checked."""
    counted, checked = Observation(), Observation()
    split = F.col("price_ts") != F.date_trunc("second", "price_ts")
    bars = dedupe_last(accepted(tagged, FILE_ORDER), FILE_ORDER)
    bars = bars.observe(counted, F.count("*").alias("valid"), F.count_if(split).alias("split"))
    rows = stage(bars, contract).observe(checked, *checks.violation_columns(checks.bar_rules()))
    rows.withColumn("price_month", price_month()).write.parquet(path)
    facts["rows_valid"] = counted.get["valid"]
    facts["duplicates_dropped"] = facts["rows_read"] - facts["rows_rejected"] - facts["rows_valid"]
    checks.demand(checked.get)
    staged = store.spark.read.parquet(path)
    if counted.get["split"] and contract.granularity == "second":
        # Only fractions of a second can make two bars share a landing key.
        checks.demand({"one_active_version": checks.duplicate_keys(staged, KEYS).count()})
    months = [row["price_month"] for row in staged.select("price_month").distinct().collect()]
    return staged, sorted(months)


def _merge(
    store: Store, contract: FeedContract, staged: DataFrame, months: list[int], valid_from: datetime, now: datetime,
    load_id: str,
) -> tuple[str | None, dict, list[str]]:
    """Merge into the slots that change, and write the result unseen by readers.

    Returns the written folder (none if the feed says nothing new), the changes
    and the folders of the touched months that stay in force.
    """
    rules = checks.violation_columns(checks.version_rules())
    tally = [F.count_if(F.col(CHANGE) == change).alias(change) for change in CHANGES]
    held = store.in_force(contract.name, "active", months).select(*SLOT, "folder", "rows").collect()
    slots: dict[tuple, int] = {}
    for row in held:
        slots[row["price_month"], row["bucket"]] = slots.get((row["price_month"], row["bucket"]), 0) + row["rows"]
    changes = dict.fromkeys(CHANGES, 0)
    if held:
        # One join tells which slots change; the others are not written again.
        active = store.read(sorted(row["folder"] for row in held))
        changed, same = set(), {}
        for row in changed_slots(active, staged.withColumn("bucket", bucket())).collect():
            slot = row["price_month"], row["bucket"]
            same[slot] = row["same"]
            if row["differing"]:
                changed.add(slot)
        for slot in slots.keys() - changed:
            changes["unchanged"] += same.get(slot, 0)
            changes["carried"] += slots[slot] - same.get(slot, 0)
        kept = sorted({row["folder"] for row in held if (row["price_month"], row["bucket"]) not in changed})
        if not changed:
            return None, changes, kept
        in_slots = F.concat_ws("/", price_month().cast("string"), bucket().cast("string")).isin(*[f"{m}/{b}" for m, b in sorted(changed)])
        active = store.read(sorted({row["folder"] for row in held} - set(kept)))
        merged = merge_active(active.select(*VERSION_COLUMNS), staged.where(in_slots), valid_from, now)
    else:
        kept = []
        merged = first_load(staged, valid_from, now).withColumn(CHANGE, F.lit("inserted"))
    merged_rows = Observation()
    folder = store.write_versions(merged, contract.name, load_id, (merged_rows, *tally, *rules))
    seen = merged_rows.get
    checks.demand({rule: count for rule, count in seen.items() if rule not in CHANGES})
    return folder, {change: changes[change] + seen[change] for change in CHANGES}, kept

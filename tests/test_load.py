"""Whole loads against a store on disk, ledger and monitoring."""

import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitbars.contract import MANDATORY, ContractError, FeedContract
from pitbars.operators import checks, ledger, merge, monitor
from pitbars.operators.normalize import FeedError
from pitbars.operators.reconcile import ReconciliationError
from pitbars.plans import load as load_plan
from pitbars.plans.load import run_feed, run_feeds
from pitbars.schemas import ACTION
from pitbars.sources.feed import FILE_ORDER, UnbalancedQuotes, feed_footprint, read_feed, synthetic_feed
from pitbars.sources.store import ConflictError, Store

HEADER = "symbol,timestamp,open,high,low,close,volume,adjusted_close,currency\r\n"
NOW = datetime(2026, 4, 10, tzinfo=timezone.utc)


def write(folder, *lines):
    path = folder / "feed.csv"
    path.write_bytes((HEADER + "".join(line + "\r\n" for line in lines)).encode())
    return str(path)


def line(symbol="AAPL", ts="2026-04-01 09:30:00", close="100", volume="5"):
    return f"{symbol},{ts},{close},{close},{close},{close},{volume},{close},USD"


def test_load_correct_reload_and_adjust(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    contract = FeedContract("feed one/é", "America/New_York", path=write(
        tmp_path, line(), line(), line("NA"), line("msft", ts="oops"), line("MSFT", "2026-03-31 09:30:00", "7")))
    first = run_feed(store, contract, NOW, NOW)
    facts = ("rows_read", "rows_valid", "rows_rejected", "duplicates_dropped", "rows_loaded", "status")
    assert [first.run[f] for f in facts] == [5, 3, 1, 1, 3, "completed"]
    assert first.changes["inserted"] == 3
    refused = spark.read.option("header", True).csv(first.rejection_path).collect()
    assert [(r["symbol"], r["rejection_reason"]) for r in refused] == [("msft", "invalid_timestamp")]

    day = timedelta(days=1)
    again = run_feed(store, contract, NOW + day, NOW + day)
    assert (again.changes["unchanged"], again.run["rows_loaded"]) == (3, 3)
    write(tmp_path, line(close="101.25"))
    run_feed(store, contract, NOW + 2 * day, NOW + 2 * day)
    assert merge.version_counts(store.versions()).first().asDict() == {"total_versions": 4, "active_versions": 3}
    assert store.current(contract.name, [202603]).count() == 1
    bar_ts = datetime(2026, 4, 1, 13, 30)
    believed = [store.price_as_of(contract.name, "aapl", bar_ts, NOW + n * day).first() for n in (-1, 0, 1, 2)]
    assert [b and str(b["close_price"]) for b in believed] == [None, "100.000000", "100.000000", "101.250000"]
    assert store.runs().count() == 3
    row = store.run(first.run["run_id"])
    assert row["error_rate"] == Decimal("0.200000") and json.loads(row["reconciliation"])["status"] == "passed"
    assert store.reconciliation(first.run["run_id"]).count() == 3
    with pytest.raises(LookupError):
        store.run("none")

    split = spark.createDataFrame(
        [(contract.name, "AAPL", datetime(2026, 4, 3).date(), "split", Decimal(2), None, "USD", None)], ACTION)
    store.add_actions(split)
    with pytest.raises(checks.ConstraintError):
        store.add_actions(split)
    assert store.recompute_adjusted_close(contract.name, "aapl", NOW) == 2
    adjusted = {(r["symbol"], str(r["close_price"])): str(r["adjusted_close"]) for r in store.versions().collect()}
    assert adjusted[("AAPL", "100.000000")] == "50.000000" and adjusted[("AAPL", "101.250000")] == "50.625000"
    assert adjusted[("MSFT", "7.000000")] == "7.000000" and len(adjusted) == 4
    # The vendor's file contradicts the adjusted value and becomes a new belief.
    assert run_feed(store, contract, NOW + 3 * day, NOW + 3 * day).changes["corrected"] == 1

    store.clear()
    assert store.versions().count() == 0 and store.runs().count() == 0


def test_failures_leave_the_table_alone(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    contract = FeedContract("feed", "UTC", path=write(tmp_path, line()))
    run_feed(store, contract, NOW, NOW)
    write(tmp_path, line(close="2"))
    with pytest.raises(checks.ConstraintError, match="valid_window"):
        run_feed(store, contract, NOW, NOW - timedelta(days=1))
    write(tmp_path, line(ts="2026-04-01 09:30:00.1"), line(ts="2026-04-01 09:30:00.2"))
    with pytest.raises(checks.ConstraintError, match="one_active_version"):
        run_feed(store, contract, NOW, NOW)
    write(tmp_path, line(close="0.0000001"))
    with pytest.raises(checks.ConstraintError, match="positive_prices"):
        run_feed(store, contract, NOW, NOW)
    write(tmp_path, line(close="3"))
    with monkeypatch.context() as patch:
        real = load_plan.reconcile
        patch.setattr(load_plan, "reconcile", lambda s, v: real(s.withColumn("volume", F.lit(1).cast("bigint")), v))
        with pytest.raises(ReconciliationError):
            run_feed(store, contract, NOW, NOW + timedelta(days=1))
    with pytest.raises(FeedError):
        run_feed(store, FeedContract("feed", "UTC", path=str(tmp_path / "feed.csv"), columns={
            c: c for c in ("symbol", "timestamp", "open", "high", "low", "close", "volume", "currency")} | {"adjusted_close": "adj"}), NOW)
    assert [str(r["close_price"]) for r in store.versions().collect()] == ["100.000000"]
    states = {r["error_message"] and r["error_message"].split(":")[0]: r["status"] for r in store.runs().collect()}
    assert sorted(states.values()).count("failed") == len(states) - 1
    failed = store.runs().where("reconciliation_status = 'failed'").first()
    document = json.loads(failed["failure_summary"])
    assert document["error_type"] == "ReconciliationError" and failed["rows_loaded"] == 0
    assert all(document[k] for k in ("summary", "diagnosis", "mitigation", "escalation"))
    with pytest.raises(ConflictError):
        store.commit(store.write_versions(store.versions(), "feed", "stale"), "feed", head=0)


def test_empty_feed_passes_and_sources_run_in_order(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    empty = FeedContract("empty", "UTC", path=write(tmp_path))
    broken = FeedContract("broken", "UTC", path=str(tmp_path / "absent.csv"))
    report = run_feed(store, empty, NOW)
    assert report.run["reconciliation_status"] == "passed" and report.run["rows_read"] == 0
    with pytest.raises(Exception):
        run_feeds(store, [broken, empty], now=NOW)
    assert sorted(r["status"] for r in store.runs().collect()) == ["completed", "failed"]
    with pytest.raises(ContractError):
        run_feeds(store, [empty], "other")


def record(store, run, run_id, days):
    """A finished run recorded some days ago."""
    facts = {**run, "run_id": run_id, "created_at": datetime.now(timezone.utc) - timedelta(days=days)}
    store.log({**facts, "status": "running"}, 0)
    store.log(facts, 1)


def test_retention_deletes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    contract = FeedContract("feed", "UTC", path=write(tmp_path, line()))
    first = run_feed(store, contract, NOW, NOW)
    record(store, first.run, "old", 91)
    record(store, first.run, "young", 89)
    # A backfill that says it is long ago is recorded now.
    late = run_feed(store, contract, NOW - timedelta(days=400), NOW + timedelta(days=1))
    assert late.retention_rows_deleted == 1 and store.run(late.run["run_id"])["status"] == "completed"
    assert {r["run_id"] for r in store.runs().collect()} == {first.run["run_id"], "young", late.run["run_id"]}
    assert spark.read.parquet(f"{store.root}/ledger/*").where("run_id = 'old'").count() == 0
    with pytest.raises(ValueError):
        ledger.retained(store.runs(), NOW, 0)
    with pytest.raises(ValueError):
        run_feed(store, contract, NOW, NOW, retention_days=0)
    assert store.runs().count() == 3 and store.head("feed") == 1

    store.clear()
    assert store.runs().count() == 0 and store.versions().count() == 0
    again = run_feed(store, contract, NOW, NOW)
    assert store.run(again.run["run_id"])["rows_loaded"] == 1 and store.versions().count() == 1


def test_a_failed_retention_keeps_the_record(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    monkeypatch.setattr(store, "prune_runs", lambda days: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_feed(store, FeedContract("feed", "UTC", path=write(tmp_path, line())), NOW, NOW)
    row = store.runs().first()
    assert (row["status"], row["rows_loaded"], store.versions().count()) == ("completed", 1, 1)


def test_ledger_constraints_on_write(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run = run_feed(store, FeedContract("feed", "UTC", path=write(tmp_path, line())), NOW, NOW).run
    with pytest.raises(checks.ConstraintError, match="unique_run"):
        store.log(run, 0)
    with pytest.raises(checks.ConstraintError, match="status"):
        store.log({**run, "run_id": "x", "status": "crashed"}, 0)


def test_only_changed_slots_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = [line(s, f"2026-0{m}-02 09:30:00") for s in ("A", "B", "C", "D", "E", "F", "G", "H") for m in (1, 2, 3)]
    contract = FeedContract("feed", "UTC", path=write(tmp_path, *rows))
    run_feed(store, contract, NOW, NOW)
    before = store.folders()
    day = timedelta(days=1)
    again = run_feed(store, contract, NOW, NOW + day)
    assert again.changes == {"carried": 0, "inserted": 0, "closed": 0, "corrected": 0, "unchanged": 24}
    assert store.folders() == before and store.head("feed") == 1
    write(tmp_path, line("A", "2026-02-02 09:30:00", "7"), line("B", "2026-01-02 09:30:00"))
    some = run_feed(store, contract, NOW, NOW + 2 * day)
    assert some.changes == {"carried": 14, "inserted": 0, "closed": 1, "corrected": 1, "unchanged": 1}
    fresh = set(store.folders()) - set(before)
    assert len(fresh) == 2 and all("price_month=202602/bucket=" in f for f in fresh)
    assert merge.version_counts(store.versions()).first().asDict() == {"total_versions": 25, "active_versions": 24}
    assert store.snapshot_as_of(NOW + day).where("close_price = 7").count() == 0
    assert store.snapshot_as_of(NOW + 3 * day).where("close_price = 7").count() == 1
    # Folders of later knowledge, or of beliefs that ended before, are left alone.
    assert not fresh & set(store.folders(as_of=NOW - day)) and len(store.folders(as_of=NOW + 3 * day)) == len(before)
    write(tmp_path, line("A", "2026-02-02 09:30:00", "8"))
    run_feed(store, contract, NOW, NOW + 4 * day)
    assert store.compact_closed("feed") == 2 and len(store.folders("feed", "closed")) == 1
    assert merge.version_counts(store.versions()).first().asDict() == {"total_versions": 26, "active_versions": 24}


def test_writers_of_one_source_and_of_two(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    one = FeedContract("one", "UTC", path=write(tmp_path, line()))
    run_feed(store, one, NOW, NOW)
    folders = [store.write_versions(store.versions(), "one", name) for name in ("x", "y")]
    with monkeypatch.context() as patch:
        patch.setattr(store, "head", lambda source: 1)  # both looked before either committed
        assert store.commit(folders[0], "one", 1) == 2
        with pytest.raises(ConflictError):
            store.commit(folders[1], "one", 1)
    assert checks.duplicate_active(store.versions()).count() == 0 and store.head("one") == 2
    # A load of another source that commits in between does not stop this one.
    real = load_plan.reconcile

    def meanwhile(staged, versions):
        monkeypatch.setattr(load_plan, "reconcile", real)
        run_feed(store, FeedContract("two", "UTC", path=one.path), NOW, NOW)
        return real(staged, versions)

    write(tmp_path, line(close="5"))
    monkeypatch.setattr(load_plan, "reconcile", meanwhile)
    run_feed(store, one, NOW, NOW + timedelta(days=1))
    assert store.current("one").count() == 1 and store.current("two").count() == 1


def test_vendor_headers_as_they_come(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("raw,Time (x),a.open,high,low,close,vol`ume,Adj. Close,ccy\nAAPL,2026-04-01 09:30:00,1,1,1,1,5,1,USD\nMSFT,oops,1,1,1,1,5,1,USD\n")
    columns = {"symbol": "raw", "timestamp": "Time (x)", "open": "a.open", "high": "high", "low": "low", "close": "close",
               "volume": "vol`ume", "adjusted_close": "Adj. Close", "currency": "ccy"}
    store = Store(spark, str(tmp_path / "store"))
    report = run_feed(store, FeedContract("odd", "UTC", path=str(path), columns=columns), NOW, NOW)
    assert (report.run["rows_valid"], report.run["rows_rejected"]) == (1, 1)
    refused = spark.read.option("header", True).csv(report.rejection_path)
    assert set(refused.columns) == {*columns.values(), "rejection_reason"}


def test_line_breaks_within_quoted_cells(spark, tmp_path):
    header = ",".join([*MANDATORY, "adjusted_close", "note"]) + "\n"
    bar = "AAPL,2026-04-01 13:30:00,1,1,1,1,10,USD,1,"
    (tmp_path / "a.csv").write_text(header + bar + '"two\nlines, and ""quotes"""\n' + bar.replace("13:30", "13:31") + '"plain ""a,"",b"\n')
    (tmp_path / "b.csv").write_text(header + bar.replace("13:30", "13:32") + 'five" wide\n' + bar.replace("13:30", "13:33") + "\n")
    rows = read_feed(spark, str(tmp_path)).orderBy(*FILE_ORDER).collect()
    assert [(r["timestamp"][11:16], r["note"]) for r in rows] == [
        ("13:30", 'two\nlines, and "quotes"'), ("13:31", 'plain "a,",b'), ("13:32", 'five" wide'), ("13:33", None),
    ]
    store = Store(spark, str(tmp_path / "store"))
    report = run_feed(store, FeedContract("feed", "UTC", path=str(tmp_path / "a.csv")), NOW, NOW)
    assert (report.run["rows_read"], report.run["rows_rejected"], store.versions().count()) == (2, 0, 2)
    (tmp_path / "c.csv").write_text(header + bar + '"never closed\n' + bar + "x\n")
    with pytest.raises(UnbalancedQuotes, match="c.csv"):
        run_feed(store, FeedContract("feed", "UTC", path=str(tmp_path / "c.csv")), NOW, NOW)
    assert store.runs().where("status = 'failed'").count() == 1 and store.head("feed") == 1


def test_an_event_written_during_retention_survives(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    run = run_feed(store, FeedContract("feed", "UTC", path=write(tmp_path, line())), NOW, NOW).run
    at = datetime.now(timezone.utc).replace(hour=12)
    for name, age in (("old", timedelta(days=95)), ("early", timedelta(days=90, hours=3)), ("late", timedelta(days=90) - timedelta(hours=3))):
        store.log({**run, "run_id": name, "created_at": at - age}, 0)
    append, between = store._append, []

    def meanwhile(events, mode="append"):
        if mode == "overwrite":
            between.append(1)
            Store(spark, store.root).log({**run, "run_id": "new", "status": "running", "created_at": at}, 0)
        append(events, mode)

    monkeypatch.setattr(store, "_append", meanwhile)
    assert store.prune_runs(90, at) == 2 and between == [1]
    assert {r["run_id"] for r in store.runs().collect()} == {run["run_id"], "late", "new"}
    assert store.prune_runs(90, at) == 0


def test_file_order_and_footprint(spark, tmp_path):
    path = write(tmp_path, *[line(close=str(n)) for n in range(1, 40)])
    rows = read_feed(spark, path).orderBy(*FILE_ORDER).collect()
    assert [r["close"] for r in rows] == [str(n) for n in range(1, 40)]
    size = feed_footprint(spark, path).first()
    data = (tmp_path / "feed.csv").read_bytes()
    body = len(data) - len(HEADER)
    assert (size["column_count"], size["rows"], size["file_bytes"]) == (9, 39, len(data))
    assert size["average_bytes_per_row"] == int(body / 39 * 10_000) / 10_000


def test_synthetic_feed(spark):
    rows = synthetic_feed(spark.range(25), "id").collect()
    assert tuple(rows[0]) == ("AAPL", "2026-04-01 09:30:00", "100.00", "101.25", "99.15", "100.35", "100000", "100.35", "USD")
    assert tuple(rows[21])[:3] == ("MSFT", "2026-04-01 09:32:00", "102.10")


def test_percentiles_match_published_rounding(spark):
    runs = spark.createDataFrame(
        [("100k", 1, 7363, 13581.42), ("100k", 2, 6626, 15092.06), ("100k", 3, 6771, 14768.87),
         ("500k", 1, 36580, 13668.67), ("500k", 2, 33452, 14946.79), ("500k", 3, 33126, 15093.88)],
        "source_name string, run_number int, duration_ms long, throughput_rows_per_sec double")
    found = {r["source_name"]: r.asDict() for r in monitor.bench_summary(runs).collect()}
    assert found["100k"]["median_duration_ms_all_runs"] == 6771.0
    assert found["100k"]["p95_duration_ms_all_runs"] == 7303.8
    assert found["100k"]["median_steady_state_rows_per_sec"] == 14930.465
    assert found["500k"]["p95_duration_ms_all_runs"] == 36267.2
    assert found["500k"]["p95_rows_per_sec_all_runs"] == 15079.1709


def test_truncated_goes_toward_zero(spark):
    rows = spark.createDataFrame([(1.23456,), (-1.23456,)], "x double")
    assert [r[0] for r in rows.select(monitor.truncated(F.col("x"), 3)).collect()] == [1.234, -1.234]

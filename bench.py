"""Bench: whole loads and reads over the order lines of one scale factor.

Prints one JSON line.  ``load_*`` are complete loads (CSV scan, validation,
merge, reconciliation, commit, ledger): into an empty table, of the same file
again, and of a file that restates part of the bars.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pitbars.contract import FeedContract
from pitbars.operators import adjust, asof, monitor, normalize, reconcile
from pitbars.plans import inputs as I
from pitbars.plans.load import run_feed
from pitbars.session import local_session
from pitbars.sources.feed import FILE_ORDER, read_feed
from pitbars.sources.store import Store

# Median steady rows per second of the single-node baseline at 500k rows.
BASELINE_ROWS_PER_SEC = 15020.335


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    root = tempfile.mkdtemp(prefix="pitbars-bench-")
    for name, restated in (("first", False), ("restated", True)):
        feed = I.feed(spark, sf_dir, restated).drop(*I.ORDER)
        feed.write.option("header", True).csv(f"{root}/{name}")

    store = Store(spark, f"{root}/store")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def load(label: str, file: str, at: datetime) -> None:
        contract = FeedContract("vendor_a", "UTC", path=f"{root}/{file}")
        start = time.perf_counter()
        report = run_feed(store, contract, now=I.NOW, valid_from=at)
        seconds[label] = time.perf_counter() - start
        rows[label] = report.run["rows_read"]

    def read(label: str, build) -> None:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds[label] = time.perf_counter() - start

    load("load_cold", "first", I.FIRST_LOAD)
    load("load_noop", "first", I.FIRST_LOAD + timedelta(days=1))
    load("load_restated", "restated", I.RESTATED)

    contract = FeedContract("vendor_a", "UTC", path=f"{root}/first")
    versions, actions, runs = store.versions(), I.actions(spark, sf_dir), I.runs(spark, sf_dir)
    days = F.make_dt_interval(days=(F.col("volume") / 100).cast("int"))
    asked = store.current().select(
        "source_name", "symbol", "price_ts", (normalize.instant_literal(datetime(2023, 12, 20)) + days).alias("as_of")
    )
    read("validate_dedupe", lambda: normalize.normalize(read_feed(spark, contract.path), contract, FILE_ORDER, I.NOW))
    read("snapshot_as_of", lambda: asof.snapshot_as_of(versions, datetime(2024, 1, 20)))
    read("price_as_of_bulk", lambda: asof.price_as_of_many(versions, asked))
    read("adjusted_close", lambda: adjust.adjust_close(versions, actions))
    read("symbol_digest", lambda: reconcile.symbol_checksums(store.current()))
    read("symbol_md5", lambda: reconcile.symbol_checksums(store.current(), "md5"))
    read("runs_daily_trend", lambda: monitor.daily_trend(runs))
    read("bench_summary", lambda: monitor.bench_summary(runs))

    rates = {label: round(rows[label] / seconds[label], 1) for label in rows}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {label: round(value, 3) for label, value in seconds.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "rows_loaded": rows,
                "rows_per_sec": rates,
                "baseline_rows_per_sec": BASELINE_ROWS_PER_SEC,
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

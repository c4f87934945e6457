"""Merge, as-of, reconciliation, adjustment."""

import random
from datetime import datetime, timedelta
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitbars.operators import adjust, asof, checks, merge, reconcile
from pitbars.schemas import ACTION, BAR, KEYS, VERSION_COLUMNS

BAR_TS = datetime(2026, 4, 1, 13, 30)
FIRST, SECOND = datetime(2026, 4, 2, 12), datetime(2026, 4, 3, 12)


def bar(symbol="AAPL", ts=BAR_TS, close="100", source="feed", adjusted=None):
    price = Decimal(close)
    value = price if adjusted is None else Decimal(adjusted)
    return (source, symbol, ts, price, price, price, price, 1000, value, "USD")


def bars(spark, *rows):
    # Naive datetimes are local to Python, so instants are written as text.
    text = [(r[0], r[1], r[2].isoformat(sep=" "), *r[3:]) for r in rows]
    columns = ", ".join(
        f"{f.name} {'string' if f.name == 'price_ts' else f.dataType.simpleString()}" for f in BAR.fields
    )
    return spark.createDataFrame(text, columns).withColumn("price_ts", F.col("price_ts").cast("timestamp"))


def shown(frame, *columns):
    return [tuple(r) for r in frame.select(*[F.col(c).cast("string") for c in columns]).orderBy(*columns).collect()]


def test_restatement_keeps_prior_belief(spark):
    versions = merge.first_load(bars(spark, bar()), FIRST)
    versions = merge.temporal_merge(versions, bars(spark, bar(close="101.25")), SECOND)

    def close(moment):
        return [r["close_price"] for r in asof.price_as_of(versions, "feed", "aapl", BAR_TS, moment).collect()]

    assert close(FIRST) == [Decimal("100.000000")]
    assert close(SECOND) == [Decimal("101.250000")]
    assert close(FIRST - timedelta(seconds=1)) == []
    assert merge.version_counts(versions, "source_name").first()[1:] == (2, 1)


def test_merge_cases(spark):
    held = merge.first_load(bars(spark, bar("A"), bar("B"), bar("C")), FIRST)
    sent = bars(spark, bar("A"), bar("B", close="2"), bar("D"))
    merged = merge.merge_active(held, sent, SECOND)
    assert sorted((r["change"], r["symbol"]) for r in merged.collect()) == [
        ("carried", "C"), ("closed", "B"), ("corrected", "B"), ("inserted", "D"), ("unchanged", "A"),
    ]
    after = merge.temporal_merge(held, sent, SECOND)
    assert checks.duplicate_active(after).count() == 0
    again = merge.temporal_merge(after, sent, SECOND + timedelta(days=1))
    assert shown(again, *VERSION_COLUMNS) == shown(after, *VERSION_COLUMNS)
    closing = merge.versions_to_close(held, sent, SECOND)
    opening = merge.versions_to_insert(held, sent, SECOND)
    assert [r["symbol"] for r in closing.collect()] == ["B"]
    assert sorted(r["symbol"] for r in opening.collect()) == ["B", "D"]


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_closing_parses_each_feed_once(spark):
    """an inner join asked the parsed instants not to be NULL, so their text was parsed a second time."""
    def parsed(*rows):
        text = bars(spark, *rows).withColumn("price_ts", F.col("price_ts").cast("string"))
        lines = text.selectExpr("*", "explode(array(1)) AS line").drop("line")
        return lines.withColumn("price_ts", F.col("price_ts").try_cast("timestamp"))

    lost = parsed(bar("A"), bar("B")).withColumn("price_ts", F.when(F.col("symbol") != "B", F.col("price_ts")))
    closing = merge.versions_to_close(merge.first_load(lost, FIRST), parsed(bar("A", close="2"), bar("B", close="2")), SECOND)
    assert [(r["symbol"], r["close_price"]) for r in closing.collect()] == [("A", Decimal("100.000000"))]
    assert closing.columns == list(VERSION_COLUMNS)
    feeds = [parsed(bar("A")), parsed(bar("A", close="2"))]
    closing = merge.versions_to_close(merge.first_load(feeds[0], FIRST), feeds[1], SECOND)
    assert optimized(closing).count("try_cast(") == 2


def test_counting_versions_carries_no_unused_column(spark):
    """versions were made as whole structs, only to be counted."""
    held = merge.first_load(bars(spark, bar("A"), bar("B"), bar("C")), FIRST)
    merged = merge.temporal_merge(held, bars(spark, bar("A"), bar("B", close="2"), bar("D")), SECOND)
    counts = merge.version_counts(merged, "symbol")
    assert sorted(map(tuple, counts.collect())) == [("A", 1, 1), ("B", 2, 1), ("C", 1, 1), ("D", 1, 1)]
    assert "created_at" not in optimized(counts)


def test_null_adjusted_close_is_a_value(spark):
    held = merge.first_load(bars(spark, bar()).withColumn("adjusted_close", F.lit(None).cast("decimal(18,6)")), FIRST)
    changed = merge.merge_active(held, bars(spark, bar()), SECOND)
    assert {r["change"] for r in changed.collect()} == {"closed", "corrected"}


def test_backdated_correction_breaks_the_window(spark):
    held = merge.first_load(bars(spark, bar()), SECOND)
    merged = merge.merge_active(held, bars(spark, bar(close="2")), FIRST)
    counts = {r["rule"]: r["violations"] for r in checks.violations(merged, checks.version_rules()).collect()}
    assert counts["valid_window"] == 1
    with pytest.raises(checks.ConstraintError, match="valid_window=1"):
        checks.demand(counts)


def _history(spark, seed, keys=4, loads=9):
    """Random versions: few keys, one of them corrected by every load."""
    rng = random.Random(seed)
    versions, moment = None, FIRST
    for _ in range(loads):
        rows = [bar(f"S{k}", close=str(rng.randint(1, 3 if k else 99))) for k in range(keys) if k == 0 or rng.random() < 0.6]
        staged = bars(spark, *rows)
        if versions is None:
            versions = merge.first_load(staged, moment)
        else:
            versions = merge.temporal_merge(versions, staged, moment)
        moment += timedelta(hours=rng.choice([1, 7, 30]))
    return versions, moment


def test_bulk_as_of_against_brute_force(spark, tmp_path):
    versions, last = _history(spark, 7, loads=6)
    versions.write.parquet(str(tmp_path / "v"))
    versions = spark.read.parquet(str(tmp_path / "v"))
    clock = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("price_ts", "valid_from", "valid_to")]
    held = versions.select("symbol", "close_price", *clock).collect()
    rng = random.Random(1)
    moments = [v["valid_from"] + timedelta(microseconds=d) for v in held for d in (-1, 0, 1)]
    asked = [(f"S{rng.randint(0, 4)}", m) for m in moments] + [("S0", FIRST + timedelta(hours=1))] * 20
    rows = [(n, "feed", s.lower(), BAR_TS.isoformat(sep=" "), m.isoformat(sep=" ")) for n, (s, m) in enumerate(asked)]
    requests = spark.createDataFrame(rows, "n int, source_name string, symbol string, price_ts string, as_of string")
    requests = requests.withColumns({c: F.col(c).cast("timestamp") for c in ("price_ts", "as_of")})
    answers = asof.price_as_of_many(versions, requests, "hour")
    found = {r["n"]: (r["close_price"], r["f"]) for r in answers.withColumn("f", F.col("valid_from").cast("timestamp_ntz")).collect()}
    expected = {
        n: (v["close_price"], v["valid_from"])
        for n, (s, m) in enumerate(asked)
        for v in held
        if v["symbol"] == s and v["valid_from"] <= m and (v["valid_to"] is None or v["valid_to"] > m)
    }
    assert found == expected and len(expected) > 20


def test_table_function_filters_reach_the_scan(spark, tmp_path):
    versions = merge.first_load(bars(spark, bar(), bar("MSFT", close="7")), FIRST)
    versions.write.parquet(str(tmp_path / "v"))
    spark.read.parquet(str(tmp_path / "v")).createOrReplaceTempView("held_versions")
    asof.register_sql(spark, "held_versions", "held_price")
    found = spark.sql(f"SELECT * FROM held_price('feed', 'aapl', TIMESTAMP '{BAR_TS}', TIMESTAMP '{SECOND}')")
    assert [r["symbol"] for r in found.collect()] == ["AAPL"]
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(text for text in plan.splitlines() if text.startswith("PushedFilters"))
    for name in ("EqualTo(source_name,feed)", "EqualTo(symbol,AAPL)", "EqualTo(price_ts,", "LessThanOrEqual(valid_from,", "IsNull(valid_to)"):
        assert name in pushed, (name, pushed)


def test_overlapping_intervals(spark):
    versions = merge.first_load(bars(spark, bar("A"), bar("B")), FIRST)
    versions = merge.temporal_merge(versions, bars(spark, bar("A", close="2")), SECOND)
    assert checks.overlapping_intervals(versions).count() == 0
    middle = FIRST + timedelta(hours=1)
    both = versions.unionByName(merge.first_load(bars(spark, bar("A", close="3")), middle))
    found = shown(checks.overlapping_intervals(both), "symbol", "valid_from", "held_until")
    assert found == [("A", str(middle), str(SECOND)), ("A", str(SECOND), None)]


def test_snapshot_at_each_load_has_one_version_per_key(spark):
    versions, last = _history(spark, 3, loads=4)
    snapshot = asof.snapshot_as_of(versions, last)
    assert checks.duplicate_keys(snapshot, KEYS).count() == 0
    assert shown(snapshot, *VERSION_COLUMNS) == shown(merge.current(versions), *VERSION_COLUMNS)


def test_reconciliation(spark):
    staged = bars(spark, bar("AAPL"), bar("MSFT", close="200"))
    versions = merge.first_load(staged, FIRST)
    for mode in ("digest", "md5"):
        compared = reconcile.reconcile(staged, versions, mode)
        assert shown(compared, "symbol", "source_rows", "landed_rows", "matched") == [
            ("AAPL", "1", "1", "true"), ("MSFT", "1", "1", "true"),
        ]
        assert reconcile.verdict(compared).first().asDict() == {
            "status": "passed", "source_total_rows": 2, "landed_total_rows": 2, "symbols": 2, "mismatched_symbols": 0,
        }
        stale = reconcile.reconcile(bars(spark, bar("AAPL", close="7"), bar("NEW")), versions, mode)
        assert shown(stale, "symbol", "landed_rows", "matched") == [("AAPL", "1", "false"), ("NEW", "0", "false")]
        assert reconcile.verdict(stale).first()["status"] == "failed"


def nested_md5(lines):
    """lines: (instant text, line), in order; MD5 by hour, by day, over the days."""
    from hashlib import md5
    from itertools import groupby

    def digest(parts):
        return md5("||".join(parts).encode()).hexdigest()

    hours = [(h, digest(x for _, x in g)) for h, g in groupby(lines, lambda e: e[0][:13])]
    return digest(digest(x for _, x in g) for _, g in groupby(hours, lambda e: e[0][:10]))


def test_ordered_checksum_has_one_form(spark):
    rows = bars(spark, bar(ts=BAR_TS + timedelta(minutes=1), close="2"), bar(close="1.5"))
    rows = rows.withColumn("adjusted_close", F.when(F.col("close_price") == 2, F.col("close_price")))
    line = "feed|AAPL|{t}|{p}|{p}|{p}|{p}|1000|{a}|USD".format
    first, second = "2026-04-01T13:30:00.000000", "2026-04-01T13:31:00.000000"
    expected = [(first, line(t=first, p="1.500000", a="")), (second, line(t=second, p="2.000000", a="2.000000"))]
    assert reconcile.symbol_checksums(rows, "md5").first()["checksum"] == nested_md5(expected)


def test_ordered_checksum_of_a_large_symbol(spark):
    n = 130_000
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp")
    rows = spark.range(n).select(
        F.lit("feed").alias("source_name"), F.lit("A").alias("symbol"), (start + F.make_dt_interval(secs=F.col("id") * 7)).alias("price_ts"),
        *[F.lit(Decimal("1.500000")).cast("decimal(18,6)").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.col("id").alias("volume"), F.lit(None).cast("decimal(18,6)").alias("adjusted_close"), F.lit("USD").alias("currency"),
    ).repartition(5)
    found = reconcile.symbol_checksums(rows, "md5").first()
    instants = [(datetime(2026, 1, 1) + timedelta(seconds=7 * i)).isoformat(timespec="microseconds") for i in range(n)]
    price = "|".join(["1.500000"] * 4)
    expected = nested_md5([(t, f"feed|A|{t}|{price}|{i}||USD") for i, t in enumerate(instants)])
    assert (found["row_count"], found["checksum"]) == (n, expected)


def test_building_plans_starts_no_job(spark):
    rows = merge.first_load(bars(spark, bar()), FIRST)
    requests = rows.select(*KEYS, F.col("valid_from").alias("as_of"))
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("build", "plans")
    asof.price_as_of_many(rows, requests)
    adjust.adjust_close(rows, actions(spark))
    assert list(tracker.getJobIdsForGroup("build")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)


def actions(spark, *rows):
    filled = [(*row, "USD", None) for row in rows]
    return spark.createDataFrame(filled, ACTION)


def test_split_adjusts_all_earlier_versions(spark):
    rows = bars(spark, bar(close="100"), bar(ts=datetime(2026, 4, 4, 13, 30), close="110"))
    split = actions(spark, ("feed", "AAPL", datetime(2026, 4, 3).date(), "split", Decimal(2), None))
    adjusted = adjust.adjust_close(merge.first_load(rows, FIRST), split, "feed", "aapl")
    expected = [("100.000000", "50.000000"), ("110.000000", "110.000000")]
    assert shown(adjusted, "close_price", "adjusted_close") == expected


def test_fold_order_rounding_and_overflow(spark):
    rows = bars(spark, bar("A", close="100"), bar("B", close="100"), bar("C", close="900000000000"), bar("D", adjusted="3"))
    day = datetime(2026, 5, 1).date()
    later = datetime(2026, 6, 1).date()
    listed = actions(
        spark,
        ("feed", "A", day, "split", Decimal(3), None), ("feed", "A", later, "split", Decimal(7), None),
        ("feed", "B", day, "dividend", None, Decimal("10")), ("feed", "B", later, "split", Decimal(2), None),
        ("feed", "C", day, "split", Decimal("0.00000001"), None),
    )
    adjusted = adjust.adjust_close(merge.first_load(rows, FIRST), listed)
    assert shown(adjusted, "symbol", "adjusted_close") == [
        ("A", "4.761905"), ("B", "45.000000"), ("C", None), ("D", "100.000000"),
    ]


def test_fold_equals_decimal_arithmetic(spark):
    rng = random.Random(5)
    ratios = [Decimal(x) for x in ("3", "7", "1.1", "13.37", "0.5", "0.33333333")]
    listed, rows = {}, []
    for s in range(40):
        days = rng.sample(range(1, 90), rng.randint(0, 5))
        listed[f"S{s}"] = sorted(
            (datetime(2026, 4, 1).date() + timedelta(days=d), *rng.choice([("dividend", None, Decimal(rng.randint(0, 300)) / 100), ("split", rng.choice(ratios), None)]))
            for d in days
        ) if days else []
        rows += [bar(f"S{s}", datetime(2026, 4, 1) + timedelta(days=d), str(rng.randint(10**4, 10**6) / Decimal(100))) for d in (0, 30, 60)]
    flat = [("feed", s, *entry) for s, entries in listed.items() for entry in entries]
    adjusted = adjust.adjust_close(merge.first_load(bars(spark, *rows), FIRST), actions(spark, *flat))
    found = {(r["symbol"], r["t"]): r["adjusted_close"] for r in adjusted.withColumn("t", F.col("price_ts").cast("timestamp_ntz")).collect()}
    expected = {}
    with localcontext() as context:
        context.prec = 28
        for row in rows:
            value = row[3]
            for day, kind, ratio, amount in listed[row[1]]:
                if day > row[2].date():
                    value = value / ratio if kind == "split" else value - amount
            expected[(row[1], row[2])] = value.quantize(Decimal("0.000001"))
    assert found == expected


def test_ratios_without_end_and_ties_are_exact(spark):
    """Runs of 3 and 7, a tie only the exact quotient shows, prices below zero, runs of more than 38 digits, days that are shared."""
    first = datetime(2026, 4, 2).date()
    listed = {
        "A": [(first + timedelta(days=i), "split", Decimal(r), None) for i, r in enumerate((3, 7, 3, 7, 9, 11))],
        "B": [(first, "split", Decimal(8), None), (first + timedelta(days=1), "split", Decimal("0.25"), None)],
        "C": [(first, "dividend", None, Decimal("200.000001")), (first, "split", Decimal(2), None)],
        "D": [(first + timedelta(days=i), "split", Decimal("1.00000001") + Decimal(i) / 1000, None) for i in range(30)],
        "E": [(first + timedelta(days=i), "dividend", None, Decimal(i) / 8) for i in range(37)],
        "F": [(first, "dividend", None, None), (first, "split", Decimal(3), None)],
    }
    starts = [datetime(2026, 4, 1, 12) + timedelta(days=d) for d in range(40)]
    rows = [bar(s, t, c) for s in listed for t in starts for c in ("10", "0.000005")[: 1 + (t == starts[0])]]
    rows += [bar("B", starts[0], c) for c in ("0.000001", "0.000003", "0.000007")]
    flat = [("feed", s, *entry) for s, entries in listed.items() for entry in entries]
    adjusted = adjust.adjust_close(merge.first_load(bars(spark, *rows), FIRST), actions(spark, *flat))
    stamp = F.col("price_ts").cast("timestamp_ntz").alias("t")
    found = {(r[0], r[1], r[2]): r[3] for r in adjusted.select("symbol", stamp, "close_price", "adjusted_close").collect()}
    with localcontext() as context:
        context.prec = 28
        for s, t, close in found:
            value = close
            for day, kind, ratio, amount in sorted(listed[s], key=lambda entry: entry[:2]):
                if day > t.date() and (kind == "split" or amount is not None):
                    value = value / ratio if kind == "split" else value - amount
            assert found[(s, t, close)] == value.quantize(Decimal("0.000001")), (s, t, close)
    assert len(found) == len({(r[1], r[2], r[3]) for r in rows})


def test_ordinary_bars_are_adjusted_in_64_bits(spark):
    """every bar was multiplied and divided in 38 digits; now only those that need them are."""
    day = datetime(2026, 5, 1).date()
    ratios = {"A": "3", "B": "0.33333333", "C": "13.37", "D": "2", "E": "99999.99999999"}
    listed = actions(spark, *[("feed", s, day, "split", Decimal(r), None) for s, r in ratios.items()])
    closes = ("0.000001", "0.000003", "100", "46116860184.273879", "461168601842.738790", "900000000000", "999999999999.999999")
    rows = [bar(s, BAR_TS + timedelta(days=i), c) for s in ratios for i, c in enumerate(closes)]
    versions = merge.first_load(bars(spark, *rows), FIRST)
    held = adjust.composed(adjust.with_listing(versions, listed, "UTC"), "close_price")
    wide = {(r["symbol"], r["close_price"]) for r in held.where("run IS NOT NULL").collect()}
    assert not [key for key in wide if key[0] in "AD"] and ("C", Decimal("100.000000")) not in wide
    assert ("C", Decimal("900000000000.000000")) in wide
    with localcontext() as context:
        context.prec = 60
        for r in adjust.adjust_close(versions, listed).collect():
            exact = (r["close_price"] / Decimal(ratios[r["symbol"]])).quantize(Decimal("0.000001"))
            assert r["adjusted_close"] == (exact if exact < 10**12 else None), r


def test_days_are_found_by_halving(spark):
    first = datetime(2026, 1, 1).date()
    for n in (1, 2, 3, 7, 8, 9, 31):
        listed = [("feed", "A", first + timedelta(days=2 * i), kind, Decimal(1), Decimal(0)) for i in range(n) for kind in ("split", "dividend")]
        rows = [bar("A", datetime(2025, 12, 31) + timedelta(days=i)) for i in range(2 * n + 2)] + [bar("B")]
        held = adjust.with_actions(bars(spark, *rows), actions(spark, *listed)).withColumn("t", F.col("price_ts").cast("timestamp_ntz"))
        for row in held.select("symbol", "t", "actions").collect():
            expected = [entry[2] for entry in listed if entry[2] > row["t"].date()] if row["symbol"] == "A" else None
            assert (row["actions"] if expected is None else [a["action_date"] for a in row["actions"]]) == expected


def test_action_constraints(spark):
    day = datetime(2026, 4, 3).date()
    bad = actions(spark, ("feed", "A", day, "split", None, None), ("feed", "A", day, "merger", None, None),
                  ("feed", "B", day, "dividend", None, Decimal(1)), ("feed", "B", day, "dividend", None, Decimal(2)))
    with pytest.raises(checks.ConstraintError) as caught:
        checks.demand_actions(bad)
    assert caught.value.violations == {"action_type": 1, "split_ratio": 1, "unique_action": 1}


def test_differences_name_the_rows(spark):
    later = BAR_TS.replace(day=BAR_TS.day + 1)
    sent = bars(spark, bar("A", close="1"), bar("B", close="2"), bar("B", ts=later, close="2"), bar("C", close="3"))
    held = bars(spark, bar("A", close="1"), bar("B", close="9"), bar("B", ts=later, close="9"), bar("D", close="3"))
    found = reconcile.differences(sent, held)
    assert sorted((r["symbol"], r["difference"]) for r in found.collect()) == [
        ("B", "changed"), ("B", "changed"), ("C", "missing"), ("D", "extra")]
    first = {r["symbol"]: r for r in reconcile.first_differences(found).collect()}
    assert first["B"]["different_keys"] == 2 and first["B"]["price_ts"] == sent.where("symbol = 'B'").agg(F.min("price_ts")).first()[0]
    assert reconcile.differences(sent, sent).isEmpty() and reconcile.differences(sent.limit(0), sent.limit(0)).isEmpty()


def test_repeated_rows_do_not_cancel(spark):
    once, twice = bars(spark, bar("A")), bars(spark, bar("A"), bar("A"), bar("A"))
    assert [r["difference"] for r in reconcile.differences(once, twice).collect()] == ["changed"]


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bulk_as_of_shuffles_once(spark):
    versions = merge.temporal_merge(merge.first_load(bars(spark, bar("A"), bar("B")), FIRST), bars(spark, bar("A", close="2")), SECOND)
    versions = spark.createDataFrame(versions.collect(), versions.schema)
    moments = [FIRST - timedelta(days=1), FIRST, SECOND, SECOND + timedelta(days=400)]
    asked = bars(spark, *[bar(s.lower()) for s in "ABC"]).select(*KEYS).crossJoin(spark.createDataFrame([(str(m),) for m in moments], "m string"))
    asked = asked.select(*KEYS, F.col("m").cast("timestamp").alias("as_of"))
    whole, sliced = asof.price_as_of_many(versions, asked), asof.price_as_of_many(versions, asked, "day")
    assert exchanges(whole) == 1
    columns = (*KEYS, "as_of", "close_price", "valid_from")
    assert shown(whole, *columns) == shown(sliced, *columns) and whole.count() == 6


def test_ordered_reconciliation_deals_rows_once(spark):
    hours = [BAR_TS + timedelta(hours=h, minutes=m) for h in (0, 1, 30) for m in (0, 1)]
    staged = bars(spark, *[bar(s, ts) for s in "AB" for ts in hours], bar("C"))
    held = merge.first_load(bars(spark, *[bar("A", ts) for ts in hours], *[bar("B", ts, close="7") for ts in hours[1:]], bar("D")), FIRST)
    apart = reconcile.compare_checksums(
        reconcile.symbol_checksums(staged, "md5"), reconcile.symbol_checksums(reconcile.landed_for(staged, held), "md5")
    )
    both = reconcile.reconcile(staged, held, "md5")
    assert shown(both, *both.columns) == shown(apart, *both.columns)
    assert [(r["symbol"], r["landed_rows"], r["matched"]) for r in both.orderBy("symbol").collect()] == [("A", 6, True), ("B", 5, False), ("C", 0, False)]
    # Rows by symbol and day, then checksums by symbol and side, and by symbol.
    assert exchanges(both) == 3


def test_whole_bars_keep_their_columns(spark):
    from pitbars.plans import inputs

    rows = bars(spark, bar("A")).withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy("price_ts")))
    plan = inputs.whole(rows).select("symbol", "volume")._jdf.queryExecution().optimizedPlan().toString()
    assert "close_price" in plan


def test_insert_joins_by_the_key_alone(spark):
    held = merge.first_load(bars(spark, bar("A"), bar("B"), bar("E", adjusted="1")), FIRST)
    held = held.withColumn("adjusted_close", F.when(F.col("symbol") != "E", F.col("adjusted_close")))
    sent = bars(spark, bar("A"), bar("B", close="2"), bar("D"), bar("E")).withColumn(
        "adjusted_close", F.when(F.col("symbol") != "E", F.col("adjusted_close"))
    )
    opening = merge.versions_to_insert(held, sent, SECOND)
    # E has no adjusted close on either side, which is equal.
    assert sorted(r["symbol"] for r in opening.collect()) == ["B", "D"]
    dealt = [side.repartition("source_name", "symbol", "price_ts") for side in (held, sent)]
    plan = merge.versions_to_insert(*dealt, SECOND).hint("merge")
    assert exchanges(plan) <= 2, plan.explain()
    assert "coalesce" not in plan._jdf.queryExecution().optimizedPlan().toString().lower()


def test_differences_read_each_side_once(spark, tmp_path):
    for name, close in (("sent", "1"), ("held", "2")):
        bars(spark, bar("A", close=close), bar("B")).write.parquet(str(tmp_path / name))
    found = reconcile.differences(*[spark.read.parquet(str(tmp_path / name)) for name in ("sent", "held")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and exchanges(found) == 1, plan
    assert [tuple(r)[1::2] for r in found.collect()] == [("A", "changed")]


def test_reconciliation_shuffles_rows_before_sums(spark):
    found = reconcile.reconcile(bars(spark, bar("A"), bar("B")), merge.first_load(bars(spark, bar("A"), bar("B", close="7")), FIRST))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and exchanges(found) == 2, plan
    assert sorted((r["symbol"], r["matched"]) for r in found.collect()) == [("A", True), ("B", False)]


def test_one_listing_is_filtered_before_the_merge(spark, tmp_path):
    from pitbars.plans import inputs

    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
    rows = [(n, n, n % 3, 2, 5.0 + n, 900.0 + n, 0.05, 0.06, "RAN"[n % 3], datetime(1995, 1, 1 + n)) for n in range(1, 9)]
    spark.createDataFrame(rows, lines).write.parquet(str(tmp_path / "lineitem.parquet"))
    whole = inputs.merged_twice(spark, str(tmp_path)).where("symbol = 'S2'")
    one = inputs.merged_twice(spark, str(tmp_path), ("vendor_a", "s2"))
    assert shown(one, *VERSION_COLUMNS) == shown(whole, *VERSION_COLUMNS) and one.count() > 0
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Relation [")[:-1]:  # the listing is judged right above each scan
        assert "S2" in part[-6000:], part[-6000:]


def odd_loads(spark):
    """Versions and a feed with closed history, repeated keys on both sides and NULLs in keys and payload."""
    first = merge.first_load(bars(spark, *[bar(s) for s in ("A", "B", "C", "D", "D", "E")]), FIRST)
    held = merge.temporal_merge(first, bars(spark, bar("A", close="2"), bar("C", close="3")), SECOND)
    sent = bars(spark, bar("A", close="4"), bar("B"), bar("D", close="5"), bar("D"), bar("E", close="6"), bar("E", close="6"), bar("F"), bar("F"))

    def lost(rows, *also):
        for name in KEYS:
            rows = rows.unionByName(rows.where("symbol = 'B'").withColumn(name, F.lit(None).cast(rows.schema[name].dataType)))
        return rows.withColumn("adjusted_close", F.when(F.col("symbol").isin(*also), None).otherwise(F.col("adjusted_close")))

    return lost(held, "C", "E"), lost(sent, "B", "E")


def test_merge_in_place_makes_the_same_versions(spark):
    held, sent = odd_loads(spark)
    third = SECOND + timedelta(days=1)
    joined = merge.temporal_merge(held, sent, third, third + timedelta(hours=1))
    placed = merge.temporal_merge_in_place(held, sent, third, third + timedelta(hours=1))
    assert placed.columns == joined.columns
    assert shown(placed, *VERSION_COLUMNS) == shown(joined, *VERSION_COLUMNS) and placed.count() > held.count()
    none = sent.limit(0)
    assert shown(merge.temporal_merge_in_place(held, none, third), *VERSION_COLUMNS) == shown(held, *VERSION_COLUMNS)
    assert shown(merge.temporal_merge_in_place(held.limit(0), sent, third), *VERSION_COLUMNS) == shown(
        merge.temporal_merge(held.limit(0), sent, third), *VERSION_COLUMNS
    )


def order_lines(spark, path):
    """Order lines that repeat keys, in a table of their own."""
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
    rows = [(n, n, n % 7, 1 + n % 4, 1.0 + n % 50, 900.0 + n, 0.05, 0.01 * (n % 9), "RAN"[n % 3], datetime(1995, 1, 1 + n % 11)) for n in range(1, 400)]
    spark.createDataFrame(rows, lines).write.parquet(f"{path}/lineitem.parquet")


def test_reconciliation_leaves_the_merge_in_place(spark, tmp_path):
    """the versions were shuffled whole again behind the merge, and a day's MD5 once for each side."""
    from pitbars.plans import catalogue, inputs

    order_lines(spark, tmp_path)
    compared = catalogue.REGISTRY["reconcile_by_symbol"](spark, str(tmp_path))
    # The feed as sent and in the merge, of which one is used again, the first feed, and the days' MD5.
    assert exchanges(compared) == 4
    apart = reconcile.reconcile(inputs.staged(spark, str(tmp_path), True), inputs.merged(spark, str(tmp_path)), "md5")
    assert shown(compared, *compared.columns) == shown(apart, *apart.columns) and compared.where("matched").count() == 7
    stale = inputs.first_load(inputs.staged(spark, str(tmp_path), by_day=True), FIRST, keep=(inputs.DAY,))
    placed = reconcile.reconcile(inputs.staged(spark, str(tmp_path), True, by_day=True), stale, "md5")
    apart = reconcile.reconcile(inputs.staged(spark, str(tmp_path), True), inputs.loaded(spark, str(tmp_path)), "md5")
    assert shown(placed, *placed.columns) == shown(apart, *apart.columns) and placed.where("matched").count() == 0


def test_ordered_reconciliation_of_odd_rows(spark):
    held, sent = odd_loads(spark)
    both = reconcile.reconcile(sent, held, "md5")
    sums = [reconcile.symbol_checksums(side, "md5").collect() for side in (sent, reconcile.landed_for(sent, held))]
    found = {r["symbol"]: tuple(r)[1:] for r in both.collect()}
    expected = {}
    for n, side in enumerate(sums):
        for symbol, rows, checksum in side:
            expected.setdefault(symbol, [0, 0, None, None])[n::2] = rows, checksum
    assert {symbol: list(row[:4]) for symbol, row in found.items()} == expected
    assert None in found and found["F"][:2] == (2, 0) and found["D"][:2] == (2, 2)


def test_bulk_as_of_shuffles_only_requests_beside_versions_in_place(spark, tmp_path):
    """each merge shuffled all versions behind it, and the line of versions and requests did so once more."""
    from pitbars.plans import catalogue, inputs

    order_lines(spark, tmp_path)
    answered = catalogue.REGISTRY["price_as_of_bulk"](spark, str(tmp_path))
    # Three loads and the feed the requests come from, of which two are used again, and the requests.
    assert exchanges(answered) == 5
    asked = inputs.requests(spark, str(tmp_path))
    expected = catalogue.comparable(asof.price_as_of_many(inputs.merged_twice(spark, str(tmp_path)), asked))
    assert answered.columns == expected.columns
    assert shown(answered, *answered.columns) == shown(expected, *expected.columns) and 0 < answered.count() < asked.count()


def test_bulk_as_of_in_place_takes_any_versions(spark):
    held, sent = odd_loads(spark)
    asked = sent.select("source_name", F.lower("symbol").alias("symbol"), "price_ts", F.lit(str(SECOND)).cast("timestamp").alias("as_of"))
    asked = asked.withColumn("n", F.monotonically_increasing_id())
    single = held.where("symbol <> 'D'")
    whole, placed = asof.price_as_of_many(single, asked), asof.price_as_of_many(single, asked, in_place=True)
    assert shown(placed, *placed.columns) == shown(whole, *placed.columns) and whole.count() > 0

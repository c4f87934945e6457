"""Feed rows to bars: parsing, reason codes, duplicates."""

from dataclasses import replace
from datetime import datetime, time, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitbars.contract import ContractError, FeedContract, TradingHours, pick
from pitbars.functions.clock import localised, names_offset, wall_clock, zone_shifts, zoned_instant
from pitbars.functions.text import BLANKS, stripped, whole_number
from pitbars.operators import normalize as N

NEW_YORK = FeedContract("feed", "America/New_York")
NOW = datetime(2026, 3, 14, tzinfo=timezone.utc)
GOOD = {
    "symbol": "AAPL", "timestamp": "2026-03-13 09:30:00", "open": "58.25", "high": "59.00", "low": "57.75",
    "close": "58.50", "volume": "640300", "adjusted_close": "58.50", "currency": "USD",
}


def feed(spark, *changes):
    rows = [{**GOOD, **change, "n": n} for n, change in enumerate(changes)]
    names = [*GOOD, "n"]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"{c} string" for c in GOOD) + ", n int")


def reasons(spark, contract, now, *changes):
    tagged = N.tag(feed(spark, *changes), contract, now, ["n"])
    return [row[N.REASON] for row in tagged.orderBy("n").select(N.REASON).collect()]


def test_case_folding_duplicate_and_zone(spark):
    raw = feed(spark, {"symbol": "aapl", "currency": "usd"}, {})
    tagged = N.tag(raw, NEW_YORK, NOW, ["n"])
    assert N.run_counters(tagged).first().asDict() == {
        "rows_read": 2, "rows_valid": 1, "rows_rejected": 0, "duplicates_dropped": 1,
    }
    bar = N.normalize(raw, NEW_YORK, ["n"], NOW).withColumn("price_ts", F.col("price_ts").cast("string")).first()
    assert (bar["symbol"], bar["currency"], bar["price_ts"]) == ("AAPL", "USD", "2026-03-13 13:30:00")
    assert bar["close_price"] == Decimal("58.50")


def test_last_valid_duplicate_wins(spark):
    raw = feed(spark, {"close": "58.00"}, {"close": "58.75"}, {"volume": "-1"})
    bars = N.normalize(raw, NEW_YORK, ["n"], NOW).collect()
    assert [bar["close_price"] for bar in bars] == [Decimal("58.75")]


def test_row_rules(spark):
    cases = [
        ({"timestamp": "bad-date"}, "invalid_timestamp"),
        ({"open": "33", "high": "31.5", "low": "32", "close": "31.75", "volume": "-6"},
         "negative_volume; invalid_high_low_envelope"),
        ({"timestamp": "2026-03-15 09:30:00"}, "future_timestamp"),
        ({"symbol": "  "}, "missing_required:symbol; invalid_symbol"),
        ({"symbol": " aapl　"}, ""),
        ({"currency": "US"}, "invalid_currency"),
        ({"currency": None}, "missing_required:currency; invalid_currency"),
        ({"open": "x"}, "invalid_number:open_price"),
        ({"close": "1_000"}, "invalid_number:close_price"),
        ({"volume": "12.5"}, "invalid_integer:volume"),
        ({"volume": "1e3"}, ""),
        ({"volume": " 5.0 "}, ""),
        ({"volume": "99999999999999999999"}, "invalid_integer:volume"),
        ({"adjusted_close": "n/a"}, ""),
        ({"adjusted_close": "-1"}, "non_positive_price:adjusted_close"),
        ({"low": "0"}, "non_positive_price:low_price"),
        ({"open": "0.0000004", "low": "0.0000003"}, ""),
        ({"symbol": "NA"}, ""),
        ({"open": None}, "missing_required:open; invalid_number:open_price"),
    ]
    found = reasons(spark, NEW_YORK, NOW, *[change for change, _ in cases])
    assert found == [expected for _, expected in cases]


def test_future_slack_is_five_minutes_exclusive(spark):
    utc = replace(NEW_YORK, zone="UTC")
    found = reasons(spark, utc, datetime(2026, 3, 13, 9, 25), {}, {"timestamp": "2026-03-13 09:30:00.000001"})
    assert found == ["", "future_timestamp"]
    relaxed = replace(utc, rules=replace(utc.rules, allow_future=True))
    assert reasons(spark, relaxed, datetime(2020, 1, 1), {}) == [""]


def test_calendar_codes_stack(spark):
    hours = TradingHours(True, time(9, 30), time(16, 0), frozenset({"2026-04-03", "2026-04-04"}))
    contract = replace(NEW_YORK, hours=hours)
    stamps = {
        "2026-04-01 08:00:00": "outside_market_hours",
        "2026-04-03 10:00:00": "market_closed_holiday",
        "2026-04-04 08:00:00": "market_closed_weekend; market_closed_holiday; outside_market_hours",
        "2026-04-02 09:30:00": "",
        "2026-04-02 16:00:00": "",
        "2026-04-02 16:00:00.000001": "outside_market_hours",
        "nonsense": "invalid_timestamp",
    }
    found = reasons(spark, contract, datetime(2026, 5, 1), *[{"timestamp": text} for text in stamps])
    assert found == list(stamps.values())


def test_required_name_without_column(spark):
    contract = replace(NEW_YORK, required=("symbol", "venue"))
    assert reasons(spark, contract, NOW, {}) == ["missing_column:venue"]


def test_unmapped_adjusted_close_is_null(spark):
    contract = replace(NEW_YORK, columns={c: c for c in GOOD if c != "adjusted_close"})
    assert N.normalize(feed(spark, {}), contract, ["n"], NOW).first()["adjusted_close"] is None


def test_header_and_contract_errors(spark):
    with pytest.raises(N.FeedError, match="lacks columns its contract names: high, open"):
        N.map_columns(feed(spark, {}).drop("open", "high"), NEW_YORK)
    with pytest.raises(ContractError, match="close, volume"):
        replace(NEW_YORK, columns={c: c for c in GOOD if c not in ("close", "volume")}).checked()
    with pytest.raises(ContractError):
        replace(NEW_YORK, table="other").checked()
    assert pick([NEW_YORK], "feed") == [NEW_YORK]
    with pytest.raises(ContractError, match="configured feeds: feed"):
        pick([NEW_YORK], "nope")


def test_timestamp_texts(spark):
    texts = {
        "03/13/2026 09:30": "2026-03-13 09:30:00",
        "13/03/2026": "2026-03-13 00:00:00",
        "20260313": "2026-03-13 00:00:00",
        "Mar 13, 2026 9:30 AM": "2026-03-13 09:30:00",
        "2026-03": "2026-03-01 00:00:00",
        "2026-03-13T09:30:00.5": "2026-03-13 09:30:00.5",
        "2026-03-13 09:30:00-04:00": "2026-03-13 13:30:00",
        "2026-03-13T09:30:00Z": "2026-03-13 09:30:00",
        "2026-03-13 09:30:00+0530": "2026-03-13 04:00:00",
        "2026-03-13 09:30:00 UTC": "2026-03-13 09:30:00",
        "2026-03-13 09:30:00 gmt": "2026-03-13 09:30:00",
        "2026-03-13 09:30 America/New_York": "2026-03-13 13:30:00",
        "2026-03-13 09:30:00 Nowhere/Town": None,
        "2026-03-13 09:30:00 XYZ": None,
        "2026-03-13T09:30Z": "2026-03-13 09:30:00",
        "2026-03-13 9:30-04:00": "2026-03-13 13:30:00",
        "2026-03-13 9:30 -4": "2026-03-13 13:30:00",
        "03/13/2026 9:30 PM UTC": "2026-03-13 21:30:00",
        "2026/03/13 09:30": "2026-03-13 09:30:00",
        "03/13/2026 9:30 AM": "2026-03-13 09:30:00",
        "March 13, 2026": "2026-03-13 00:00:00",
        "13-Mar-2026": "2026-03-13 00:00:00",
        "20260313T093000": "2026-03-13 09:30:00",
        "20260313T0930Z": "2026-03-13 09:30:00",
        "20260313 09:30": "2026-03-13 09:30:00",
        "03/13/26": "2026-03-13 00:00:00",
        "2026-03-13 9:30 AM": "2026-03-13 09:30:00",
        "3/13/2026 09:30:00.250": "2026-03-13 09:30:00.25",
        "Mar 13 2026 09:30": "2026-03-13 09:30:00",
        "13 March 2026": "2026-03-13 00:00:00",
        "March 13 2026": "2026-03-13 00:00:00",
        "Fri Mar 13 09:30:00 2026": "2026-03-13 09:30:00",
        "Fri, 13 Mar 2026 09:30:00 GMT": "2026-03-13 09:30:00",
        "Friday, 13th of March 2026": None,
        "Friday, 13th March 2026, 9 p.m.": "2026-03-13 21:00:00",
        "OCT 13 2026": "2026-10-13 00:00:00",
        "Sept. 3, 2026 12:05 am": "2026-09-03 00:05:00",
        "2026.03.13 09:30": "2026-03-13 09:30:00",
        "13.03.2026 09:30": "2026-03-13 09:30:00",
        "03.04.2026": "2026-03-04 00:00:00",
        "2026-03-13 09": "2026-03-13 09:00:00",
        "2026-03-13 24": None,
        "Mar 2026": "2026-03-01 00:00:00",
        "2026 Mar 13": "2026-03-13 00:00:00",
        "13-Mar-99": "1999-03-13 00:00:00",
        "03/2026": "2026-03-01 00:00:00",
        "2026-03-13 13:30 PM": None,
        "2026-03-13 09:30:60": None,
        "2026-03-13 09:30 and more": None,
        "13/13/2026": None,
        "Mar 13": None,
        "9:30": None,
        "12": None,
        "now": None,
        "12:30Z": None,
        "2026-02-30": None,
    }
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    clock = F.col("t")
    read = F.when(names_offset(clock), zoned_instant(clock, NEW_YORK.date_shapes)).otherwise(
        wall_clock(clock, NEW_YORK.date_shapes).cast("timestamp")
    )
    found = [r["x"] for r in rows.select("n", read.cast("string").alias("x")).orderBy("n").collect()]
    assert found == list(texts.values())


def test_zone_edges(spark):
    cases = {
        ("2026-03-08 02:30:00", "America/New_York"): "2026-03-08 07:00:00",
        ("2026-03-08 03:00:00", "America/New_York"): "2026-03-08 07:00:00",
        ("2026-11-01 01:00:00", "America/New_York"): None,
        ("2026-11-01 01:30:00", "America/New_York"): None,
        ("2026-11-01 02:00:00", "America/New_York"): "2026-11-01 07:00:00",
        ("2026-03-29 01:30:00", "Europe/London"): "2026-03-29 01:00:00",
        ("2026-10-04 02:10:00", "Australia/Lord_Howe"): "2026-10-03 15:30:00",
        ("2011-12-30 12:00:00", "Pacific/Apia"): "2011-12-30 10:00:00",
        ("2026-06-01 12:00:00", "UTC"): "2026-06-01 12:00:00",
        ("2199-03-10 02:30:00", "America/New_York"): "2199-03-10 07:00:00",
        ("2301-03-10 02:30:00", "America/New_York"): "2301-03-10 07:00:00",
        ("2301-11-03 01:30:00", "America/New_York"): None,
        ("2301-11-03 02:00:00", "America/New_York"): "2301-11-03 07:00:00",
        ("2701-03-10 02:30:00", "America/New_York"): "2701-03-10 07:00:00",
        ("5101-11-03 01:30:00", "America/New_York"): None,
    }
    clock = F.col("c")
    rows = spark.createDataFrame([(n, c, z) for n, (c, z) in enumerate(cases)], "n int, c string, z string")
    rows = rows.withColumn("c", F.col("c").cast("timestamp_ntz"))
    instant = F.lit(None).cast("timestamp")
    for zone in {z for _, z in cases}:
        instant = F.when(F.col("z") == zone, localised(clock, zone)).otherwise(instant)
    found = [r["x"] for r in rows.select("n", instant.cast("string").alias("x")).orderBy("n").collect()]
    assert found == list(cases.values())


def test_zone_shift_listing():
    new_york = {shift[3].year: shift for shift in zone_shifts("America/New_York") if shift[0] == "gap"}
    assert new_york[2026][1:] == (datetime(2026, 3, 8, 2), datetime(2026, 3, 8, 3), datetime(2026, 3, 8, 7))
    assert zone_shifts("UTC") == ()


def test_strip_and_whole_numbers(spark):
    padded = [(BLANKS + "x y" + BLANKS,), ("é",), ("​z",), ("",), (None,)]
    rows = spark.createDataFrame(padded, "t string")
    assert [r[0] for r in rows.select(stripped(F.col("t"))).collect()] == [
        p[0].strip() if p[0] is not None else None for p in padded
    ]
    numbers = spark.createDataFrame([("7",), ("+7",), ("7.0",), ("7.5",), ("",), ("9223372036854775808",)], "t string")
    assert [r[0] for r in numbers.select(whole_number(F.col("t"))).collect()] == [7, 7, 7, None, None, None]


def test_dedupe_limits_before_the_exchange(spark):
    plan = N.dedupe_last(feed(spark, {}), ["n"], ["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_staging_cuts_fractions(spark):
    raw = feed(spark, {"timestamp": "2026-03-13 09:30:00.75", "close": "58.4500005"})
    bars = N.normalize(raw, NEW_YORK, ["n"], NOW)
    second = N.stage(bars, NEW_YORK).select(F.col("price_ts").cast("string"), "close_price").first()
    assert tuple(second) == ("2026-03-13 13:30:00", Decimal("58.450001"))
    micro = N.stage(bars, replace(NEW_YORK, granularity="microsecond"))
    assert micro.select(F.col("price_ts").cast("string")).first()[0] == "2026-03-13 13:30:00.75"


def test_staging_shuffles_once_and_joins_without_another(spark):
    sent = ["2026-03-13 09:30:00.25", "2026-03-13 09:30:00.75", "2026-03-13 09:30:00.75", "2026-03-13 09:31:00"]
    raw = feed(spark, *[{"timestamp": t, "volume": str(100 + n)} for n, t in enumerate(sent)])
    rows = N.accepted(N.tag(raw, NEW_YORK, NOW, ["n"]), ["n"])
    once = N.stage_last(rows, NEW_YORK, ["n"])
    text = [F.col(c).cast("string") for c in once.columns]
    expected = N.stage(N.normalize(raw, NEW_YORK, ["n"], NOW), NEW_YORK)
    assert sorted(once.select(*text).collect()) == sorted(expected.select(*text).collect())
    assert once.count() == 3
    both = once.join(once.select("source_name", "symbol", "price_ts", "volume"), ["source_name", "symbol", "price_ts"])
    plan = both.hint("merge")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2, plan
    assert "Exchange" not in plan.split("FileScan")[0].split("WindowGroupLimit")[0], plan


def test_spelled_numbers_are_taken_apart_once(spark):
    plan = spark.createDataFrame([("1",)], "t string").select(whole_number(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") <= 8, plan
    texts = ["12", "-12.50", "1.25e2", "1.25e1", "+7.", ".5", "5e-1", "50e-1", "0.0", "-.0e9", "e5", ".", "1e30", "0.000000000000000000000012e24", "1" + "0" * 30 + "e-25"]
    found = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").orderBy("n").select(whole_number(F.col("t"))).collect()
    assert [r[0] for r in found] == [12, None, 125, None, 7, None, None, 5, 0, 0, None, None, None, 12, 100000]

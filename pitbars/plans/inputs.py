"""Feeds, actions and runs derived from the warehouse tables.

Only used by the registered queries and the bench; every derivation covers its
whole table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitbars.contract import FeedContract, RowRules, TradingHours
from pitbars.operators.adjust import in_scope
from pitbars.operators.ledger import failure_document, with_rates
from pitbars.operators.merge import first_load, temporal_merge, temporal_merge_in_place
from pitbars.operators.normalize import DAY, accepted, stage_last, tag
from pitbars.schemas import BAR_COLUMNS

# Source and symbol, None for any.
Listing = tuple[str | None, str | None]

ORDER = tuple(f"o{n}" for n in range(1, 9))
NOW = datetime(2030, 1, 1)
FIRST_LOAD = datetime(2024, 1, 1)
BETWEEN = datetime(2024, 1, 15)
RESTATED = datetime(2024, 2, 1)
RESENT = datetime(2024, 2, 5)

VENDOR_A = FeedContract("vendor_a", "UTC")
VENDOR_A_UNCHECKED = FeedContract(
    "vendor_a", "UTC", rules=RowRules(positive_prices=False, non_negative_volume=False, high_low_envelope=False)
)
VENDOR_B = FeedContract(
    "vendor_b",
    "America/New_York",
    columns={
        "symbol": "ticker", "timestamp": "traded", "open": "px", "high": "px_high", "low": "px_low",
        "close": "px_last", "volume": "units", "currency": "ccy",
    },
)
EXCHANGE = FeedContract(
    "exchange",
    "America/New_York",
    hours=TradingHours(enabled=True, holidays=frozenset({"2024-01-01", "2024-01-15", "2024-02-19"})),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def feed(spark: SparkSession, sf_dir: str, restated: bool = False) -> DataFrame:
    """Order lines as a vendor feed with faults, plus order columns o1..o8.

    The restated feed sends every line again: lines taxed 5% or more with a
    corrected close, returned lines under the next day.
    """
    line = table(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey")
    price, size = _money(F.col("l_extendedprice")), _money(F.col("l_quantity"))
    close = price + (F.round(F.col("l_discount") * 100) - 5).cast("decimal(18,2)")
    day = F.to_date("l_shipdate")
    sent_close = close
    if restated:
        sent_close = F.when(F.col("l_tax") >= 0.05, close + F.lit("0.25").cast("decimal(18,2)")).otherwise(close)
        day = F.when(F.col("l_returnflag") == "R", F.date_add(day, 1)).otherwise(day)
    supplier = F.col("l_suppkey").cast("string")
    return line.select(
        order.alias("o1"),
        F.col("l_linenumber").alias("o2"),
        F.col("l_partkey").alias("o3"),
        F.col("l_quantity").alias("o4"),
        F.col("l_extendedprice").alias("o5"),
        F.col("l_discount").alias("o6"),
        F.col("l_tax").alias("o7"),
        F.col("l_returnflag").alias("o8"),
        F.when(order % 97 == 0, "  ")
        .when(F.col("l_linenumber") == 1, F.concat(F.lit(" s"), supplier))
        .otherwise(F.concat(F.lit("S"), supplier))
        .alias("symbol"),
        F.when(order % 89 == 0, "bad-date")
        .otherwise(F.concat(day.cast("string"), F.lit(" 14:30:00")))
        .alias("timestamp"),
        F.when(order % 67 == 0, F.concat(F.lit("x"), price.cast("string"))).otherwise(price.cast("string")).alias("open"),
        (price + size).cast("string").alias("high"),
        F.when(order % 61 == 0, "-0.50").otherwise((price - size).cast("string")).alias("low"),
        sent_close.cast("string").alias("close"),
        F.when(order % 83 == 0, "-100")
        .when(order % 79 == 0, "12.5")
        .otherwise((F.col("l_quantity").cast("bigint") * 100).cast("string"))
        .alias("volume"),
        F.when(order % 73 == 0, "n/a").otherwise(close.cast("string")).alias("adjusted_close"),
        F.when(order % 71 == 0, "US")
        .when(F.col("l_returnflag") == "A", "USD")
        .when(F.col("l_returnflag") == "N", "usd")
        .otherwise("EUR")
        .alias("currency"),
    )


def feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a second vendor's feed under other column names."""
    price = _money(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("o1"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("traded"),
        price.cast("string").alias("px"),
        (price + 1).cast("string").alias("px_high"),
        (price - 1).cast("string").alias("px_low"),
        price.cast("string").alias("px_last"),
        F.lit("1e2").alias("units"),
        F.lit(" usd ").alias("ccy"),
    )


def exchange_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bars stamped with New York wall clocks."""
    price = _money(F.col("value") + 1).cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("o1"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        *[price.alias(name) for name in ("open", "high", "low", "close")],
        F.lit("1").alias("volume"),
        price.alias("adjusted_close"),
        F.lit("USD").alias("currency"),
    )


def staged(
    spark: SparkSession, sf_dir: str, restated: bool = False, listing: Listing = (None, None), by_day: bool = False
) -> DataFrame:
    """Bars of the feed; with a *listing*, a source and a symbol, those of the listing."""
    tagged = tag(feed(spark, sf_dir, restated), VENDOR_A, NOW, ORDER)
    return in_scope(stage_last(accepted(tagged, ORDER), VENDOR_A, ORDER, by_day), *listing)


def whole(bars: DataFrame) -> DataFrame:
    """The same bars, of which later steps cannot drop columns.

    Where only a few columns of a feed are wanted beside a use of all of it, its shuffle is so
    used again instead of parsing the feed once more for narrower rows.
    """
    return bars.select(F.explode(F.array(F.struct(*BAR_COLUMNS))).alias("bar")).select("bar.*")


def loaded(spark: SparkSession, sf_dir: str, listing: Listing = (None, None)) -> DataFrame:
    """Versions after the first load."""
    return first_load(staged(spark, sf_dir, listing=listing), FIRST_LOAD)


def merged(spark: SparkSession, sf_dir: str, listing: Listing = (None, None)) -> DataFrame:
    """Versions after the first load and the restatement.

    A filter behind the merge cannot pass its full outer join.  Whoever asks for one *listing* names
    it here, and the filter reaches the scans of the feeds; a merge never mixes listings.
    """
    return temporal_merge(loaded(spark, sf_dir, listing), staged(spark, sf_dir, True, listing), RESTATED)


def merged_twice(spark: SparkSession, sf_dir: str, listing: Listing = (None, None)) -> DataFrame:
    """... and after the original feed was sent once more."""
    return temporal_merge(merged(spark, sf_dir, listing), staged(spark, sf_dir, listing=listing), RESENT)


def merged_in_place(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """The rows of ``merged``, still dealt as their feeds are, for steps by key or by symbol and day."""
    dealt = (DAY,) if by_day else ()
    first = first_load(staged(spark, sf_dir, by_day=by_day), FIRST_LOAD, keep=dealt)
    return temporal_merge_in_place(first, staged(spark, sf_dir, True, by_day=by_day), RESTATED, dealt_by=dealt)


def merged_twice_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``merged_twice``, likewise."""
    return temporal_merge_in_place(merged_in_place(spark, sf_dir), staged(spark, sf_dir), RESENT)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One as-of question per bar, 1 to 50 days after 2023-12-20 by traded size."""
    days = (F.col("volume") / 100).cast("int")
    return whole(staged(spark, sf_dir)).select(
        "source_name",
        F.lower("symbol").alias("symbol"),
        "price_ts",
        (F.lit("2023-12-20").cast("timestamp_ntz").cast("timestamp") + F.make_dt_interval(days=days)).alias("as_of"),
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split per supplier and a dividend for every second one."""
    key = F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier")

    def shaped(rows: DataFrame, day: Column, kind: str, ratio: Column, amount: Column) -> DataFrame:
        return rows.select(
            F.lit("vendor_a").alias("source_name"),
            F.concat(F.lit("S"), key.cast("string")).alias("symbol"),
            day.alias("action_date"),
            F.lit(kind).alias("action_type"),
            ratio.cast("decimal(18,8)").alias("split_ratio"),
            amount.cast("decimal(18,6)").alias("dividend_amount"),
            F.lit("USD").alias("currency"),
        )

    ratio = F.element_at(F.array(*map(F.lit, (2, 3, 4, 7, 10))), (key % 5 + 1).cast("int"))
    amount = (key % 50).cast("decimal(18,2)") / 4
    nothing = F.lit(None)
    splits = shaped(supplier, F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int")), "split", ratio, nothing)
    paid = F.date_add(F.lit("2000-01-01").cast("date"), (key % 200).cast("int"))
    return splits.unionByName(shaped(supplier.where(key % 2 == 0), paid, "dividend", nothing, amount))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per event."""
    event = F.col("event_id")
    failed = F.col("event_type") == "error"
    rejected = event % 17
    counted = table(spark, sf_dir, "events").select(
        event.cast("string").alias("run_id"),
        F.col("event_type").alias("source_name"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        (1000 + event % 7000).alias("duration_ms"),
        (1000 + event % 500).alias("rows_read"),
        rejected.alias("rows_rejected"),
        F.when(failed, 0).otherwise(1000 + event % 500 - rejected).alias("rows_loaded"),
        (event % 90).alias("csv_parse_ms"),
        (400 + event % 300).alias("transform_ms"),
        (event % 150).alias("copy_ms"),
        (event % 250).alias("upsert_ms"),
        (1 + event % 3).alias("run_number"),
        F.col("value"),
        (1000 + event % 500 - rejected).alias("rows_valid"),
        (event % 5).alias("duplicates_dropped"),
        F.when(failed, "failed").otherwise("passed").alias("reconciliation_status"),
        F.when(failed, '{"status":"failed"}').otherwise('{"status":"passed"}').alias("reconciliation"),
        F.when(failed, F.concat(F.lit("feed error stopped in run "), event.cast("string"))).alias("error_message"),
    )
    document = failure_document(F.lit("FeedError"), F.col("error_message"))
    return with_rates(counted).withColumn("failure_summary", F.when(F.col("status") == "failed", F.to_json(document)))

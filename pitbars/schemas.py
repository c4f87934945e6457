"""Column lists and declared schemas of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the canonical bar and of the tables.
KEYS = ("source_name", "symbol", "price_ts")
PRICES = ("open_price", "high_price", "low_price", "close_price")
PAYLOAD = (*PRICES, "volume", "adjusted_close", "currency")
BAR_COLUMNS = (*KEYS, *PAYLOAD)
ASOF_COLUMNS = (*BAR_COLUMNS, "ingested_at", "valid_from", "valid_to")
VERSION_COLUMNS = (*ASOF_COLUMNS, "created_at", "updated_at")

PRICE = T.DecimalType(18, 6)
RATIO = T.DecimalType(18, 8)
EXACT = T.DecimalType(38, 18)

BAR = T.StructType(
    [
        T.StructField("source_name", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price_ts", T.TimestampType(), False),
        T.StructField("open_price", PRICE, False),
        T.StructField("high_price", PRICE, False),
        T.StructField("low_price", PRICE, False),
        T.StructField("close_price", PRICE, False),
        T.StructField("volume", T.LongType(), False),
        T.StructField("adjusted_close", PRICE, True),
        T.StructField("currency", T.StringType(), False),
    ]
)

VERSION = T.StructType(
    [
        *BAR.fields,
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("valid_from", T.TimestampType(), False),
        T.StructField("valid_to", T.TimestampType(), True),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

ACTION = T.StructType(
    [
        T.StructField("source_name", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("action_date", T.DateType(), False),
        T.StructField("action_type", T.StringType(), False),
        T.StructField("split_ratio", RATIO, True),
        T.StructField("dividend_amount", PRICE, True),
        T.StructField("currency", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)

RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_name", T.StringType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), True),
        T.StructField("duration_ms", T.LongType(), True),
        T.StructField("rows_read", T.LongType(), False),
        T.StructField("rows_valid", T.LongType(), False),
        T.StructField("rows_loaded", T.LongType(), False),
        T.StructField("rows_rejected", T.LongType(), False),
        T.StructField("duplicates_dropped", T.LongType(), False),
        T.StructField("throughput_rows_per_sec", T.DecimalType(18, 2), False),
        T.StructField("error_rate", T.DecimalType(9, 6), False),
        T.StructField("csv_parse_ms", T.LongType(), False),
        T.StructField("transform_ms", T.LongType(), False),
        T.StructField("copy_ms", T.LongType(), False),
        T.StructField("upsert_ms", T.LongType(), False),
        T.StructField("reconciliation_status", T.StringType(), False),
        T.StructField("reconciliation", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("failure_summary", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)
RUN_COLUMNS = tuple(RUN.fieldNames())

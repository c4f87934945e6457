"""Vendor CSV in, rejected rows out, and a synthetic feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitbars.operators.normalize import quoted

# Columns that restore the file order: Spark rows have none.
FILE_ORDER = ("feed_file", "feed_block", "feed_row")

# Symbols, first bar and price offsets of the synthetic feed.
SYNTHETIC_SYMBOLS = ("AAPL", "MSFT", "NVDA", "GOOGL", "TSLA", "AMZN", "META", "JPM", "V", "MA")
SYNTHETIC_START = "2026-04-01 09:30:00"
SYNTHETIC_HIGH, SYNTHETIC_LOW, SYNTHETIC_CLOSE = "1.25", "-0.85", "0.35"


# A cell that opens with a quote and is not closed on its line.
OPEN_CELL = r'(?:^|,)"(?:[^"]|"")*$'


class UnbalancedQuotes(ValueError):
    """A file opens a quoted cell that it never closes."""


def wrapped_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files with line breaks within quoted cells, which can't be split at line ends.

    Lines are counted where they lie; only the names of such files come back. A file whose
    quotes are odd in number never closes its last cell and is refused.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").contains('"'))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = lines.groupBy("file").agg(F.count_if(F.col("value").rlike(OPEN_CELL)).alias("open"), (F.sum(quotes) % 2).alias("odd")).where("open > 0")
    found = files.collect()
    if broken := [row["file"] for row in found if row["odd"]]:
        raise UnbalancedQuotes(f"a quoted cell is never closed in: {', '.join(sorted(broken))}")
    return sorted(row["file"] for row in found)


def read_feed(spark: SparkSession, path: str | Sequence[str], multi_line: bool | None = None) -> DataFrame:
    """CSV with a header as strings, plus ``FILE_ORDER``.

    Files with line breaks in quoted cells are found first and read whole; all others are split.
    ``multi_line`` True or False says that all files have such breaks, or none, and saves the look.

    Types are never inferred: a ticker ``NA`` or ``000001`` stays what it is.
    Every file's header is checked against the first.  Within a block rows are
    numbered in reading order, so (file, block, number) is the file order
    however Spark packs blocks into tasks.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if multi_line is None:
        if wrapped := wrapped_files(spark, paths):
            every = {row["file"] for row in spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file")).collect()}
            others = sorted(every.difference(wrapped))
            whole = _rows(spark, wrapped, True)
            return whole.unionByName(_rows(spark, others, False)) if others else whole
    return _rows(spark, paths, bool(multi_line))


def _rows(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    rows = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths)
    )
    return rows.select(
        *map(quoted, rows.columns),
        F.col("_metadata.file_path").alias(FILE_ORDER[0]),
        F.col("_metadata.file_block_start").alias(FILE_ORDER[1]),
        F.monotonically_increasing_id().alias(FILE_ORDER[2]),
    )


def write_rejections(refused: DataFrame, folder: str, source_name: str, run_id: str, rows: int) -> str | None:
    """Rejected rows as CSV under ``folder/source_run``; nothing when there are none."""
    if not rows:
        return None
    path = f"{folder}/{source_name}_{run_id}"
    refused.write.option("header", True).option("escape", '"').csv(path)
    return path


def synthetic_feed(indexed: DataFrame, index: str) -> DataFrame:
    """One bar per index: symbols take turns, each gets one bar per minute."""
    i = F.col(index).cast("bigint")
    symbols = F.array(*[F.lit(s) for s in SYNTHETIC_SYMBOLS])
    turns = len(SYNTHETIC_SYMBOLS)
    minute = F.floor(i / turns).cast("int")
    base = (F.lit(100) + (i % 500).cast("decimal(10,1)") / 10).cast("decimal(12,2)")

    def price(offset: str | None = None):
        value = base if offset is None else base + F.lit(offset).cast("decimal(12,2)")
        return value.cast("decimal(12,2)").cast("string")

    clock = F.lit(SYNTHETIC_START).cast("timestamp_ntz") + F.make_dt_interval(mins=minute)
    return indexed.select(
        symbols[(i % turns).cast("int")].alias("symbol"),
        F.date_format(clock, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        price().alias("open"),
        price(SYNTHETIC_HIGH).alias("high"),
        price(SYNTHETIC_LOW).alias("low"),
        price(SYNTHETIC_CLOSE).alias("close"),
        (i + 100_000).cast("string").alias("volume"),
        price(SYNTHETIC_CLOSE).alias("adjusted_close"),
        F.lit("USD").alias("currency"),
    )


def feed_footprint(spark: SparkSession, path: str) -> DataFrame:
    """One row: columns, rows, file bytes, and bytes per row without headers.

    Sizes come from the file listing; lines are split at LF only, so a CR
    before it is counted.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    header = lines.first()["value"]
    header_bytes = len(header.encode("utf-8")) + 1
    files = spark.read.format("binaryFile").load(path).agg(
        F.sum("length").alias("file_bytes"), F.count("*").alias("files")
    ).first()
    rows = F.count("*") - files["files"]
    data = F.lit(files["file_bytes"] - files["files"] * header_bytes).cast("double")
    return lines.agg(
        F.lit(len(header.split(","))).alias("column_count"),
        rows.alias("rows"),
        (F.floor(data / rows * 10_000) / 10_000).alias("average_bytes_per_row"),
        F.lit(files["file_bytes"]).alias("file_bytes"),
    )

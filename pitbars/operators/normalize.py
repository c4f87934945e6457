"""Vendor rows to canonical bars: rename, parse, validate, tag, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitbars.contract import MANDATORY, OPTIONAL, FeedContract
from pitbars.functions.clock import local_clock, localised, micros_of_day, names_offset, wall_clock, zoned_instant
from pitbars.functions.text import exact_number, is_blank, stripped, whole_number
from pitbars.schemas import BAR_COLUMNS, KEYS, PRICE, PRICES

# Bar column parsed from each price field, and the slack granted
# to clocks that run ahead.
PRICE_FIELDS = {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
FUTURE_SLACK = "INTERVAL 5 MINUTES"
REASON = "rejection_reason"
# Carries the vendor's row; no feed has a column of this name.
VENDOR_ROW = "__vendor_row__"
# The instant as sent, beside the one a row lands under.
SENT_TS = "__sent_ts__"
# The day a row lands on, carried by rows that are dealt by symbol and day.
DAY = "__day__"


class FeedError(ValueError):
    """The feed as a whole does not fit its contract."""


def instant_literal(moment: datetime) -> Column:
    """Literal instant; naive datetimes are taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz").cast("timestamp")


def quoted(name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_header(columns: Sequence[str], contract: FeedContract) -> None:
    """Raise before any job runs when a configured column is absent."""
    absent = sorted(set(contract.columns.values()) - set(columns))
    if absent:
        raise FeedError(f"the feed lacks columns its contract names: {', '.join(absent)}")


def map_columns(raw: DataFrame, contract: FeedContract, keep: Sequence[str] = ()) -> DataFrame:
    """Keep mapped columns under their canonical names; unmapped optional ones are NULL."""
    check_header(raw.columns, contract)
    mapped = [quoted(vendor).cast("string").alias(name) for name, vendor in contract.columns.items()]
    absent = [F.lit(None).cast("string").alias(name) for name in OPTIONAL if name not in contract.columns]
    return raw.select(F.lit(contract.name).alias("source_name"), *mapped, *absent, *keep)


def _parsed(raw: DataFrame, contract: FeedContract, keep: Sequence[str]) -> DataFrame:
    """Stripped text beside every parsed value."""
    vendor = [c for c in raw.columns if c not in keep]
    carried = raw.select("*", F.struct(*map(quoted, vendor)).alias(VENDOR_ROW))
    names = [*MANDATORY, *OPTIONAL]
    mapped = map_columns(carried, contract, [VENDOR_ROW, *keep])
    extra = [c for c in contract.columns if c not in names]

    def cleaned(name: str) -> Column:
        text = stripped(F.col(name))
        if contract.na_values:
            text = F.when(~text.isin(*contract.na_values), text)
        return text.alias(f"t_{name}")

    texts = mapped.select("source_name", VENDOR_ROW, *keep, *[cleaned(n) for n in (*names, *extra)])
    clock = F.col("t_timestamp")
    clocks = texts.select("*", F.when(~names_offset(clock), wall_clock(clock, contract.date_shapes)).alias("clock_ts"))
    return clocks.select(
        "*",
        F.upper("t_symbol").alias("symbol"),
        F.upper("t_currency").alias("currency"),
        F.when(names_offset(clock), zoned_instant(clock, contract.date_shapes))
        .otherwise(localised(F.col("clock_ts"), contract.zone))
        .alias("price_ts"),
        *[exact_number(F.col(f"t_{name}")).alias(bar) for name, bar in PRICE_FIELDS.items()],
        exact_number(F.col("t_adjusted_close")).alias("adjusted_close"),
        whole_number(F.col("t_volume")).alias("volume"),
    )


def _reasons(contract: FeedContract, now: datetime | None) -> list[Column]:
    """One NULL-or-code column per rule, in reporting order."""

    def code(broken: Column, text: str) -> Column:
        return F.when(broken, F.lit(text))

    known = {*contract.columns, *OPTIONAL}
    found = [
        code(is_blank(F.col(f"t_{name}")), f"missing_required:{name}")
        if name in known
        else F.lit(f"missing_column:{name}")
        for name in contract.required
    ]
    found.append(code(is_blank(F.col("symbol")), "invalid_symbol"))
    found.append(code(~F.coalesce(F.col("currency").rlike(r"^[A-Z]{3}\z"), F.lit(False)), "invalid_currency"))

    bar_ts = F.col("price_ts")
    found.append(code(bar_ts.isNull(), "invalid_timestamp"))
    if not contract.rules.allow_future:
        clock = F.current_timestamp() if now is None else instant_literal(now)
        found.append(code(bar_ts > clock + F.expr(FUTURE_SLACK), "future_timestamp"))

    found += [code(F.col(bar).isNull(), f"invalid_number:{bar}") for bar in PRICES]
    found.append(code(F.col("volume").isNull(), "invalid_integer:volume"))
    if contract.rules.positive_prices:
        found += [code(F.col(bar) <= 0, f"non_positive_price:{bar}") for bar in (*PRICES, "adjusted_close")]
    if contract.rules.non_negative_volume:
        found.append(code(F.col("volume") < 0, "negative_volume"))
    if contract.rules.high_low_envelope:
        found.append(code(outside_envelope(), "invalid_high_low_envelope"))
    if contract.hours.enabled:
        found += calendar_codes(bar_ts, contract)
    return found


def outside_envelope() -> Column:
    """High is not the highest or low not the lowest of four known prices."""
    all_known = F.lit(True)
    for bar in PRICES:
        all_known = all_known & F.col(bar).isNotNull()
    return all_known & (
        (F.col("high_price") < F.greatest(*PRICES)) | (F.col("low_price") > F.least(*PRICES))
    )


def calendar_codes(instant: Column, contract: FeedContract) -> list[Column]:
    """Weekend, holiday and hours codes on the source's wall clock; they may stack."""
    clock = local_clock(instant, contract.zone)
    hours = contract.hours

    def micros(bound) -> int:
        return ((bound.hour * 60 + bound.minute) * 60 + bound.second) * 1_000_000 + bound.microsecond

    codes = [F.when(F.weekday(clock) >= 5, F.lit("market_closed_weekend"))]
    if hours.holidays:
        closed = F.date_format(clock, "yyyy-MM-dd").isin(*sorted(hours.holidays))
        codes.append(F.when(closed, F.lit("market_closed_holiday")))
    open_now = micros_of_day(clock).between(micros(hours.opens), micros(hours.closes))
    codes.append(F.when(~open_now, F.lit("outside_market_hours")))
    return codes


def tag(
    raw: DataFrame, contract: FeedContract, now: datetime | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Canonical columns, the untouched vendor row, and why the row is rejected ('' = accepted).

    Narrow: no shuffle, and no Python in the row path.  *order* names columns
    that hold the file order; they are carried along, not part of the feed.
    """
    parsed = _parsed(raw, contract, order)
    judged = parsed.select(*BAR_COLUMNS, F.concat_ws("; ", *_reasons(contract, now)).alias("codes"), VENDOR_ROW, *order)
    # The one-element explode keeps Catalyst from pasting every rule into each
    # later filter on the reason, which multiplies plan size and planning time.
    return judged.select(*BAR_COLUMNS, F.explode(F.array("codes")).alias(REASON), VENDOR_ROW, *order)


def accepted(tagged: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows that broke no rule."""
    return tagged.where(F.col(REASON) == "").select(*BAR_COLUMNS, *order)


def rejected(tagged: DataFrame) -> DataFrame:
    """Rows as the vendor sent them, plus every reason."""
    return tagged.where(F.col(REASON) != "").select(f"{VENDOR_ROW}.*", REASON)


def dedupe_last(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Last row per key by *order*.

    Ranking against the constant 1 plans as a group limit below and above the
    exchange, so each task ships at most one row per key: a key repeated a
    billion times is reduced before it is shuffled.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc() for name in order])
    return rows.withColumn("nth", F.row_number().over(latest)).where("nth = 1").drop("nth", *order)


def normalize(
    raw: DataFrame, contract: FeedContract, order: Sequence[str], now: datetime | None = None
) -> DataFrame:
    """Accepted, deduplicated bars of one feed."""
    return dedupe_last(accepted(tag(raw, contract, now, order), order), order)


def run_counters(tagged: DataFrame) -> DataFrame:
    """Read, valid, rejected and dropped rows; read = valid + rejected + dropped.

    Keys are counted by grouping before the sum, so no task sees one key's rows.
    """
    good = F.col(REASON) == ""
    per_key = tagged.groupBy(*KEYS, good.alias("ok")).agg(F.count("*").alias("n"))
    read = F.coalesce(F.sum("n"), F.lit(0))
    valid = F.count_if(F.col("ok"))
    refused = F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0))
    return per_key.agg(
        read.alias("rows_read"),
        valid.alias("rows_valid"),
        refused.alias("rows_rejected"),
        (read - valid - refused).alias("duplicates_dropped"),
    )


def reason_counts(tagged: DataFrame) -> DataFrame:
    """How often each code occurs; a row counts once for every code it carries."""
    codes = tagged.where(F.col(REASON) != "").select(F.explode(F.split(REASON, "; ")).alias("reason"))
    return codes.groupBy("reason").agg(F.count("*").alias("rows"))


def stage(bars: DataFrame, contract: FeedContract, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Cast to landing types; whole seconds unless the contract keeps microseconds.

    Values that do not fit become NULL and are caught by the landing checks.
    *keep* names further columns to carry.
    """
    instant = F.col("price_ts")
    if contract.granularity == "second":
        instant = F.date_trunc("second", instant)
    return bars.select(
        "source_name",
        "symbol",
        instant.alias("price_ts"),
        *[F.col(name).try_cast(PRICE).alias(name) for name in PRICES],
        "volume",
        F.col("adjusted_close").try_cast(PRICE).alias("adjusted_close"),
        "currency",
        *keep,
    )


def stage_last(
    rows: DataFrame, contract: FeedContract, order: Sequence[str], by_day: bool = False
) -> DataFrame:
    """What ``stage`` makes of the last accepted row per key, with one shuffle for this and the merge.

    Rows are cast before they are shuffled, which makes them half as wide, and dealt by the
    key they land under; keys that fall into one second stay apart by their instant.  A join
    on the landing key then finds both sides dealt and sorted.  Nothing is sorted before the
    shuffle: feeds that send keys very many times are better served by ``dedupe_last`` alone.
    *by_day* deals by symbol and day instead, for steps that gather a symbol's days, and keeps the
    day as a column: the planner follows columns through unions, not what is computed from them.
    """
    cast = stage(rows, contract, [F.col("price_ts").alias(SENT_TS), *order])
    # One feed has one source, a literal here, which the planner drops from join keys.
    if by_day:
        dealt = cast.withColumn(DAY, F.to_date("price_ts")).repartition("symbol", DAY)
        return dedupe_last(dealt, order, (*KEYS, DAY, SENT_TS)).drop(SENT_TS)
    dealt = cast.repartition("symbol", "price_ts")
    return dedupe_last(dealt, order, (*KEYS, SENT_TS)).drop(SENT_TS)


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Bars of several sources as one frame; each row already names its source."""
    whole = feeds[0]
    for feed in feeds[1:]:
        whole = whole.unionByName(feed)
    return whole

"""Adjusted close from splits and dividends."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitbars.operators.merge import current
from pitbars.operators.normalize import instant_literal
from pitbars.schemas import BAR_COLUMNS, PRICE, RATIO

# Working precision of the fold; results keep six digits, rounded half to even.
WORKING = "decimal(32,20)"
WHOLE = "decimal(38,0)"
# Whole numbers within this are added to and subtracted from without leaving 64 bits.
SAFE = 2**62
LISTED = ("source_name", "symbol")
SHOWN = ("action_date", "action_type", "split_ratio", "dividend_amount")


def in_scope(rows: DataFrame, source: str | None = None, symbol: str | None = None) -> DataFrame:
    """Rows of one source and/or symbol; the symbol argument is upper-cased."""
    if source is not None:
        rows = rows.where(F.col("source_name") == source)
    if symbol is not None:
        rows = rows.where(F.col("symbol") == F.upper(F.lit(symbol)))
    return rows


def action_lists(actions: DataFrame) -> DataFrame:
    """One date-ordered list of actions per listing, and what runs of the newest of them do to a price.

    (source, symbol, date, type) is unique, so a list holds at most two entries
    per calendar day: its length is bounded by the calendar, not by the data.

    Every action is an affine map of a price in millionths, and so is every run of
    actions: x -> (a * x - b) / d in whole numbers.  ``maps[k]`` composes the newest
    k actions and is made once per listing from ``maps[k - 1]``.  Numbers beyond 38
    digits make a map, and those of longer runs, NULL; such bars are folded.
    ``short_maps`` are the same in 64 bits, NULL where a number has more.
    """
    ratio = F.col("split_ratio").cast(RATIO)
    digits = F.coalesce(*[F.when(ratio == F.round(ratio, n), F.lit(n)) for n in range(RATIO.scale)], F.lit(RATIO.scale))
    below = F.pow(F.lit(10), digits).cast(WHOLE)
    entry = F.struct(
        "action_date",
        "action_type",
        "split_ratio",
        "dividend_amount",
        F.when(ratio > 0, (F.col("split_ratio") * below).cast(WHOLE)).alias("ratio_above"),
        F.when(ratio > 0, below).alias("ratio_below"),
        millionths(F.col("dividend_amount")).alias("amount"),
    )
    listed = actions.groupBy(*LISTED).agg(F.array_sort(F.collect_list(entry)).alias("steps"))
    nothing = F.array(F.struct(*[F.lit(n).cast(WHOLE).alias(name) for n, name in ((1, "a"), (0, "b"), (1, "d"))]))

    def longer(maps: Column, action: Column) -> Column:
        a, b, d = (F.element_at(maps, -1)[name] for name in "abd")
        above, below = action["ratio_above"], action["ratio_below"]
        split = (F.try_multiply(a, below), F.try_multiply(b, above), F.try_multiply(d, above))
        paid = (a, F.try_add(b, F.try_multiply(a, action["amount"])), d)
        is_split = action["action_type"] == "split"
        is_paid = (action["action_type"] == "dividend") & action["amount"].isNotNull()
        parts = [
            F.when(is_split, by_split).when(is_paid, by_pay).otherwise(same).cast(WHOLE).alias(name)
            for name, same, by_split, by_pay in zip("abd", (a, b, d), split, paid)
        ]
        return F.concat(maps, F.array(F.struct(*parts)))

    shown = F.transform("steps", lambda a: F.struct(*[a[name].alias(name) for name in SHOWN]))
    days = F.transform("steps", lambda action: action["action_date"])
    powers = F.sequence(F.length(F.bin(F.size("steps"))) - 1, F.lit(0))
    strides = F.transform(powers, lambda power: F.pow(F.lit(2), power).cast("int"))
    mapped = listed.select(
        *LISTED,
        shown.alias("actions"),
        days.alias("action_days"),
        strides.alias("strides"),
        F.aggregate(F.reverse("steps"), nothing, longer).alias("maps"),
    )
    short = F.transform("maps", lambda run: F.struct(*[run[name].try_cast("bigint").alias(name) for name in "abd"]))
    return mapped.withColumn("short_maps", short)


def up_to(days: Column, strides: Column, day: Column) -> Column:
    """How many of the sorted *days* are not after *day*, by strides that halve."""

    def advanced(passed: Column, stride: Column) -> Column:
        return passed + F.when(F.get(days, passed + stride - 1) <= day, stride).otherwise(0)

    return F.aggregate(strides, F.lit(0), advanced)


def with_listing(bars: DataFrame, actions: DataFrame, zone: str) -> DataFrame:
    """Bars beside their listing's actions and maps, and how many actions are dated after them.

    A join on the listing, left to the planner: lists below its byte threshold
    are broadcast, others are shuffled, and a popular listing is split by its
    bars, whose partner is one row.
    """
    joined = bars.join(action_lists(actions), list(LISTED), "left")
    day = F.to_date(F.from_utc_timestamp("price_ts", zone))
    later = F.size("actions") - up_to(F.col("action_days"), F.col("strides"), day)
    return joined.withColumn("later", F.when(F.col("actions").isNotNull(), later))


def later_actions() -> Column:
    """The newest `later` actions of a row of `with_listing`, oldest first; NULL without a listing."""
    return F.slice("actions", F.size("actions") - F.col("later") + 1, F.col("later"))


def with_actions(bars: DataFrame, actions: DataFrame, zone: str = "UTC") -> DataFrame:
    """Bars beside the actions dated after them; bars never multiply."""
    held = with_listing(bars, actions, zone)
    return held.select(*bars.columns, later_actions().alias("actions"))


def millionths(price: Column) -> Column:
    """A price as a whole number of its last digit."""
    return (price.cast(PRICE) * F.lit(10**PRICE.scale)).cast(WHOLE)


def composed(bars: DataFrame, close: str) -> DataFrame:
    """`above` over `below` in millionths: the close of rows of `with_listing` after their later actions.

    Columns of their own, so that each is computed once; NULL without later
    actions or if a number has more than 38 digits.  Where 64 bits do, as for nearly
    all bars, they are `short_above` and `short_below` instead, several times as fast.
    """
    adjusted = F.col("later") > 0
    run = F.when(adjusted, F.get("short_maps", F.col("later")))
    units = (F.col(close).cast(PRICE) * F.lit(10**PRICE.scale)).try_cast("bigint")
    value = F.try_subtract(F.try_multiply(F.col("short.a"), F.col("units")), F.col("short.b"))
    held = bars.withColumn("short", run).withColumn("units", units).withColumn("value", value)
    fits = F.col("value").between(-SAFE, SAFE) & F.col("short.d").between(1, SAFE)
    held = held.withColumn("short_above", F.when(fits, F.col("value"))).withColumn("short_below", F.col("short.d"))
    run = F.when(adjusted & F.col("short_above").isNull(), F.get("maps", F.col("later")))
    above = F.try_subtract(F.try_multiply(F.col("run.a"), millionths(F.col(close))), F.col("run.b"))
    held = held.withColumn("run", run).withColumn("above", above).withColumn("below", F.col("run.d"))
    return held.withColumn("quotient", F.try_divide("above", "below"))


def half_even(above: Column, below: Column) -> Column:
    """Quotient of bigints within `SAFE`, rounded half to even."""
    rest = F.pmod(above, below)
    down = F.call_function("div", above - rest, below)
    return down + F.when((rest > below - rest) | ((rest == below - rest) & (down % 2 != 0)), 1).otherwise(0)


def nearest() -> Column:
    """The price of a row of `composed`, rounded half to even.

    Nothing is rounded before, so ratios such as 3 or 7 are exact.  A quotient
    that six more decimals show as a tie is decided by the remainder.
    """
    above, below, quotient = F.col("above"), F.col("below"), F.col("quotient")
    rest = F.pmod(above, below)
    down = ((above - rest) / below).cast(WHOLE)
    up = (rest > below - rest) | ((rest == below - rest) & (down % 2 != 0))
    decided = down + F.when(up, 1).otherwise(0).cast(WHOLE)
    plain = F.abs(quotient % 1) != F.lit(Decimal("0.5"))
    short = half_even(F.col("short_above"), F.col("short_below")).cast(WHOLE)
    long = F.when(plain, F.bround(quotient).cast(WHOLE)).otherwise(decided.cast(WHOLE))
    whole = F.when(F.col("short_above").isNotNull(), short).otherwise(long)
    return (whole * F.lit(Decimal(1).scaleb(-PRICE.scale))).try_cast(PRICE)


def folded(close: Column, actions: Column) -> Column:
    """Fold the later actions over the close, oldest first, with 20 decimals.

    A split divides and a dividend subtracts, so order matters.  A value beyond
    the working precision becomes NULL and is refused by the caller's checks.
    """

    def step(value: Column, action: Column) -> Column:
        split = (value / action["split_ratio"]).try_cast(WORKING)
        dividend = (value - action["dividend_amount"]).try_cast(WORKING)
        return (
            F.when(action["action_type"] == "split", split)
            .when((action["action_type"] == "dividend") & action["dividend_amount"].isNotNull(), dividend)
            .otherwise(value)
        )

    return F.bround(F.aggregate(actions, close.cast(WORKING), step), 6).try_cast(PRICE)


def adjust_close(
    versions: DataFrame,
    actions: DataFrame,
    source: str | None = None,
    symbol: str | None = None,
    recorded_at: datetime | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Recompute ``adjusted_close`` of every version in scope, closed ones included.

    Rows without later actions get their close.  Returns only the rows in scope.
    """
    scoped = in_scope(versions, source, symbol)
    listed = in_scope(actions, source, symbol)
    columns = scoped.columns
    held = composed(with_listing(scoped, listed, zone), "close_price")
    value = F.coalesce(nearest(), folded(F.col("close_price"), later_actions()))
    result = held.withColumn("adjusted_close", F.when(F.col("later") > 0, value).otherwise(F.col("close_price")))
    if recorded_at is not None:
        result = result.withColumn("updated_at", instant_literal(recorded_at))
    return result.select(*columns)


def adjusted_bars(
    versions: DataFrame, actions: DataFrame, source: str | None = None, symbol: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Adjusted active bars in staging shape, to be merged as a new belief."""
    return adjust_close(current(versions), actions, source, symbol, zone=zone).select(*BAR_COLUMNS)

"""Feed timestamps: lenient text, zone rules, instants.

Instants are ``timestamp`` columns under a UTC session; wall clocks are
``timestamp_ntz``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitbars.functions.text import let

# A clock time, then what says its offset: Z, UTC, GMT, a number, or any other name.
ZONED = (
    r"^(.*\d:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[AaPp][Mm]\b)?|\d{8}T\d{4}(?:\d{2})?)\s*"
    r"(?!(?i:[ap]m)$)([+-]\d{1,2}(?::?\d{2})?|[A-Za-z][A-Za-z0-9_/+-]*)$"
)
NUMERIC = r"^([+-])(\d{1,2}):?(\d{2})?$"
# Nothing but a date and a clock time; any other text is left to the shapes.
ISO = r"^\d{4}(?:-\d{1,2}(?:-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)?)?)?$"
# Shifts are listed for these years.  The rule in force at the end repeats with
# the calendar every 400 years, so later clocks are moved into the last 400.
FIRST_YEAR, LAST_YEAR = 1800, 2500
CYCLE_YEARS, CYCLE_DAYS = 400, 146_097


# A clock time after the start, a space, a comma or a T: hour, then minutes and seconds and perhaps am or pm,
# or am or pm at once; an hour alone counts after a full date only.
CLOCK = (
    r"(?:^|(?<=[T,\s])|(?<=\d{4}-\d\d-\d\dT))(\d{1,2})"
    r"(?::(\d{1,2})(?::(\d{1,2})(?:\.(\d+))?)?(?:\s*([AaPp])\.?[Mm]\b\.?)?|\s*([AaPp])\.?[Mm]\b\.?|(?<=^\d{4}-\d\d-\d\d[T ]\d{1,2})$)"
    r"(?=$|[\s,])"
)
# English names of days and months.
DAY_NAME = r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_NAME = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
    r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
NUMBER = r"(\d{4}|\d{1,2})"
ORDINAL = r"(?:st|nd|rd|th)?"
# Number groups are: the one before the name, the two after it.
NAMED = rf"(?i)^(?:{NUMBER}{ORDINAL}[-/., ]+)?{MONTH_NAME}\b\.?(?:[-/., ]*{NUMBER}{ORDINAL}\b)?(?:[-/., ]+{NUMBER})?$"
NUMERIC_DATE = r"^(\d{4}|\d{1,2})([-/. ])(\d{1,2})(?:\2(\d{4}|\d{1,2}))?$"
MONTH_OF_YEAR = r"^(\d{1,2})[-/.](\d{4})$"
COMPACT = r"^(\d{4})(\d\d)(\d\d)(?:T(\d\d)(\d\d)(\d\d)?)?$"


def names_offset(text: Column) -> Column:
    """Text states its own offset or zone; most text is cleared by its last six characters."""
    return F.right(text, F.lit(6)).rlike("[A-Za-z+-]") & text.rlike(ZONED)


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _full_year(text: Column) -> Column:
    """Years of two digits are of 1969 to 2068."""
    year = _number(text)
    return F.when(F.length(text) == 4, year).when(year < 69, year + 2000).otherwise(year + 1900)


def written_clock(text: Column) -> Column:
    """Wall clock of a date and perhaps a time in the usual spellings; NULL if it is none.

    The clock time is recognised first, then day names go; what is left has to be a date as a whole.
    Its numbers get their roles by form and range: four digits are the year; with a month's name the
    other number is the day; else the first of two is the month unless it exceeds 12. Without a day it
    is the first of the month.
    """
    rest = F.regexp_replace(text, CLOCK, " ")
    rest = F.regexp_replace(F.regexp_replace(rest, DAY_NAME, " "), r"(?<=\d)T(?=\s|$)|,(?=\s|$)|^\s*,", " ")
    rest = F.btrim(F.regexp_replace(rest, r"\s+", " "))
    clock = [F.regexp_extract(text, CLOCK, n) for n in range(1, 5)]
    half = F.lower(F.concat(F.regexp_extract(text, CLOCK, 5), F.regexp_extract(text, CLOCK, 6)))

    def of(date: Column) -> Column:
        compact = [F.regexp_extract(date, COMPACT, n) for n in range(1, 7)]
        pieces = F.when(date.rlike(COMPACT), F.struct(*(x.alias(n) for x, n in zip((*map(_number, compact[:3]), *compact[3:]), ("y", "m", "d", "hh", "mi", "ss")))))
        a, b, c = (F.regexp_extract(date, NUMERIC_DATE, n) for n in (1, 3, 4))
        swapped = _number(a) > 12
        nothing = [F.lit("").alias(n) for n in ("hh", "mi", "ss")]

        def found(year: Column, month: Column, day: Column) -> Column:
            return F.struct(year.alias("y"), month.alias("m"), day.alias("d"), *nothing)

        one = F.lit(1)
        numeric = F.when(F.length(a) == 4, found(_number(a), _number(b), F.coalesce(_number(c), one))).when(
            F.length(c) > 0, found(_full_year(c), F.when(swapped, _number(b)).otherwise(_number(a)), F.when(swapped, _number(a)).otherwise(_number(b)))
        )
        before, name, one_after, two_after = (F.regexp_extract(date, NAMED, n) for n in range(1, 5))
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.left(name, F.lit(3)))).cast("int")
        given = F.filter(F.array(before, one_after, two_after), lambda x: F.length(x) > 0)
        first, second = F.get(given, 0), F.get(given, 1)
        named = F.when(F.size(given) == 1, F.when(F.length(first) == 4, found(_number(first), month, one))).when(
            F.size(given) == 2,
            F.when(F.length(first) == 4, F.when(F.length(second) < 3, found(_number(first), month, _number(second)))).otherwise(
                found(_full_year(second), month, _number(first))
            ),
        )
        year_last = found(_number(F.regexp_extract(date, MONTH_OF_YEAR, 2)), _number(F.regexp_extract(date, MONTH_OF_YEAR, 1)), one)
        return F.coalesce(
            pieces, F.when(date.rlike(NUMERIC_DATE), numeric), F.when(date.rlike(NAMED), named), F.when(date.rlike(MONTH_OF_YEAR), year_last)
        )

    def at(date: Column) -> Column:
        timed = date["hh"] != ""  # a compact time
        hour, minute = (F.coalesce(_number(F.when(timed, date[n]).otherwise(x)), F.lit(0)) for n, x in zip(("hh", "mi"), clock))
        second = F.coalesce(_number(F.when(timed, date["ss"]).otherwise(clock[2])), F.lit(0))
        micros = F.when(timed, F.lit(0)).otherwise(F.coalesce(_number(F.rpad(F.left(clock[3], F.lit(6)), 6, "0")), F.lit(0)))
        hour = F.when(half == "", hour).when(hour.between(1, 12) & ~timed, hour % 12 + F.when(half == "p", 12).otherwise(0))
        exact = (second + micros.cast("decimal(12,0)") / 1_000_000).cast("decimal(8,6)")
        # A time of its own beside a compact one is no clock time.
        sound = (second < 60) & ~(timed & (clock[0] != ""))
        return F.when(sound, F.try_make_timestamp_ntz(date["y"], date["m"], date["d"], hour, minute, exact))

    return let(let(rest, of), at)


def wall_clock(text: Column, shapes: Sequence[str] = ()) -> Column:
    """Wall clock of text without an offset: ISO first, then each shape in turn, then any usual spelling.

    No path accepts text that goes on after the clock time.
    """
    others = [F.try_to_timestamp(text, F.lit(shape)).cast("timestamp_ntz") for shape in shapes]
    return F.coalesce(F.when(text.rlike(ISO), text.try_cast("timestamp_ntz")), *others, F.when(text.rlike(r"\d"), written_clock(text)))


def zoned_instant(text: Column, shapes: Sequence[str] = ()) -> Column:
    """Instant of text that states its offset or zone; NULL for an unknown zone."""
    clock = wall_clock(F.regexp_extract(text, ZONED, 1), shapes)
    zone = F.regexp_extract(text, ZONED, 2)
    hours, minutes = F.lpad(F.regexp_extract(zone, NUMERIC, 2), 2, "0"), F.regexp_extract(zone, NUMERIC, 3)
    offset = F.concat(F.left(zone, F.lit(1)), hours, F.lit(":"), F.rpad(minutes, 2, "0"))
    named = F.when(F.upper(zone).isin("Z", "UTC", "GMT"), F.lit("Z")).when(zone.rlike("^[+-]"), offset)
    stated = F.coalesce(named, F.concat(F.lit(" "), zone))
    return F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), stated).try_cast("timestamp")


@lru_cache(maxsize=None)
def zone_shifts(zone: str) -> tuple[tuple, ...]:
    """Offset changes of *zone*: (kind, local start, local end, instant), naive UTC instant.

    ``gap`` hours never appear on the wall clock, ``overlap`` hours appear twice.
    """
    info = ZoneInfo(zone)

    def offset(moment: datetime) -> timedelta:
        return moment.replace(tzinfo=timezone.utc).astimezone(info).utcoffset()

    found = []
    day = timedelta(days=1)
    left = datetime(FIRST_YEAR, 1, 1)
    before = offset(left)
    while left.year < LAST_YEAR:
        right = left + day
        after = offset(right)
        if after != before:
            low, high = left, right
            while high - low > timedelta(seconds=1):
                middle = low + timedelta(seconds=(high - low).total_seconds() // 2)
                low, high = (middle, high) if offset(middle) == before else (low, middle)
            kind = "gap" if after > before else "overlap"
            first, last = sorted((high + before, high + after))
            found.append((kind, first, last, high))
        left, before = right, after
    return tuple(found)


def _by_year(zone: str) -> list[list[tuple]]:
    """Shifts of the zone listed under every calendar year they touch."""
    years = [[] for _ in range(LAST_YEAR - FIRST_YEAR + 1)]
    for kind, first, last, instant in zone_shifts(zone):
        for year in range(first.year, (last - timedelta(microseconds=1)).year + 1):
            years[year - FIRST_YEAR].append((first, last, instant if kind == "gap" else None))
    return years


NEVER = datetime(1, 1, 1)


def _clocks(moments: Iterable[datetime | None]) -> Column:
    """Literal array of wall clocks, ``NEVER`` where there is none.

    Written as one text that the optimizer folds: hundreds of separate literals
    would slow down every planning step.
    """
    text = ",".join((moment or NEVER).isoformat() for moment in moments)
    return F.split(F.lit(text), ",").cast("array<timestamp_ntz>")


def localised(clock: Column, zone: str) -> Column:
    """Instant of a wall clock in *zone*.

    A skipped wall clock moves to the instant of the shift; a repeated one is
    ambiguous and becomes NULL.  Shifts are looked up by year in literal arrays.
    """
    if zone == "UTC":
        return clock.cast("timestamp")
    if not zone_shifts(zone):
        return F.to_utc_timestamp(clock.cast("timestamp"), zone)
    cycles = F.greatest(F.lit(0), F.floor((F.year(clock) - (LAST_YEAR - CYCLE_YEARS)) / CYCLE_YEARS)).cast("int")
    ahead = F.make_dt_interval(days=cycles * CYCLE_DAYS)
    return _listed(clock - ahead, zone) + ahead


def _listed(clock: Column, zone: str) -> Column:
    """The same for a clock of a listed year."""
    plain = F.to_utc_timestamp(clock.cast("timestamp"), zone)
    years = _by_year(zone)
    nth_year = F.year(clock) - FIRST_YEAR
    instant = plain
    for slot in range(max(len(shifts) for shifts in years)):
        taken = [shifts[slot] if slot < len(shifts) else (None, None, None) for shifts in years]
        start, end, moved_to = (F.get(_clocks(part), nth_year) for part in zip(*taken))
        shifted = F.nullif(moved_to, F.lit(NEVER.isoformat()).cast("timestamp_ntz")).cast("timestamp")
        instant = F.when((clock >= start) & (clock < end), shifted).otherwise(instant)
    return instant


def local_clock(instant: Column, zone: str) -> Column:
    """Wall clock shown in *zone* at an instant."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def micros_of_day(clock: Column) -> Column:
    """Microseconds since local midnight, so clock comparisons stay sub-second exact."""
    whole = F.hour(clock) * 3600 + F.minute(clock) * 60
    return whole.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint")

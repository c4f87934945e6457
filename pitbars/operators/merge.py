"""Bitemporal merge: corrections close the old belief and open a new one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitbars.operators.normalize import instant_literal
from pitbars.schemas import BAR_COLUMNS, KEYS, PAYLOAD, VERSION_COLUMNS

CHANGE = "change"
# What a version has beside its join keys.
HELD = tuple(c for c in VERSION_COLUMNS if c not in KEYS)
CHANGES = ("carried", "inserted", "closed", "corrected", "unchanged")


def current(versions: DataFrame) -> DataFrame:
    """Active versions."""
    return versions.where(F.col("valid_to").isNull())


def closed(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to").isNotNull())


def version_counts(versions: DataFrame, *by: str) -> DataFrame:
    """Total and active versions."""
    return versions.groupBy(*by).agg(
        F.count("*").alias("total_versions"),
        F.count_if(F.col("valid_to").isNull()).alias("active_versions"),
    )


def _side(rows: DataFrame, side: str, columns: tuple[str, ...]) -> DataFrame:
    """One side of a merge: keys, a mark that tells it from no row, and the rest named `<side>_<column>`.

    Plain columns instead of a struct: structs are copied as a whole at every step, and none of
    their fields can be left out.
    """
    return rows.select(*KEYS, F.lit(True).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])


def _differs() -> Column:
    """Any payload column of sides *a* and *s* is distinct, NULL counting as a value."""
    same = F.lit(True)
    for name in PAYLOAD:
        same = same & F.col(f"a_{name}").eqNullSafe(F.col(f"s_{name}"))
    return ~same


def versions_to_close(active: DataFrame, staged: DataFrame, valid_from: datetime) -> DataFrame:
    """Active versions contradicted by the feed, as they look once closed.

    Taken from the full outer join: of an inner one the planner infers that keys are not NULL, and
    asks that of the feeds' text in a filter that parses every instant and symbol a second time.
    """
    merged = merge_active(active, staged, valid_from)
    return merged.where(F.col(CHANGE) == "closed").select(*VERSION_COLUMNS)


def versions_to_insert(
    active: DataFrame, staged: DataFrame, valid_from: datetime, recorded_at: datetime | None = None
) -> DataFrame:
    """Staged rows with no equal active version: new keys and corrections.

    The payload is compared as one condition beside the keys.  As equalities of their own its columns
    would become join keys, and both sides would be shuffled and sorted anew by all of them.
    """
    known = F.least(*[F.col(f"s.{c}").eqNullSafe(F.col(f"a.{c}")) for c in PAYLOAD])
    on = [F.col(f"s.{c}") == F.col(f"a.{c}") for c in KEYS]
    fresh = staged.alias("s").join(active.alias("a"), [*on, known], "left_anti")
    opened = _opened(*[F.col(c) for c in BAR_COLUMNS], valid_from=valid_from, recorded_at=recorded_at)
    return fresh.select(opened.alias("v")).select("v.*")


def _opened(*bar: Column, valid_from: datetime, recorded_at: datetime | None) -> Column:
    """Struct of a version believed from *valid_from* on."""
    start = instant_literal(valid_from)
    written = start if recorded_at is None else instant_literal(recorded_at)
    return F.struct(
        *[value.alias(name) for name, value in zip(BAR_COLUMNS, bar)],
        start.alias("ingested_at"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        written.alias("created_at"),
        written.alias("updated_at"),
    )


def merge_active(
    active: DataFrame, staged: DataFrame, valid_from: datetime, recorded_at: datetime | None = None
) -> DataFrame:
    """Active versions after the load plus the versions it closed, tagged with the change.

    One full outer join on the bar key.  Both sides hold a key at most once, so
    a popular symbol spreads over tasks by ``price_ts`` and nothing fans out.
    Keys absent from the feed are carried over untouched.
    """
    both = _side(active, "a", HELD).join(_side(staged, "s", PAYLOAD), list(KEYS), "full_outer")
    carried, inserted, closed_, corrected, unchanged = (F.lit(n) for n in range(len(CHANGES)))
    outcome = (
        F.when(F.col("s").isNull(), F.array(carried))
        .when(F.col("a").isNull(), F.array(inserted))
        .when(_differs(), F.array(closed_, corrected))
        .otherwise(F.array(unchanged))
    )
    # Only the number of the change is multiplied; columns are chosen by it, and unused ones dropped before.
    rows = both.select("*", F.explode(outcome).alias("nth_change"))
    nth = F.col("nth_change")
    opens, ends = (nth == inserted) | (nth == corrected), nth == closed_
    start = instant_literal(valid_from)
    written = start if recorded_at is None else instant_literal(recorded_at)
    opened = {**{c: F.col(f"s_{c}") for c in PAYLOAD}, "ingested_at": start, "valid_from": start}
    opened |= {"valid_to": F.lit(None).cast("timestamp"), "created_at": written, "updated_at": written}
    ended = {"valid_to": start, "updated_at": start}

    def version(name: str) -> Column:
        value = F.when(opens, opened[name])
        if name in ended:
            value = value.when(ends, ended[name])
        return value.otherwise(F.col(f"a_{name}")).alias(name)

    change = F.element_at(F.array(*map(F.lit, CHANGES)), nth + 1).alias(CHANGE)
    return rows.select(change, *KEYS, *map(version, HELD))


def changed_slots(active: DataFrame, staged: DataFrame, slot: tuple[str, ...] = ("price_month", "bucket")) -> DataFrame:
    """Per slot of the feed: rows that equal their active version, and rows that differ or are new."""
    sent = staged.select(*KEYS, *slot, *[F.col(c).alias(f"s_{c}") for c in PAYLOAD])
    both = sent.join(_side(active, "a", PAYLOAD), list(KEYS), "left")
    same = F.col("a").isNotNull() & ~_differs()
    return both.groupBy(*slot).agg(F.count_if(same).alias("same"), F.count_if(~same).alias("differing"))


def temporal_merge(
    versions: DataFrame, staged: DataFrame, valid_from: datetime, recorded_at: datetime | None = None
) -> DataFrame:
    """The whole versions table after loading *staged*; closed history passes through."""
    merged = merge_active(current(versions), staged, valid_from, recorded_at).drop(CHANGE)
    return closed(versions).select(*VERSION_COLUMNS).unionByName(merged)


def temporal_merge_in_place(
    versions: DataFrame,
    staged: DataFrame,
    valid_from: datetime,
    recorded_at: datetime | None = None,
    dealt_by: tuple[str, ...] = (),
) -> DataFrame:
    """What ``temporal_merge`` makes, with the rows left where they are dealt.

    A full outer join forgets how its sides were dealt, so whatever follows by key shuffles all
    versions again.  Here both sides are put together and every row sees those of its key through a
    window: versions and feed that are dealt alike stay so, and closed history passes in the same
    turn.  *dealt_by* names columns of both sides that follow from the key and by which they are
    dealt; they are kept.
    """
    start = instant_literal(valid_from)
    written = start if recorded_at is None else instant_literal(recorded_at)
    opening = {"ingested_at": start, "valid_from": start, "valid_to": F.lit(None).cast("timestamp")}
    opening |= {"created_at": written, "updated_at": written}
    fed = staged.select(*BAR_COLUMNS, *dealt_by, *[value.alias(c) for c, value in opening.items()], F.lit(True).alias("fed"))
    both = versions.select(*VERSION_COLUMNS, *dealt_by, F.lit(False).alias("fed")).unionByName(fed)
    in_force = ~F.col("fed") & F.col("valid_to").isNull()
    # A NULL in a key equals nothing, as in a join.
    keyed = F.col("source_name").isNotNull() & F.col("symbol").isNotNull() & F.col("price_ts").isNotNull()
    key = Window.partitionBy(*KEYS, *dealt_by)
    met = both.select(
        "*",
        F.collect_list(F.when(F.col("fed") & keyed, F.struct(*PAYLOAD))).over(key).alias("sent"),
        F.max(in_force & keyed).over(key).alias("held"),
    )
    alone = F.array(F.lit(None).cast(met.schema["sent"].dataType.elementType))
    partners = F.when(F.col("fed"), F.when(F.col("held") & keyed, F.slice(alone, 1, 0)).otherwise(alone)).otherwise(
        F.when(in_force & keyed & (F.size("sent") > 0), F.col("sent")).otherwise(alone)
    )
    pairs = met.select(*both.columns, F.explode(partners).alias("s"))
    same = F.lit(True)
    for name in PAYLOAD:
        same = same & F.col(name).eqNullSafe(F.col(f"s.{name}"))
    stays, ends, opens = F.lit(0), F.lit(1), F.lit(2)
    outcome = F.when(F.col("s").isNull() | same, F.array(stays)).otherwise(F.array(ends, opens))
    rows = pairs.select("*", F.explode(outcome).alias("nth"))
    ended = {"valid_to": start, "updated_at": start}

    def version(name: str) -> Column:
        value = F.when(F.col("nth") == opens, F.col(f"s.{name}") if name in PAYLOAD else opening[name])
        if name in ended:
            value = value.when(F.col("nth") == ends, ended[name])
        return value.otherwise(F.col(name)).alias(name)

    return rows.select(*KEYS, *map(version, HELD), *dealt_by)


def first_load(
    staged: DataFrame, valid_from: datetime, recorded_at: datetime | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Versions of a load into an empty table; *keep* names further columns to carry."""
    opened = _opened(*[F.col(c) for c in BAR_COLUMNS], valid_from=valid_from, recorded_at=recorded_at)
    return staged.select(opened.alias("v"), *keep).select("v.*", *keep)


def change_counts(merged: DataFrame) -> DataFrame:
    """Rows per change, from the tagged output of ``merge_active``."""
    return merged.groupBy(CHANGE).agg(F.count("*").alias("rows"))

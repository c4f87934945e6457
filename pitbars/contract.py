"""What a vendor feed promises: column names, zone, rules and calendar."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import time

# Names a feed column can be mapped to, and the one landing table.
MANDATORY = ("symbol", "timestamp", "open", "high", "low", "close", "volume", "currency")
OPTIONAL = ("adjusted_close",)
LANDING_TABLE = "market_prices"


class ContractError(ValueError):
    """The contract itself, not the data, is unusable."""


@dataclass(frozen=True)
class RowRules:
    # Names and defaults of the rule switches.
    allow_future: bool = False
    positive_prices: bool = True
    non_negative_volume: bool = True
    high_low_envelope: bool = True


@dataclass(frozen=True)
class TradingHours:
    # Names and defaults of the calendar.
    enabled: bool = False
    opens: time = time(9, 30)
    closes: time = time(16, 0)
    holidays: frozenset[str] = frozenset()


@dataclass(frozen=True)
class FeedContract:
    name: str
    zone: str
    path: str | None = None
    columns: Mapping[str, str] = field(
        default_factory=lambda: {name: name for name in (*MANDATORY, *OPTIONAL)}
    )
    required: tuple[str, ...] = MANDATORY
    rules: RowRules = field(default_factory=RowRules)
    hours: TradingHours = field(default_factory=TradingHours)
    target_zone: str = "UTC"
    table: str = LANDING_TABLE
    na_values: tuple[str, ...] = ()
    # Spark datetime patterns tried before the general date grammar, for feeds with a shape of their own.
    date_shapes: tuple[str, ...] = ()
    granularity: str = "second"

    def checked(self) -> FeedContract:
        """Return self, or raise when the contract cannot be executed."""
        unmapped = sorted(set(MANDATORY).difference(self.columns))
        if unmapped:
            raise ContractError(f"contract {self.name!r} maps no column to: {', '.join(unmapped)}")
        if self.table != LANDING_TABLE:
            raise ContractError(f"contract {self.name!r} lands in {self.table!r}; only {LANDING_TABLE} exists")
        if self.granularity not in ("second", "microsecond"):
            raise ContractError(f"granularity is second or microsecond, not {self.granularity!r}")
        return self


def pick(contracts: Iterable[FeedContract], name: str | None = None) -> list[FeedContract]:
    """All contracts, or the one called *name*."""
    known = list(contracts)
    if name is None:
        return known
    chosen = [contract for contract in known if contract.name == name]
    if not chosen:
        names = ", ".join(contract.name for contract in known)
        raise ContractError(f"no feed called {name!r}; configured feeds: {names}")
    return chosen

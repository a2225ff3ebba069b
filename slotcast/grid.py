"""The one abstraction every operator takes: a regular time grid of keyed series."""

from __future__ import annotations

from dataclasses import dataclass

HOUR = 3600
DAY = 86400


@dataclass(frozen=True)
class Grid:
    """Names, step and zone of a keyed series on a regular time grid.

    ``step`` is the slot length in seconds.  ``scale`` is the number of decimals of
    a fixed-point value column: with it every sum runs on scaled integers, so results
    do not depend on the order in which partitions are merged and a re-run writes the
    same bits.  Leave it ``None`` for free floating-point values.
    """

    step: int = 900
    key: str = "region"
    time: str = "date_heure"
    value: str = "consommation"
    ingested: str = "_ingested_at"
    tz: str = "Europe/Paris"
    scale: int | None = None

    @property
    def slots_per_day(self) -> int:
        return DAY // self.step

    @property
    def keys(self) -> list[str]:
        return [self.time, self.key]

    def lag_name(self, hours: int) -> str:
        return f"{self.value}_lag_{hours}h"

    def rolling_name(self, hours: int) -> str:
        return f"{self.value}_rolling_{hours}h"

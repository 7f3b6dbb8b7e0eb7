"""Report parameters.

Every report takes one ``Params``. The values become column literals, never
SQL text. ``None`` in a list parameter means "all values", which also keeps
rows whose column is NULL; an explicit list drops them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

# Default selections of the reports.
CARRIERS = ("FXFE", "HSNR", "HSND", "HSNC", "HSNN", "HSNA")
CLAIM_TYPES = ("SHORTAGE",)
BUSINESS_UNITS = ("1MF", "1MY", "1MQ", "1MS", "1MK")


@dataclass(frozen=True)
class Params:
    """Parameters shared by the reports.

    ``as_of`` stands for "today"; reports that compare calendar months count
    from it, so a rerun of an old report gives the old numbers.
    """

    time_from: datetime
    time_to: datetime
    as_of: date
    carriers: Sequence[str] | None = CARRIERS
    claim_types: Sequence[str] | None = CLAIM_TYPES
    business_units: Sequence[str] | None = BUSINESS_UNITS
    order_contains: str = ""
    sscc_contains: str = ""
    cutover: date = date(2025, 5, 1)
    threshold: int = 10_000

    @property
    def month_start(self) -> datetime:
        """First instant of the month of ``as_of``."""
        return datetime(self.as_of.year, self.as_of.month, 1)

    @property
    def previous_month_start(self) -> datetime:
        """First instant of the month before ``month_start``."""
        first = self.month_start
        if first.month == 1:
            return datetime(first.year - 1, 12, 1)
        return datetime(first.year, first.month - 1, 1)

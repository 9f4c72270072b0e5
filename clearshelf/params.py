"""Run parameters. Every date an operator uses is derived from one ``run_date``."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# Numbers the business rules name.
HORIZONS = 8
BACK_WEEKS = 4
HISTORY_DAYS = 1050
WARM_UP_DAYS = 30
ACTIVE_DAYS = 485
HALF_YEAR_DAYS = 167
EXCLUDED_STORE_TYPES = ("G", "W")
EXCLUDED_VISIT_SUBTYPES = (198,)
EXCLUDED_STATUS = ("R", "L", "D")
COUNTRY = "US"
DIVISION = 18
PLAN_STATUS = (10, 11)
INVENTORY_WEIGHT = 0.7
SALES_WEIGHT = 0.3
WEEKLY_UNITS_FLOOR = 0.1
WEEK_UNITS_FLOOR = 0.025
MIN_SAMPLE_INVENTORY = 3
DISCOUNT_GRID = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


@dataclass(frozen=True)
class RunDates:
    """Window boundaries of one run, all inclusive."""

    run_date: date
    history_days: int = HISTORY_DAYS

    def _back(self, days: int) -> date:
        return self.run_date - timedelta(days=days)

    @property
    def today(self) -> date:
        return self._back(1)

    @property
    def history_start(self) -> date:
        return self._back(self.history_days)

    @property
    def warm_start(self) -> date:
        return self.history_start + timedelta(days=WARM_UP_DAYS)

    @property
    def active_start(self) -> date:
        return self._back(ACTIVE_DAYS)

    @property
    def train(self) -> tuple[date, date]:
        return self._back(570), self._back(120)

    @property
    def val(self) -> tuple[date, date]:
        return self._back(89), self._back(60)

    @property
    def test(self) -> tuple[date, date]:
        return self._back(29), self._back(1)

    @property
    def eval_start(self) -> date:
        return self._back(120)

    @property
    def max_eval_start(self) -> date:
        return self._back(365)

    @property
    def child_sales_week(self) -> tuple[date, date]:
        return self._back(8), self._back(2)


@dataclass(frozen=True)
class Params:
    """Business choices of one run. Codes of departments, subclasses and clubs belong to a retailer:
    the department list has no default, the others default to none."""

    run_date: date
    departments: tuple[int, ...]
    history_days: int = HISTORY_DAYS
    on_order_departments: tuple[int, ...] = ()
    excluded_store_types: tuple[str, ...] = EXCLUDED_STORE_TYPES
    excluded_subtypes: tuple[int, ...] = EXCLUDED_VISIT_SUBTYPES
    excluded_status: tuple[str, ...] = EXCLUDED_STATUS
    excluded_subclasses: tuple[int, ...] = ()
    excluded_clubs: tuple[int, ...] = ()
    country: str = COUNTRY
    division: int = DIVISION
    dates: RunDates = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "dates", RunDates(self.run_date, self.history_days))

"""Report parameters.  The clock is a parameter: a report is a function of its
tables and ``as_of``, so a re-run gives the same rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class RecencyLadder:
    """Thresholds of the trailing-year segment ladder; the first match wins."""

    champion_days: int = 30
    champion_orders: int = 10
    champion_spend: int = 10000
    loyal_days: int = 60
    loyal_orders: int = 5
    at_risk_days: int = 90
    at_risk_orders: int = 3
    lost_days: int = 180


@dataclass(frozen=True)
class ProfileLadder:
    """Thresholds of the customer-360 segment ladder; the first match wins."""

    new_days: int = 30
    new_orders: int = 2
    champion_days: int = 60
    champion_orders: int = 12
    champion_spend: int = 15000
    loyal_days: int = 90
    loyal_orders: int = 8
    loyal_spend: int = 8000


@dataclass(frozen=True)
class ReportParams:
    """Defaults are the report library's own; override per data set."""

    as_of: date
    country: str = "Germany"
    late_country: str = "Netherlands"
    tier: str = "Gold"
    min_credit: int = 50000
    margin_factor: int = 3
    idle_months: int = 6
    unsold_months: int = 12
    late_days: int = 14
    name_parts: tuple[str, ...] = ("Pro", "Plus", "Max")
    top_k: int = 10
    quarter: int = 3
    open_statuses: tuple[str, ...] = ("Pending", "Partially Delivered")
    quarter_revenue_floor: int = 500000
    quarter_attainment_cap: int = 80
    category_margin_cap: int = 25
    category_return_floor: int = 10
    frequent_orders: int = 20
    frequent_value_cap: int = 1000
    spend_floor: int = 10000
    region_revenue_floor: int = 1000000
    recency: RecencyLadder = field(default_factory=RecencyLadder)
    profile: ProfileLadder = field(default_factory=ProfileLadder)

    @property
    def last_year(self) -> int:
        """The most recent complete calendar year."""
        return self.as_of.year - 1

"""Assumptions behind the reports and the growth plan."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

VENUE_CAPACITY = 1200


@dataclass(frozen=True)
class PlanSettings:
    # Goal, lever assumptions and tier capacities of the published plan.
    goal_pct: float = 0.05
    soft_night_target: float = 0.65
    vip_price_lift: float = 0.10
    realloc_budget: float = 2000.0
    realloc_incrementality: float = 0.25
    refund_convert_rate: float = 0.15
    launch_days: int = 4
    tier_caps: Mapping[str, int | Column] = field(
        default_factory=lambda: {"GA": 800, "Balcony": 300, "VIP": 100}
    )
    premium_tier: str = "VIP"
    balcony_tier: str = "Balcony"

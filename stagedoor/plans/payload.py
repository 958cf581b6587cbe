"""The published document: every result of a season in one nested row.

The arrays hold one element per event, campaign and day. The orders behind them are scanned once,
into a written roll-up, and all parts are computed from that.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor.operators.attribution import attribution_summary, campaign_returns
from stagedoor.operators.relational import side_by_side
from stagedoor.operators.sales import GROUPING, daily_pacing, sales_rollup
from stagedoor.plans import growth
from stagedoor.plans.settings import PlanSettings
from stagedoor.session import settle


def _gathered(part: DataFrame, label: str) -> DataFrame:
    """A written part of the document, read by one task.

    The document is one row, so a task holds its lists in any case; what is derived from them needs no
    shuffles then. Orders never come here, only sums by event, day and campaign.
    """
    return settle(part, label).coalesce(1)


class PayloadParts:
    """The parts of the document as tables: one row each but for the three lists.

    Each is built when asked for; what several parts read is written once.
    """

    def __init__(
        self,
        orders: DataFrame,
        events: DataFrame,
        campaigns: DataFrame,
        attendance_of: Callable[[DataFrame], DataFrame],
        settings: PlanSettings | None = None,
        spread: bool = False,
    ):
        """``attendance_of`` gives the attendance table, from the roll-up it is handed.

        With ``spread`` the lists stay in as many tasks as they have, for exports that never gather them.
        """
        self._spread = spread
        self._orders, self._roster, self._campaigns = orders, events, campaigns
        self._attendance_of = attendance_of
        self.settings = settings or PlanSettings()

    def _part(self, part: DataFrame, label: str) -> DataFrame:
        return settle(part, label) if self._spread else _gathered(part, label)

    @cached_property
    def sales(self) -> DataFrame:
        if GROUPING in self._orders.columns:
            return self._orders
        return settle(sales_rollup(self._orders), "sales")

    @cached_property
    def events(self) -> DataFrame:
        attendance = self._attendance_of(self.sales)
        results = growth.event_results(self._roster, self.sales, attendance, self.settings)
        return self._part(results, "results")

    @cached_property
    def daily(self) -> DataFrame:
        return self._part(daily_pacing(self.sales), "pacing")

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._part(campaign_returns(self.sales, self._campaigns), "returns")

    def prepare(self) -> None:
        """Write the three lists at once: they depend on the roll-up, and not on each other."""
        self.sales  # noqa: B018
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(lambda name: getattr(self, name), ("events", "daily", "campaigns")))

    @cached_property
    def _totals(self) -> DataFrame:
        return self._part(growth.season_totals(self.sales, self.events, self.campaigns), "totals")

    @property
    def totals(self) -> DataFrame:
        return self._totals.drop("no_shows")

    @property
    def season(self) -> DataFrame:
        return growth.season(self.events, self.daily)

    @property
    def goal(self) -> DataFrame:
        return growth.goal(self._totals, self.settings)

    @property
    def attribution(self) -> DataFrame:
        return attribution_summary(self.sales, self._campaigns)

    @property
    def derived(self) -> DataFrame:
        return growth.derived_scalars(
            self.events, self.campaigns, self.daily, self._totals, self.settings
        )

    @cached_property
    def levers(self) -> dict[str, DataFrame]:
        return growth.growth_levers(self.events, self.campaigns, self._totals, self.settings)


def _nested(table: DataFrame, name: str) -> DataFrame:
    return table.select(F.struct(*table.columns).alias(name))


def _listed(table: DataFrame, name: str, *order) -> DataFrame:
    """One row with all rows of ``table`` in a fixed order."""
    keyed = F.struct(F.struct(*order).alias("at"), F.struct(*table.columns).alias("row"))

    def by_key(left, right):
        return (
            F.when(left["at"] < right["at"], -1).when(left["at"] > right["at"], 1).otherwise(0)
        )

    ordered = F.array_sort(F.collect_list(keyed), by_key)
    return table.agg(F.transform(ordered, lambda item: item["row"]).alias(name))


def payload_row(parts: PayloadParts) -> DataFrame:
    """The whole document as one row of structs and arrays, levers as one struct per key.

    One row by nature, whatever the number of events, days and campaigns.
    """
    parts.prepare()
    levers = parts.levers
    amounts = growth.lever_amounts(levers)
    return side_by_side(
        _nested(parts.season, "season"),
        _nested(parts.goal, "goal"),
        _nested(parts.totals, "totals"),
        _nested(parts.attribution, "attribution"),
        _nested(parts.derived, "derived"),
        _listed(parts.events, "events", F.col("id")),
        _listed(parts.daily, "daily", F.col("date")),
        _listed(parts.campaigns, "campaigns", -F.col("rpd"), F.col("id")),
        *[_nested(lever, f"lever_{key}") for key, lever in levers.items()],
        amounts.agg(F.sum("amount").alias("levers_total")),
    )


def payload_json(row: DataFrame) -> DataFrame:
    """One row: the document as JSON text, missing values written as null."""
    return row.select(
        F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"}).alias("document")
    )


def page_scalars(parts: PayloadParts) -> DataFrame:
    """One row: the figures the pages quote beyond the document itself."""
    levers = parts.levers
    row = side_by_side(
        _nested(parts.goal, "goal"),
        _nested(parts.totals, "totals"),
        _nested(parts.attribution, "attribution"),
        _nested(parts.derived, "derived"),
        *[_nested(lever, key) for key, lever in levers.items()],
    )
    best, worst = F.col("derived.best_event.net"), F.col("derived.worst_event.net")
    soft, vip = F.col("soft_night.amount"), F.col("vip.amount")
    realloc, refunds = F.col("realloc.amount"), F.col("refunds.amount")
    gap = F.col("goal.gap")
    return row.select(
        (F.try_divide((soft + vip + realloc + refunds).cast("double"), gap) - 1).alias("buffer_pct"),
        F.try_divide(best - worst, gap).alias("spread_vs_gap"),
        (soft + vip).alias("page2_levers_sum"),
        (realloc + refunds).alias("page3_levers_sum"),
        F.try_divide("attribution.organic_net", "totals.net").alias("organic_share"),
        F.col("derived.worst_event.sell_through").alias("worst_event_pct_of_house"),
        F.col("realloc.detail.budget_moved").alias("realloc_moved"),
        F.col("refunds.detail.convert_rate").alias("refund_convert_pct"),
        F.col("vip.detail.price_lift").alias("vip_lift_pct"),
        F.col("soft_night.detail.target_sell_through").alias("soft_target_pct"),
    )

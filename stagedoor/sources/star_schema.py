"""The library's source shapes, read off a star schema of nations, customers, orders and clicks.

Nations act as campaigns, market segments as events, orders as ticket orders and click events as
gate scans. The expressions give every cleaning and matching rule some rows: codes in the wrong
case, with spaces, unknown or missing; rows with no quantity; refunds; duplicate and orphan scans.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.plans.settings import PlanSettings

TIERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FIRST_DAY, END_DAY = "1995-01-01", "2001-08-02"


def tier_caps() -> dict[str, Column]:
    """Every tier gets a fifth of the house of its event."""
    return {tier: F.expr("capacity div 5") for tier in TIERS}


def plan_settings() -> PlanSettings:
    return PlanSettings(tier_caps=tier_caps(), premium_tier=TIERS[0], balcony_tier=TIERS[1])


class StarSchema:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def raw_campaigns(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        key = F.col("n_nationkey")
        starts = F.timestamp_add("DAY", 30 * key, F.lit("1995-01-01").cast("timestamp"))
        text_time = "yyyy-MM-dd"
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.concat(F.lit("CMP-"), F.lpad(key.cast("string"), 2, "0")).alias("campaign_id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("channel"),
            F.when(key % 12 != 3, F.col("n_name")).otherwise(F.lit("")).alias("promo_code"),
            (100.0 * (key + 1)).cast("double").alias("spend_usd"),
            F.date_format(starts, text_time).alias("starts_on"),
            F.date_format(F.timestamp_add("DAY", F.lit(1825), starts), text_time).alias("ends_on"),
        )

    def raw_events(self) -> DataFrame:
        house = self.table("orders").agg(
            (F.count("*") * 0.6).cast("bigint").alias("capacity")
        )
        segment = F.col("c_mktsegment")
        offset = (F.ascii(segment) - F.ascii(F.lit("A"))).cast("int")
        return (
            self.table("customer")
            .select(segment)
            .distinct()
            .select(
                segment.alias("event_id"),
                segment.alias("event_name"),
                F.lower(segment).alias("genre"),
                F.date_format(F.date_add(F.lit("2001-08-01").cast("date"), offset), "yyyy-MM-dd").alias(
                    "event_date"
                ),
                house.scalar().alias("capacity"),
                F.lit("19:00").alias("doors_time"),
                F.lit("20:00").alias("show_time"),
            )
        )

    def placed_orders(self) -> DataFrame:
        """Orders with the segment and nation of their customer."""
        orders = self.table("orders")
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
            nation, customer.c_nationkey == nation.n_nationkey
        )

    def raw_orders(self, *extra: Column) -> DataFrame:
        key, name = F.col("o_orderkey"), F.col("n_name")
        code = (
            F.when(key % 10 == 0, F.lit(None))
            .when(key % 10 == 1, F.lower(name))
            .when(key % 10 == 2, F.concat(F.lit(" "), name))
            .when(key % 10 == 3, F.concat(name, F.lit(" ")))
            .when(key % 10 == 4, F.concat(F.lit("Nation"), F.substr(name, F.lit(7))))
            .when(key % 10 == 5, F.lit("NOSUCH"))
            .otherwise(name)
        )
        status = F.when(F.col("o_orderstatus") == "P", F.lit("refunded")).otherwise(
            F.lit("completed")
        )
        return self.placed_orders().select(
            key.cast("string").alias("order_id"),
            F.col("c_mktsegment").alias("event_id"),
            F.col("o_orderdate").alias("ordered_at"),
            F.col("o_orderpriority").alias("tier"),
            (key % 7).alias("qty"),
            F.col("o_totalprice").alias("unit_price_usd"),
            code.alias("promo_code"),
            status.alias("status"),
            *extra,
        )

    def raw_scans(self) -> DataFrame:
        key = F.col("event_id")
        order = ((key - key % 2) * 2).cast("string")
        number = F.when(key % 4 == 1, F.lit("2")).otherwise(F.lit("1"))
        event = F.lit(SEGMENTS[4])
        for index, segment in reversed(list(enumerate(SEGMENTS[:4]))):
            event = F.when(key % 5 == index, F.lit(segment)).otherwise(event)
        return self.table("events").select(
            key.cast("string").alias("scan_id"),
            F.concat(order, F.lit("-T"), number).alias("ticket_id"),
            order.alias("order_id"),
            event.alias("event_id"),
            F.col("event_type").alias("gate"),
            F.col("ts").alias("scanned_at"),
        )

    def merch_sales(self) -> DataFrame:
        """Goods sold, one row per order line: the show, the article and its price."""
        customers = self.table("customer").select("c_custkey", "c_mktsegment")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
        )
        parts = self.table("part").select("p_partkey", "p_brand")
        return (
            lines.join(placed, lines.l_orderkey == placed.o_orderkey)
            .join(parts, lines.l_partkey == parts.p_partkey)
            .select(
                F.col("c_mktsegment").alias("event_id"),
                F.col("p_brand").alias("sku"),
                F.col("l_quantity").cast("bigint").alias("units"),
                F.col("l_extendedprice").alias("revenue"),
            )
        )

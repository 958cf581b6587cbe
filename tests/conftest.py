import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stagedoor.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "stagedoor-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frames(spark):
    return Frames(spark)


class Frames:
    """Small hand-made source tables."""

    def __init__(self, spark):
        self.spark = spark

    def raw_orders(self, *rows):
        """Rows of (order_id, event_id, ordered_at, tier, qty, price, code, status)."""
        return self.spark.createDataFrame(
            list(rows),
            "order_id string, event_id string, ordered_at string, tier string, qty bigint, "
            "unit_price_usd double, promo_code string, status string",
        )

    def raw_campaigns(self, *rows):
        """Rows of (campaign_id, name, channel, code, spend)."""
        return self.spark.createDataFrame(
            [(*r, "2025-06-20", "2025-07-08") for r in rows],
            "campaign_id string, name string, channel string, promo_code string, spend_usd double, "
            "starts_on string, ends_on string",
        )

    def raw_events(self, *rows):
        """Rows of (event_id, event_name, date, capacity)."""
        return self.spark.createDataFrame(
            [(i, n, "genre", d, c, "19:00", "20:00") for i, n, d, c in rows],
            "event_id string, event_name string, genre string, event_date string, capacity bigint, "
            "doors_time string, show_time string",
        )

    def raw_scans(self, *rows):
        """Rows of (scan_id, ticket_id, order_id, event_id, scanned_at)."""
        return self.spark.createDataFrame(
            [(s, t, o, e, "MAIN-1", at) for s, t, o, e, at in rows],
            "scan_id string, ticket_id string, order_id string, event_id string, gate string, "
            "scanned_at string",
        )

    def sales(self, *rows):
        """Sales measures; rows of (event, tier, code, day, orders, tickets, refunded, gross, net)."""
        return self.spark.createDataFrame(
            [(e, t, c, d, o, o, q, r, q - r, g, n) for e, t, c, d, o, q, r, g, n in rows],
            "event_id string, tier string, promo_code string, order_date string, orders bigint, "
            "order_rows bigint, tickets bigint, refunded_tickets bigint, completed_tickets bigint, "
            "gross double, net double",
        )

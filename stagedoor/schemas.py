"""Column layout of the source files and of the tables built from them.

Dates stay text in the raw layer; staging parses them.
"""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _layout(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_TEXT, _COUNT, _MONEY, _TIME = StringType(), LongType(), DoubleType(), TimestampType()

RAW_CAMPAIGNS = _layout(
    campaign_id=_TEXT,
    name=_TEXT,
    channel=_TEXT,
    promo_code=_TEXT,
    spend_usd=_MONEY,
    starts_on=_TEXT,
    ends_on=_TEXT,
)

RAW_EVENTS = _layout(
    event_id=_TEXT,
    event_name=_TEXT,
    genre=_TEXT,
    event_date=_TEXT,
    capacity=_COUNT,
    doors_time=_TEXT,
    show_time=_TEXT,
)

RAW_ORDERS = _layout(
    order_id=_TEXT,
    event_id=_TEXT,
    ordered_at=_TEXT,
    tier=_TEXT,
    qty=_COUNT,
    unit_price_usd=_MONEY,
    promo_code=_TEXT,
    status=_TEXT,
)

RAW_SCANS = _layout(
    scan_id=_TEXT,
    ticket_id=_TEXT,
    order_id=_TEXT,
    event_id=_TEXT,
    gate=_TEXT,
    scanned_at=_TEXT,
)

DAILY_SALES = _layout(
    order_date=_TIME,
    tier=_TEXT,
    orders=_COUNT,
    tickets=_COUNT,
    net_revenue=_MONEY,
)

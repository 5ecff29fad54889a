"""Explicit schemas of the raw tables.  Money is read as decimals, never as doubles."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_MONEY, _RATE = T.DecimalType(18, 2), T.DecimalType(6, 4)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


CUSTOMERS = _schema(
    customer_id=_S, first_name=_S, last_name=_S, email=_S, gender=_S, age=_I, city=_S, state=_S,
    region=_S, city_tier=_I, signup_date=T.DateType(), acquisition_channel=_S)
PRODUCTS = _schema(
    product_id=_S, product_name=_S, category=_S, sub_category=_S, brand=_S, list_price=_MONEY,
    cost_price=_MONEY, launch_date=T.DateType())
ORDERS = _schema(
    order_id=_S, customer_id=_S, order_ts=T.TimestampType(), status=_S, payment_method=_S, device=_S,
    coupon_code=_S, shipping_fee=_MONEY)
ORDER_ITEMS = _schema(
    order_id=_S, line_no=_I, product_id=_S, quantity=_I, list_price=_MONEY, unit_price=_MONEY,
    discount_pct=_RATE, rating=_I)
EVENTS = _schema(
    event_id=_S, session_id=_S, customer_id=_S, event_time=T.TimestampType(), event_type=_S,
    product_id=_S, device=_S, traffic_source=_S, order_id=_S)

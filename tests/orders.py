"""Small raw orders for unit tests."""

import datetime as dt

from orderflow.context import RunContext
from orderflow.schemas import RAW

CTX = RunContext("11111111-1111-1111-1111-111111111111",
                 dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc), dt.date(2024, 2, 1), "unit")

VALID = {
    "order_id": "Q7-310", "customer_id": "CUST-0001", "order_date": "2023-11-06",
    "order_status": "Delivered", "order_priority": "Low", "ship_date": "2023-11-09",
    "ship_mode": "Rail", "product_id": "GARDEN-8", "product_category": "Garden",
    "product_name": "Watering can, zinc", "quantity": "4", "unit_price": "12.35", "discount": "0.25",
    "shipping_cost": "3.20", "region": "alps", "country": "AT", "city": "Bregenz",
    "postal_code": "6900", "sales_rep_id": "S-42", "channel": "store",
}


def raw(spark, *changes):
    """One row per dict of changes to the valid order."""
    rows = [{**VALID, **c} for c in changes] or [VALID]
    return spark.createDataFrame([[r[c] for c in RAW.names] for r in rows], RAW)

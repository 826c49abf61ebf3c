"""Small tables for the tests: rows as dicts or tuples, with defaults."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def money(value):
    return None if value is None else Decimal(str(value))


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


SUBSCRIBER_DDL = (
    "customer_id STRING, tenure INT, internet_service STRING, online_security STRING, "
    "tech_support STRING, contract STRING, payment_method STRING, "
    "monthly_charges DECIMAL(8,2), total_charges DECIMAL(10,2), churn STRING"
)


def make_subscribers(spark, rows):
    """Rows as dicts; missing columns get a default."""
    default = {
        "tenure": 10, "internet_service": "DSL", "online_security": "No", "tech_support": "No",
        "contract": "One year", "payment_method": "Mailed check", "monthly_charges": 50,
        "total_charges": None, "churn": "No",
    }
    data = []
    for i, row in enumerate(rows):
        full = {"customer_id": f"C{i:03d}", **default, **row}
        data.append(
            (
                full["customer_id"], full["tenure"], full["internet_service"],
                full["online_security"], full["tech_support"], full["contract"],
                full["payment_method"], money(full["monthly_charges"]),
                money(full["total_charges"]), full["churn"],
            )
        )
    return spark.createDataFrame(data, SUBSCRIBER_DDL)


ORDER_DDL = (
    "order_id STRING, order_date DATE, ship_date DATE, ship_mode STRING, customer_id STRING, "
    "product_id STRING, sales DECIMAL(10,2), quantity INT, discount DECIMAL(5,2), "
    "profit DECIMAL(10,2)"
)


def make_orders(spark, rows):
    default = {
        "order_id": "O1", "order_date": "2020-01-05", "ship_date": "2020-01-06",
        "ship_mode": "First Class", "customer_id": "C1", "product_id": "P1", "sales": 100,
        "quantity": 1, "discount": 0, "profit": 10,
    }
    data = []
    for row in rows:
        full = {**default, **row}
        data.append(
            (
                full["order_id"], day(full["order_date"]), day(full["ship_date"]),
                full["ship_mode"], full["customer_id"], full["product_id"], money(full["sales"]),
                full["quantity"], money(full["discount"]), money(full["profit"]),
            )
        )
    return spark.createDataFrame(data, ORDER_DDL)


def make_users(spark, rows):
    """Rows of (user_id, signup date, channel, device)."""
    data = [(u, day(d), c, "new", "Pune", v) for u, d, c, v in rows]
    return spark.createDataFrame(
        data, "user_id BIGINT, signup_date DATE, channel STRING, segment STRING, city STRING, device STRING"
    )


def make_events(spark, rows):
    """Rows of (user_id, event type, date)."""
    return spark.createDataFrame(
        [(u, t, day(d)) for u, t, d in rows],
        "user_id BIGINT, event_type STRING, event_date DATE",
    )


def as_dict(frame, key, value):
    return {row[key]: row[value] for row in frame.collect()}

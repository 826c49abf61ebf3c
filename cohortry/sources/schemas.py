"""Declared schemas and value domains of the input tables.

Two tables are called ``customers`` (subscribers, and buyers), so schemas are
kept per business area.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


TEXT, INT, DAY = StringType(), IntegerType(), DateType()

SUBSCRIBERS = _schema(
    ("customer_id", TEXT),
    ("gender", TEXT),
    ("senior_citizen", INT),
    ("partner", TEXT),
    ("dependents", TEXT),
    ("tenure", INT),
    ("phone_service", TEXT),
    ("multiple_lines", TEXT),
    ("internet_service", TEXT),
    ("online_security", TEXT),
    ("online_backup", TEXT),
    ("device_protection", TEXT),
    ("tech_support", TEXT),
    ("streaming_tv", TEXT),
    ("streaming_movies", TEXT),
    ("contract", TEXT),
    ("paperless_billing", TEXT),
    ("payment_method", TEXT),
    ("monthly_charges", DecimalType(8, 2)),
    ("total_charges", DecimalType(10, 2)),
    ("churn", TEXT),
)

SALES_CUSTOMERS = _schema(
    ("customer_id", TEXT),
    ("customer_name", TEXT),
    ("segment", TEXT),
    ("region", TEXT),
    ("state", TEXT),
    ("city", TEXT),
)

SALES_PRODUCTS = _schema(
    ("product_id", TEXT),
    ("category", TEXT),
    ("sub_category", TEXT),
    ("product_name", TEXT),
)

SALES_ORDERS = _schema(
    ("order_id", TEXT),
    ("order_date", DAY),
    ("ship_date", DAY),
    ("ship_mode", TEXT),
    ("customer_id", TEXT),
    ("product_id", TEXT),
    ("sales", DecimalType(10, 2)),
    ("quantity", INT),
    ("discount", DecimalType(5, 2)),
    ("profit", DecimalType(10, 2)),
)

SALES_RETURNS = _schema(("order_id", TEXT), ("returned", TEXT))

# The flat sales file before the split: order lines with all attributes.
SALES_FLAT = StructType(
    SALES_ORDERS.fields
    + SALES_CUSTOMERS.fields[1:]
    + SALES_PRODUCTS.fields[1:]
    + SALES_RETURNS.fields[1:]
)

FUNNEL_USERS = _schema(
    ("user_id", LongType()),
    ("signup_date", DAY),
    ("channel", TEXT),
    ("segment", TEXT),
    ("city", TEXT),
    ("device", TEXT),
)

FUNNEL_EVENTS = _schema(
    ("event_id", LongType()),
    ("user_id", LongType()),
    ("event_type", TEXT),
    ("event_date", DAY),
)

# The documented domains.
YES_NO = ("Yes", "No")
CONTRACTS = ("Month-to-month", "One year", "Two year")
BUYER_SEGMENTS = ("Consumer", "Corporate", "Home Office")
CHANNELS = ("organic", "paid_search", "referral", "email", "social")
USER_SEGMENTS = ("new", "returning")
CITIES = ("Mumbai", "Delhi", "Bangalore", "Hyderabad", "Chennai", "Pune")
DEVICES = ("mobile", "desktop", "tablet")
EVENT_TYPES = ("signed_up", "completed_onboarding", "first_purchase", "second_purchase")
SHIP_MODES = ("Same Day", "First Class", "Second Class", "Standard Class")

SUBSCRIBER_DOMAINS = {"contract": CONTRACTS, "churn": YES_NO}
USER_DOMAINS = {"channel": CHANNELS, "segment": USER_SEGMENTS, "device": DEVICES}
EVENT_DOMAINS = {"event_type": EVENT_TYPES}

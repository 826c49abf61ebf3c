"""The three business areas, derived from generic star-schema and event tables.

The folder holds parquet tables region, nation, customer, part, orders, lineitem
and events.  Dates arrive as timestamps and money as doubles; both are cast
before anything is computed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.operators.funnel import STAGES
from cohortry.plans.durable import is_scratch, scratch_path
from cohortry.plans.hot_keys import SLICE_ROWS, HotKeys
from cohortry.sources.schemas import SALES_FLAT, SUBSCRIBERS

# Recency is counted to the latest order date of the data.
AS_OF = dt.date(2001, 8, 1)

# The columns in use; declaring them saves a job per file to read its schema.
COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


@dataclass(frozen=True)
class Sales:
    orders: DataFrame
    customers: DataFrame
    products: DataFrame


@dataclass(frozen=True)
class Funnel:
    users: DataFrame
    events: DataFrame


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def sales_customers(
    spark: SparkSession, folder: str, key: str = "CAST(c_custkey AS STRING) AS customer_id"
) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            key,
            "c_name AS customer_name",
            "c_mktsegment AS segment",
            "r_name AS region",
            "n_name AS state",
            "n_name AS city",
        )
    )


def sales_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "p_type AS category",
        "p_brand AS sub_category",
        "p_name AS product_name",
    )


def _lines(
    spark: SparkSession, folder: str, with_profit: bool, with_product: bool = False,
    with_buyer: bool = False,
) -> DataFrame:
    """Order lines and whether they came back.

    Ids are text, as in the declared schema, from after the joins on.  That also
    keeps reports that group by order or product from sitting on a join's own
    partitioning, which would stop AQE from splitting an order or a product that
    holds a large share of the lines.

    The buyer comes with the order: there are fewer orders than lines, and the
    lines, with all they have got by then, need no shuffle by customer.
    """
    ids = "CAST(product_id AS STRING) AS product_id"
    bought = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CAST(o_orderdate AS DATE) AS order_date", "o_orderpriority",
        "o_custkey",
    )
    buyer = []
    if with_buyer:
        people = sales_customers(spark, folder, "c_custkey")
        buyer = [c for c in people.columns if c != "c_custkey"]
        bought = bought.join(people, F.expr("o_custkey = c_custkey"))
    lines = (
        table(spark, folder, "lineitem")
        .withColumn("ship_date", F.expr("CAST(l_shipdate AS DATE)"))
        .join(bought, F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "CAST(l_orderkey AS STRING) AS order_id",
            "order_date",
            "ship_date",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
               WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS ship_mode""",
            "CAST(o_custkey AS STRING) AS customer_id",
            "l_partkey AS product_id",
            "CAST(l_extendedprice AS DECIMAL(10,2)) AS sales",
            "CAST(l_quantity AS INT) AS quantity",
            "CAST(l_discount * 4 AS DECIMAL(5,2)) AS discount",
            "CASE WHEN l_returnflag = 'R' THEN 'Yes' END AS returned",
            *buyer,
        )
    )
    others = [c for c in lines.columns if c != "product_id"]
    if not with_profit:
        return lines.selectExpr(*others, ids)
    attributes = ["category", "sub_category", "product_name"] if with_product else []
    product = table(spark, folder, "part").selectExpr(
        "p_partkey", "CAST(0.05BD * (p_size % 6 + 1) AS DECIMAL(5,2)) AS markup",
        "p_type AS category", "p_brand AS sub_category", "p_name AS product_name",
    )
    profit = "CAST(round(sales * (markup - discount), 2) AS DECIMAL(10,2)) AS profit"
    return lines.join(
        product.select("p_partkey", "markup", *attributes), F.expr("product_id = p_partkey"), "left"
    ).selectExpr(*others, ids, profit, *attributes)


def sales_orders(spark: SparkSession, folder: str, with_profit: bool = True) -> DataFrame:
    """Order lines.  Profit needs the product table; without it, one join less."""
    return _lines(spark, folder, with_profit).drop("returned")


def sales(spark: SparkSession, folder: str, with_profit: bool = True) -> Sales:
    return Sales(
        orders=sales_orders(spark, folder, with_profit),
        customers=sales_customers(spark, folder),
        products=sales_products(spark, folder),
    )


def sales_flat(spark: SparkSession, folder: str) -> DataFrame:
    """The star schema joined back into one wide line-grain file."""
    return _lines(
        spark, folder, with_profit=True, with_product=True, with_buyer=True
    ).select(*SALES_FLAT.fieldNames())


# Every subscriber column.  Customers without internet, and a few without an
# answer, have neither Yes nor No for security and support.
SUBSCRIBER_COLUMNS = {
    "customer_id": "c_custkey",
    "senior_citizen": "0",
    "tenure": "(c_custkey * 7 + c_nationkey) % 73",
    "internet_service": "elt(c_custkey % 3 + 1, 'Fiber optic', 'DSL', 'No')",
    "online_security": """CASE WHEN c_custkey % 3 = 2 THEN 'No internet service'
                   WHEN c_custkey % 17 = 3 THEN NULL WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END""",
    "tech_support": """CASE WHEN c_custkey % 3 = 2 THEN 'No internet service'
                   WHEN c_custkey % 19 = 5 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END""",
    "gender": "if(c_custkey % 2 = 0, 'Female', 'Male')",
    "partner": "if(c_custkey % 5 < 2, 'Yes', 'No')",
    "dependents": "if(c_custkey % 7 < 2, 'Yes', 'No')",
    "phone_service": "if(c_custkey % 11 = 0, 'No', 'Yes')",
    "multiple_lines": "if(c_custkey % 11 = 0, 'No phone \"line\", none', 'Yes')",
    "online_backup": "if(c_custkey % 4 = 0, 'Yes', 'No')",
    "device_protection": "if(c_custkey % 6 = 0, 'Yes', 'No')",
    "streaming_tv": "if(c_custkey % 8 < 3, 'Yes', 'No')",
    "streaming_movies": "if(c_custkey % 9 < 4, 'Yes', 'No')",
    "paperless_billing": "if(c_custkey % 10 < 6, 'Yes', 'No')",
    "contract": """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'One year'
                   WHEN 'MACHINERY' THEN 'Two year' ELSE 'Month-to-month' END""",
    "payment_method": """elt(c_nationkey % 4 + 1,
                   'Electronic check', 'Mailed check', 'Bank transfer', 'Credit card')""",
    "monthly_charges": "charges",
    "total_charges": """CASE WHEN (c_custkey * 7 + c_nationkey) % 73 > 0
                   THEN charges * ((c_custkey * 7 + c_nationkey) % 73) END""",
    "churn": "if(last_order >= DATE'2001-01-31', 'No', 'Yes')",
}


def subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """Subscribers: customers, churned when they stopped ordering."""
    last_order = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("buyer"))
        .agg(F.max("o_orderdate").cast("date").alias("last_order"))
    )
    charges = """CAST(round((CAST(c_acctbal AS DECIMAL(12,2)) + 1000) * 0.01BD, 2)
                 AS DECIMAL(8,2)) AS charges"""
    columns = [
        f"CAST({SUBSCRIBER_COLUMNS[f.name]} AS {f.dataType.simpleString()})"
        f" AS {f.name}"
        for f in SUBSCRIBERS.fields
    ]
    return (
        table(spark, folder, "customer")
        .selectExpr("c_custkey", "c_nationkey", "c_mktsegment", charges)
        .join(last_order, F.expr("c_custkey = buyer"), "left")
        .selectExpr(*columns)
    )


def _stage_times(log: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per user with a signup: the time of each funnel stage, NULL if not reached.

    Onboarding is the first view within three days of the first signup, the
    purchases the first ones within two days of the stage before.  Each stage is
    a join with the users at hand and a minimum per user.  The joins and minima
    share the user key, so hot users are salted: their events are spread over
    slices and their one row is repeated per slice.
    """
    counts = (
        log.where("event_type IN ('signup', 'view', 'purchase') AND user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(
            F.expr("min(ts) FILTER (WHERE event_type = 'signup')").alias(STAGES[0]),
            F.expr("count_if(event_type <> 'signup')").alias("later_events"),
        )
    )
    hot = HotKeys(counts, "user_id", "later_events", slice_rows)
    times = counts.where(f"{STAGES[0]} IS NOT NULL").drop("later_events")

    # Both purchase stages read the same shuffle of the purchases.
    later = {
        kind: hot.spread(
            log.where(f"event_type = '{kind}'").select("user_id", "event_id", "ts"), "event_id"
        ).selectExpr("user_id AS _user", "_salt AS _slice", "ts")
        for kind in ("view", "purchase")
    }
    for before, stage, kind, days in (
        (STAGES[0], STAGES[1], "view", 3),
        (STAGES[1], STAGES[2], "purchase", 2),
        (STAGES[2], STAGES[3], "purchase", 2),
    ):
        known = [c for c in times.columns if c != "user_id"]
        in_time = F.expr(
            f"""user_id = _user AND _salt = _slice
                AND ts > {before} AND ts <= {before} + INTERVAL {days} DAYS"""
        )
        times = (
            hot.repeat(times)
            .join(later[kind], in_time, "left")
            .groupBy("user_id")
            .agg(*[F.min(c).alias(c) for c in known], F.min("ts").alias(stage))
        )
    return times


# All dates of a user move by the same number of days, so that signups fill a
# year of weekly cohorts.
SHIFT = "CAST((user_id * 7) % 364 AS INT)"


def funnel_events(log: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Funnel events from an event log, at most one per user and stage."""
    reached = ", ".join(
        f"struct('{s}' AS event_type, date_add(CAST({s} AS DATE), {SHIFT}) AS event_date)"
        for s in STAGES
    )
    return (
        _stage_times(log, slice_rows)
        .selectExpr("user_id", f"inline(array({reached}))")
        .where("event_date IS NOT NULL")
    )


# Signup of users whose signup is not in the event log.
NO_SIGNUP = "DATE'2024-01-01'"


def funnel_users(spark: SparkSession, folder: str, log: DataFrame | None = None) -> DataFrame:
    """A user per customer, by the date of the first signup in the event log.

    Users who never signed up there have no funnel events either.
    """
    log = table(spark, folder, "events") if log is None else log
    signups = (
        log.where("event_type = 'signup' AND user_id IS NOT NULL")
        .groupBy(F.col("user_id").alias("_user"))
        .agg(F.min("ts").cast("date").alias("signup"))
    )
    people = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .withColumn("user_id", F.col("c_custkey"))
    )
    return people.join(signups, F.expr("user_id = _user"), "left").selectExpr(
        "user_id",
        f"date_add(coalesce(signup, {NO_SIGNUP}), {SHIFT}) AS signup_date",
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'organic' WHEN 'BUILDING' THEN 'paid_search'
           WHEN 'FURNITURE' THEN 'referral' WHEN 'HOUSEHOLD' THEN 'email' ELSE 'social' END
           AS channel""",
        "if(user_id % 3 = 0, 'returning', 'new') AS segment",
        "n_name AS city",
        "elt(user_id % 3 + 1, 'mobile', 'desktop', 'tablet') AS device",
    )


_staged: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def staged(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A derived table of a folder, written when it is first asked for.

    Stands in for the stored tables that the reports are meant for: once per
    application and folder, until ``release_scratch`` removes it.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _staged or not is_scratch(spark, _staged[key][0]):
        frame, path = build(), scratch_path(spark, name)
        frame.write.parquet(path)
        _staged[key] = (path, frame.schema)
    path, schema = _staged[key]
    return spark.read.schema(schema).parquet(path)


def funnel(spark: SparkSession, folder: str) -> Funnel:
    """Users and events; the events are derived from the log once per folder."""
    log = table(spark, folder, "events").where("user_id IS NOT NULL")
    return Funnel(
        users=staged(spark, folder, "funnel-users", lambda: funnel_users(spark, folder, log)),
        events=staged(spark, folder, "funnel-events", lambda: funnel_events(log)),
    )


def flat_file(spark: SparkSession, folder: str) -> DataFrame:
    """The flat sales file, written once per folder, to split from."""
    return staged(spark, folder, "sales-flat", lambda: sales_flat(spark, folder))

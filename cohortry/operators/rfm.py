"""Recency, frequency and monetary scoring of customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import (
    money_total,
    percent,
    rounded,
    whole_average,
)
from cohortry.functions.buckets import rfm_segment
from cohortry.functions.dates import days_between
from cohortry.plans.ordering import add_tiles

# Fixed value: the day recency is counted to unless the caller names another.
AS_OF = dt.date(2017, 12, 31)

SCORES = {
    "r_score": ("recency_days", True),
    "f_score": ("frequency", False),
    "m_score": ("monetary", False),
}


def rfm_base(orders: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Days since the last order, distinct orders and spend per customer.

    Lines are first summed per customer *and order*: a customer who holds a
    third of all lines is then spread over tasks by order, and the distinct
    count becomes a plain count.
    """
    per_order = orders.groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("_last"), F.sum("sales").alias("_sales")
    )
    return per_order.groupBy("customer_id").agg(
        days_between(F.max("_last"), F.lit(as_of)).alias("recency_days"),
        F.count("order_id").alias("frequency"),
        money_total(F.col("_sales")).alias("monetary"),
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores, best customers 5; ties are broken by customer id."""
    return add_tiles(base, "customer_id", SCORES, tiles=5)


def _with_segment(scores: DataFrame) -> DataFrame:
    segment = rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scores.withColumn("customer_segment", segment)


def vw_rfm_segments(orders: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Scores and segment per customer."""
    return _with_segment(rfm_scores(rfm_base(orders, as_of)))


def rfm_customers(orders: DataFrame, customers: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Scores, total, cell and segment per customer, with who the customer is."""
    scored = vw_rfm_segments(orders, as_of)
    people = customers.select("customer_id", "customer_name", "segment", "region")
    return scored.join(people, "customer_id").select(
        "customer_id",
        "customer_name",
        "segment",
        "region",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("total_rfm_score"),
        F.concat(
            F.col("r_score").cast("string"),
            F.col("f_score").cast("string"),
            F.col("m_score").cast("string"),
        ).alias("rfm_cell"),
        "customer_segment",
    )


def summarise_segments(scored: DataFrame) -> DataFrame:
    """Size, averages and revenue per segment of an RFM segment table."""
    return scored.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        whole_average(F.col("recency_days")).alias("avg_recency_days"),
        rounded(F.avg("frequency"), 1).alias("avg_orders"),
        rounded(F.avg("monetary"), 2).alias("avg_spend"),
        money_total(F.col("monetary")).alias("total_revenue"),
    )


def rfm_segment_summary(orders: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    return summarise_segments(vw_rfm_segments(orders, as_of))


def rfm_segment_share(orders: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Share of customers and of revenue per segment, and average spend."""
    summary = rfm_segment_summary(orders, as_of)
    everyone = Window.partitionBy()
    return summary.select(
        "customer_segment",
        "customer_count",
        percent(F.col("customer_count"), F.sum("customer_count").over(everyone)).alias(
            "pct_of_customers"
        ),
        "avg_spend",
        percent(F.col("total_revenue"), F.sum("total_revenue").over(everyone)).alias(
            "revenue_pct"
        ),
    )

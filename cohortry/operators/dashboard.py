"""Figures that only the dashboard pages show, derived from the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import count_where, percent, percent_left
from cohortry.functions.buckets import first_match
from cohortry.operators import churn, funnel

# Lowest percentage of each heat band.
HEAT_BANDS = ((40, "≥40"), (30, "≥30"), (20, "≥20"))
HEAT_REST = "<20"

# Our thresholds: the page shows badges without stating them.
HIGH_RISK_BELOW = 50
MEDIUM_RISK_BELOW = 90

# Column order of the stopping stages by device.
DROP_OFF_STAGES = (
    "Dropped at Onboarding", "Dropped after Onboarding", "One-time Buyers", "Repeat Buyers",
    "Unknown",
)


def kpi_retention_rate(customers: DataFrame) -> DataFrame:
    """Active customers and their share."""
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        count_where(churn.is_active()).alias("retained"),
    ).withColumn("retention_rate_pct", percent(F.col("retained"), F.col("total_customers")))


def kpi_highest_risk_segment(customers: DataFrame) -> DataFrame:
    """The support/security mix with the highest churn rate, ties by name."""
    return (
        churn.risk_segment(customers)
        .orderBy(F.desc("churn_rate_pct"), "tech_support", "online_security")
        .limit(1)
    )


def cohort_risk_badge(
    customers: DataFrame, high: float = HIGH_RISK_BELOW, medium: float = MEDIUM_RISK_BELOW
) -> DataFrame:
    """Risk badge per tenure cohort by its retention."""
    kept = F.col("retention_rate_pct")
    badge = first_match([(kept < high, "High"), (kept < medium, "Medium")], "Low")
    return churn.cohort_tenure(customers).select(
        "cohort", "total_customers", "retention_rate_pct", badge.alias("risk")
    )


def churn_by_6m_tenure(customers: DataFrame) -> DataFrame:
    """Churn per six months of tenure, and cumulative.

    A step is named by its last month; months up to 6 make the first.
    The window has no partition; it runs over one row per step.
    """
    tenure = F.col("tenure")
    step = F.when(tenure <= 6, 6).otherwise((F.ceil(tenure / 6) * 6).cast("int"))
    steps = customers.groupBy(step.alias("tenure_upto")).agg(
        F.count(F.lit(1)).alias("customers"),
        count_where(churn.has_churned()).alias("churned"),
    )
    upto = Window.orderBy("tenure_upto").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        "*",
        percent(F.col("churned"), F.col("customers")).alias("churn_rate_pct"),
        percent(F.sum("churned").over(upto), F.sum("customers").over(upto)).alias(
            "cumulative_churn_rate_pct"
        ),
    )


def driver_matrix(customers: DataFrame) -> DataFrame:
    """Churn rate per internet service (rows) and support/security mix (columns).

    The mix is whether a customer has support and security: any answer but Yes,
    none included, is not having it ("No internet service" say).
    """
    support = F.when(F.col("tech_support") == "Yes", "support").otherwise("no_support")
    security = F.when(F.col("online_security") == "Yes", "security").otherwise("no_security")
    mixes = ["no_support_no_security", "no_support_security",
             "support_no_security", "support_security"]
    return (
        customers.withColumn("_mix", F.concat_ws("_", support, security))
        .groupBy("internet_service")
        .pivot("_mix", mixes)
        .agg(percent(count_where(churn.has_churned()), F.count(F.lit(1))))
    )


def funnel_step_drop(events: funnel.Events) -> DataFrame:
    """Per step: share of signups, users lost and drop since the step before.

    The windows run over the four funnel steps.
    """
    order = Window.orderBy("step_order")
    before = F.lag("users").over(order)
    first = F.first("users").over(order)
    return (
        funnel.vw_funnel_summary(events)
        .withColumn("_before", before)
        .withColumn("_first", first)
        .select(
            "step_order",
            "funnel_step",
            "users",
            percent(F.col("users"), F.col("_first")).alias("pct_of_signups"),
            (F.col("_before") - F.col("users")).alias("users_lost"),
            percent_left(F.col("users"), F.col("_before")).alias("drop_pct"),
        )
    )


def biggest_dropoff(events: funnel.Events) -> DataFrame:
    """The step that loses the largest share, the earlier one on a tie."""
    return (
        funnel_step_drop(events)
        .where(F.col("drop_pct").isNotNull())
        .orderBy(F.desc("drop_pct"), "step_order")
        .limit(1)
        .select("funnel_step", "users_lost", "drop_pct")
    )


def dropoff_by_device(users: DataFrame, events: funnel.Events) -> DataFrame:
    """Users per device (rows) and stopping stage (columns); the columns hold all users."""
    names = [s.lower().replace(" ", "_").replace("-", "_") for s in DROP_OFF_STAGES]
    matrix = (
        funnel.vw_dropoff_by_stage(users, events)
        .groupBy("device")
        .pivot("stage", list(DROP_OFF_STAGES))
        .agg(F.sum("users"))
    )
    return matrix.select(
        "device",
        *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(n) for s, n in zip(DROP_OFF_STAGES, names)],
    )


def cohort_heat_band(users: DataFrame, events: funnel.Events) -> DataFrame:
    """Heat band of every cell of the cohort matrix, one row per cell."""
    cells = funnel.vw_cohort_matrix(users, events).select(
        "yr",
        "wk",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("within_days"),
                        F.col(f"retention_{n}d").alias("retention_pct"),
                    )
                    for n in funnel.RETENTION_DAYS
                ]
            )
        ),
    )
    value = F.col("retention_pct")
    band = first_match([(value >= low, label) for low, label in HEAT_BANDS], HEAT_REST)
    return cells.withColumn("band", band)

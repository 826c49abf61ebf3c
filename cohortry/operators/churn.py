"""Subscriber churn: rates, profiles, tenure cohorts and risk rankings.

Every function takes the subscriber table (one row per ``customer_id``).
Results carry no row order unless the docstring names one; sort for display.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import (
    count_where,
    percent,
    percent_left,
    rounded,
    sum_where,
    whole_average,
)
from cohortry.functions.buckets import churn_risk, tenure_cohort
from cohortry.plans.ordering import add_ranks

RISK_ORDER = [("monthly_charges", True), ("tenure", False)]


def has_churned() -> Column:
    return F.col("churn") == "Yes"


def is_active() -> Column:
    return F.col("churn") == "No"


def churn_rate_by(customers: DataFrame, *keys, total: str = "total") -> DataFrame:
    """Customers, churned customers and churn rate per key."""
    return (
        customers.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(total),
            count_where(has_churned()).alias("churned"),
        )
        .withColumn("churn_rate_pct", percent(F.col("churned"), F.col(total)))
    )


def churn_overall(customers: DataFrame) -> DataFrame:
    """Customers per churn value and their share of all customers."""
    groups = customers.groupBy("churn").agg(F.count(F.lit(1)).alias("total_customers"))
    everyone = F.sum("total_customers").over(Window.partitionBy())
    return groups.withColumn("churn_pct", percent(F.col("total_customers"), everyone))


def churn_profile(customers: DataFrame) -> DataFrame:
    """Average tenure (whole months, truncated) and charges per churn value."""
    return customers.groupBy("churn").agg(
        F.count(F.lit(1)).alias("customers"),
        whole_average(F.col("tenure")).alias("avg_tenure_months"),
        rounded(F.avg("monthly_charges"), 2).alias("avg_monthly_charges"),
        rounded(F.avg("total_charges"), 2).alias("avg_total_charges"),
    )


def churn_by_contract(customers: DataFrame) -> DataFrame:
    return churn_rate_by(customers, "contract")


def churn_by_payment(customers: DataFrame) -> DataFrame:
    return churn_rate_by(customers, "payment_method")


def churn_by_internet(customers: DataFrame) -> DataFrame:
    return churn_rate_by(customers, "internet_service")


def risk_segment(customers: DataFrame) -> DataFrame:
    return churn_rate_by(customers, "tech_support", "online_security")


def high_value_churned(customers: DataFrame) -> DataFrame:
    """Churned customers who paid more than the average of *all* customers."""
    average = customers.agg(F.avg("monthly_charges")).scalar()
    return customers.where(has_churned() & (F.col("monthly_charges") > average)).select(
        "customer_id", "tenure", "contract", "monthly_charges", "total_charges", "payment_method"
    )


def _with_retention(groups: DataFrame, total: str) -> DataFrame:
    return groups.withColumn(
        "retention_rate_pct", percent_left(F.col("churned"), F.col(total))
    )


def cohort_tenure(customers: DataFrame) -> DataFrame:
    """Churn and retention per numbered tenure cohort."""
    cohort = tenure_cohort(F.col("tenure"), numbered=True).alias("cohort")
    groups = churn_rate_by(customers, cohort, total="total_customers")
    return _with_retention(groups, "total_customers")


def contract_cohort(customers: DataFrame) -> DataFrame:
    """Churn rate per contract and tenure cohort."""
    return churn_rate_by(customers, "contract", tenure_cohort(F.col("tenure")).alias("cohort"))


def running_churn(customers: DataFrame) -> DataFrame:
    """Churn accumulated over tenure months.

    The window has no partition; it runs over one row per month of tenure.
    """
    months = customers.groupBy("tenure").agg(
        F.count(F.lit(1)).alias("total_at_tenure"),
        count_where(has_churned()).alias("churned_at_tenure"),
    )
    upto = Window.orderBy("tenure").rowsBetween(Window.unboundedPreceding, 0)
    return (
        months.withColumn("running_total_churned", F.sum("churned_at_tenure").over(upto))
        .withColumn("running_total_users", F.sum("total_at_tenure").over(upto))
        .withColumn(
            "cumulative_churn_rate_pct",
            percent(F.col("running_total_churned"), F.col("running_total_users")),
        )
    )


def risk_ranking(customers: DataFrame) -> DataFrame:
    """Active customers ranked by charges (high first) and tenure (short first),
    within their contract and over all."""
    active = customers.where(is_active()).select(
        "customer_id", "contract", "tenure", "monthly_charges", "internet_service"
    )
    return add_ranks(
        active,
        RISK_ORDER,
        {"risk_rank_within_contract": ["contract"], "overall_risk_rank": []},
    ).select(*active.columns, "risk_rank_within_contract", "overall_risk_rank")


def charges_percentile(customers: DataFrame) -> DataFrame:
    """Percent rank of a customer's charges within the contract, 0 to 100."""
    people = customers.select("customer_id", "contract", "monthly_charges", "churn")
    ranked = add_ranks(
        people,
        [("monthly_charges", False)],
        {"_rank": ["contract"]},
        sizes={"_rank": "_peers_in_contract"},
    )
    others = F.col("_peers_in_contract") - 1
    share = F.when(others > 0, (F.col("_rank") - 1) / others).otherwise(F.lit(0.0))
    return ranked.select(
        "customer_id",
        "contract",
        "monthly_charges",
        rounded(share * 100, 1).alias("charges_percentile_in_contract"),
        "churn",
    )


def churn_month_lag(customers: DataFrame) -> DataFrame:
    """Churn rate per tenure month against the previous month that has customers.

    The window has no partition; it runs over one row per month of tenure.
    """
    months = (
        customers.groupBy(F.col("tenure").alias("month"))
        .agg(
            count_where(has_churned()).alias("churned"),
            F.count(F.lit(1)).alias("total"),
        )
        .withColumn("churn_rate", percent(F.col("churned"), F.col("total")))
    )
    previous = F.lag("churn_rate").over(Window.orderBy("month"))
    return months.withColumn("prev_month_churn_rate", previous).withColumn(
        "churn_rate_change", F.round(F.col("churn_rate") - F.col("prev_month_churn_rate"), 2)
    )


def vw_churn_kpi_summary(customers: DataFrame) -> DataFrame:
    """One row of key figures; sums are NULL when there are no customers."""
    churned, active = has_churned(), is_active()
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        sum_where(churned).alias("total_churned"),
        sum_where(active).alias("total_retained"),
        percent(sum_where(churned), F.count(F.lit(1))).alias("overall_churn_rate_pct"),
        rounded(F.avg(F.when(churned, F.col("monthly_charges"))), 2).alias("avg_charges_churned"),
        rounded(F.avg(F.when(active, F.col("monthly_charges"))), 2).alias("avg_charges_retained"),
        rounded(F.avg(F.when(churned, F.col("tenure"))), 1).alias("avg_tenure_churned"),
        rounded(F.avg(F.when(active, F.col("tenure"))), 1).alias("avg_tenure_retained"),
    )


def vw_churn_by_contract(customers: DataFrame) -> DataFrame:
    """Churn rate and average monthly charges per contract."""
    return (
        customers.groupBy("contract")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            count_where(has_churned()).alias("churned"),
            rounded(F.avg("monthly_charges"), 2).alias("avg_monthly_charges"),
        )
        .withColumn("churn_rate_pct", percent(F.col("churned"), F.col("total_customers")))
        .select("contract", "total_customers", "churned", "churn_rate_pct", "avg_monthly_charges")
    )


def vw_cohort_retention(customers: DataFrame) -> DataFrame:
    """Churn and retention per tenure cohort and contract."""
    cohort = tenure_cohort(F.col("tenure")).alias("cohort")
    groups = churn_rate_by(customers, cohort, "contract", total="total_customers")
    return _with_retention(groups, "total_customers")


def vw_churn_by_payment(customers: DataFrame) -> DataFrame:
    return churn_by_payment(customers)


def _risk_columns(customers: DataFrame) -> DataFrame:
    return customers.where(is_active()).select(
        "customer_id",
        "contract",
        "tenure",
        "monthly_charges",
        "internet_service",
        "tech_support",
        "online_security",
        churn_risk(F.col("tenure"), F.col("monthly_charges"), F.col("tech_support")).alias(
            "churn_risk_segment"
        ),
    )


def vw_active_customer_risk(customers: DataFrame) -> DataFrame:
    """Active customers with a risk label and their overall risk rank."""
    active = _risk_columns(customers)
    ranked = add_ranks(active, RISK_ORDER, {"overall_risk_rank": []})
    return ranked.select(*active.columns, "overall_risk_rank")


def top_at_risk(customers: DataFrame, n: int = 6) -> DataFrame:
    """The first ``n`` rows of the active-customer risk view, ties by id.

    A rank counts only rows that come before, so ranking the top ``n`` alone
    gives the same numbers as ranking everyone.
    """
    top = (
        _risk_columns(customers)
        .orderBy(F.desc("monthly_charges"), F.asc("tenure"), F.asc("customer_id"))
        .limit(n)
    )
    order = Window.orderBy(F.desc("monthly_charges"), F.asc("tenure"))
    return top.withColumn("overall_risk_rank", F.rank().over(order).cast("bigint"))


def vw_churn_drivers(customers: DataFrame, at_least: int = 10) -> DataFrame:
    """Churn rate by service mix and contract, for groups of some size."""
    return churn_rate_by(
        customers, "internet_service", "tech_support", "online_security", "contract"
    ).where(F.col("total") >= at_least)

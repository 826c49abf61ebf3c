"""The row order each report is shown in.

Reports return unordered rows, because sorting a customer-grain result costs a
range shuffle that a further job does not need.  Sort when showing or exporting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort columns per report, descending where marked with "-".
DISPLAY_ORDER = {
    "churn_by_contract": ("-churn_rate_pct",),
    "churn_by_payment": ("-churn_rate_pct",),
    "churn_by_internet": ("-churn_rate_pct",),
    "high_value_churned": ("-monthly_charges",),
    "risk_segment": ("-churn_rate_pct",),
    "cohort_tenure": ("cohort",),
    "contract_cohort": ("contract", "cohort"),
    "running_churn": ("tenure",),
    "risk_ranking": ("overall_risk_rank",),
    "charges_percentile": ("contract", "-monthly_charges"),
    "churn_month_lag": ("month",),
    "vw_churn_drivers": ("-churn_rate_pct",),
    "top_at_risk": ("overall_risk_rank", "customer_id"),
    "churn_by_6m_tenure": ("tenure_upto",),
    "monthly_revenue": ("month_label",),
    "top_products": ("-total_revenue",),
    "loss_products": ("total_profit",),
    "category_contribution": ("category", "-revenue"),
    "regional_performance": ("-revenue",),
    "shipping_performance": ("-late_delivery_rate_pct",),
    "discount_impact": ("-profit_margin_pct",),
    "rfm_customers": ("-total_rfm_score",),
    "rfm_segment_summary": ("-total_revenue",),
    "channel_funnel": ("-overall_conv_pct",),
    "device_funnel": ("-purchase_rate_pct",),
    "time_to_convert": ("avg_days_to_purchase",),
    "cohort_retention": ("signup_year", "signup_week"),
    "dropoff_users": ("-user_count",),
    "journey_report": ("-overall_conv_pct",),
    "vw_funnel_summary": ("step_order",),
    "funnel_step_drop": ("step_order",),
    "vw_cohort_matrix": ("yr", "wk"),
}


def for_display(name: str, report: DataFrame) -> DataFrame:
    """Sort a report the way it is shown; NULLs count as lowest.

    Rows equal in the shown order are sorted by their other columns, so that the
    same rows are always shown in the same order.
    """
    if name == "quarterly_yoy":
        label = F.col("quarter_label")
        return report.orderBy(F.substring(label, 4, 4), F.substring(label, 2, 1), label)
    columns = DISPLAY_ORDER.get(name, ())
    if not columns:
        return report
    shown = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in columns]
    named = {c.removeprefix("-") for c in columns}
    return report.orderBy(*shown, *[F.asc(c) for c in report.columns if c not in named])

"""The named views, and how to publish them.

A view is registered for Spark SQL, or published as a version of parquet files that
outlives the session and can be replaced while being read.  Views with a rank or
tile hold the rows of the moment they were built; build them again to see newer data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortry.operators import churn, funnel, rfm, sales
from cohortry.plans import publishing

CHURN_VIEWS = {
    "vw_churn_kpi_summary": churn.vw_churn_kpi_summary,
    "vw_churn_by_contract": churn.vw_churn_by_contract,
    "vw_cohort_retention": churn.vw_cohort_retention,
    "vw_churn_by_payment": churn.vw_churn_by_payment,
    "vw_active_customer_risk": churn.vw_active_customer_risk,
    "vw_churn_drivers": churn.vw_churn_drivers,
}

SALES_VIEWS = {
    "vw_monthly_revenue_trend": lambda t: sales.vw_monthly_revenue_trend(t.orders),
    "vw_category_performance": lambda t: sales.vw_category_performance(t.orders, t.products),
    "vw_regional_kpi": lambda t: sales.vw_regional_kpi(t.orders, t.customers),
    "vw_rfm_segments": lambda t: rfm.vw_rfm_segments(t.orders),
    "vw_discount_impact": lambda t: sales.vw_discount_impact(t.orders),
}

FUNNEL_VIEWS = {
    "vw_funnel_summary": lambda t: funnel.vw_funnel_summary(t.events),
    "vw_channel_conversion": lambda t: funnel.vw_channel_conversion(t.users, t.events),
    "vw_cohort_matrix": lambda t: funnel.vw_cohort_matrix(t.users, t.events),
    "vw_dropoff_by_stage": lambda t: funnel.vw_dropoff_by_stage(t.users, t.events),
}


def register_views(views: dict[str, Callable[..., DataFrame]], tables) -> list[str]:
    """Register every view of a business area over its tables; returns the names."""
    for name, build in views.items():
        build(tables).createOrReplaceTempView(name)
    return list(views)


def publish_view(
    view: DataFrame, path: str, partition_by: str | list[str] | None = None, name: str = "view"
) -> DataFrame:
    """Publish a view as the next version at ``path`` and return that version.

    Readers of the version before are not disturbed, see ``plans.publishing``.
    """
    version = publishing.publish({name: view}, path, partition_by)
    return publishing.read_published(view.sparkSession, path, name, version.number)


def publish_views(views: dict[str, Callable[..., DataFrame]], tables, folder: str) -> list[str]:
    """Publish every view of a business area as one version; returns the names."""
    return list(publishing.publish_built(views, tables, folder).schemas)


def preview_view(spark: SparkSession, name: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of a registered view, in no particular order."""
    return spark.table(name).limit(n)

"""Revenue, product, regional, shipping and discount reports.

``orders`` holds one row per order *line*; ``order_id`` repeats.  Lines are
summed per product, or per order and customer, before they meet a dimension or a
distinct count, so that the wide shuffle carries sums instead of lines.  Joins
carry no broadcast hint: Spark broadcasts a dimension whose measured size
allows, and AQE splits a skewed key otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import (
    count_where,
    money_total,
    percent,
    quotient,
    rounded,
)
from cohortry.functions.buckets import (
    DISCOUNT_DASHBOARD_LABELS,
    DISCOUNT_REPORT_LABELS,
    discount_band,
    on_time_limit,
)
from cohortry.functions.dates import days_between, month_label
from cohortry.plans.distinct_sets import SalesSets
from cohortry.plans.durable import hold
from cohortry.plans.sizes import broadcast_if_small

PRODUCT_KEYS = ("product_name", "category", "sub_category")


def _margin() -> Column:
    return percent(F.sum("profit"), F.sum("sales"))


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _with_growth(periods: DataFrame, order: str, back: int, before: str, growth: str):
    """Add the revenue ``back`` rows earlier and the growth since then.

    Windows without a partition run over one row per calendar period.
    """
    earlier = F.lag("revenue", back).over(Window.orderBy(order))
    return periods.withColumn(before, earlier).withColumn(
        growth, percent(F.col("revenue") - F.col(before), F.col(before))
    )


def _trend(months: DataFrame, rolling: str, counts: list[str]) -> DataFrame:
    """Month labels, growth and the mean over three *present* months."""
    recent = Window.orderBy("month").rowsBetween(-2, 0)
    return _with_growth(months, "month", 1, "prev_month_revenue", "mom_growth_pct").select(
        month_label(F.col("month")).alias("month_label"),
        "revenue",
        "profit",
        *counts,
        "prev_month_revenue",
        "mom_growth_pct",
        rounded(F.avg("revenue").over(recent), 2).alias(rolling),
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """Revenue, profit, orders and customers per month, with month-on-month
    growth and a rolling mean.  Months without orders have no row."""
    months = (
        orders.groupBy(F.trunc("order_date", "month").alias("month"), "order_id", "customer_id")
        .agg(*_sums("sales", "profit"))
        .groupBy("month")
        .agg(
            money_total(F.col("sales")).alias("revenue"),
            money_total(F.col("profit")).alias("profit"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return _trend(months, "rolling_3m_avg_revenue", ["total_orders", "unique_customers"])


def monthly_revenue_from_sets(sets: SalesSets) -> DataFrame:
    """``monthly_revenue`` from stored sums and sets."""
    months = sets.by({"month": F.col("month")}).select(
        "month",
        F.round("sales", 2).alias("revenue"),
        F.round("profit", 2).alias("profit"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
    )
    return _trend(months, "rolling_3m_avg_revenue", ["total_orders", "unique_customers"])


def quarterly_customers(sets: SalesSets) -> DataFrame:
    """Revenue, orders and customers per quarter; the months' sets are merged."""
    quarter = F.concat_ws("-", F.concat(F.lit("Q"), F.quarter("month")), F.year("month"))
    return sets.by({"quarter_label": quarter}).select(
        "quarter_label",
        F.round("sales", 2).alias("revenue"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
    )


def regional_performance_from_sets(sets: SalesSets) -> DataFrame:
    """``regional_performance`` from stored sums and sets."""
    states = sets.by({"region": F.col("region"), "state": F.col("state")}).where("region IS NOT NULL")
    return states.select(
        "region",
        "state",
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        F.round("sales", 2).alias("revenue"),
        F.col("profit"),
        percent(F.col("profit"), F.col("sales")).alias("profit_margin_pct"),
        F.round(quotient(F.col("discount"), F.col("discounts")), 3).alias("avg_discount"),
        F.round(quotient(F.col("sales"), F.col("orders")), 2).alias("avg_order_value"),
    )


def vw_monthly_revenue_trend(orders: DataFrame) -> DataFrame:
    """Monthly revenue for a line chart; no customer count."""
    months = orders.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        money_total(F.col("sales")).alias("revenue"),
        money_total(F.col("profit")).alias("profit"),
        F.count_distinct("order_id").alias("orders"),
    )
    return _trend(months, "rolling_3m_avg", ["orders"])


def quarterly_yoy(orders: DataFrame) -> DataFrame:
    """Revenue per quarter against the fourth quarter row before it.

    The comparison counts rows, not calendar quarters: a missing quarter shifts it.
    """
    quarters = orders.groupBy(F.trunc("order_date", "quarter").alias("start")).agg(
        money_total(F.col("sales")).alias("revenue"),
        money_total(F.col("profit")).alias("profit"),
        _margin().alias("profit_margin_pct"),
    )
    label = F.concat_ws(
        "-", F.concat_ws("", F.lit("Q"), F.quarter("start")), F.year("start")
    )
    return _with_growth(quarters, "start", 4, "same_qtr_last_year", "yoy_growth_pct").select(
        label.alias("quarter_label"),
        "revenue",
        "profit",
        "profit_margin_pct",
        "same_qtr_last_year",
        "yoy_growth_pct",
    )


def _per_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sums per product, joined with the product's attributes."""
    return (
        orders.groupBy("product_id")
        .agg(
            *_sums("sales", "profit", "quantity", "discount"),
            F.count("discount").alias("discounts"),
        )
        .join(products, "product_id")
    )


def top_products(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with most revenue, ties by name and category.

    Orders are counted in a second narrow scan, for the lines of the top
    products only: counting them for all products would shuffle every line.  Both
    scans run when the function is called; the ``n`` rows of each are held, so the
    result is of one moment.
    """
    top = hold(
        _per_product(orders, products)
        .groupBy(*PRODUCT_KEYS)
        .agg(
            money_total(F.col("sales")).alias("total_revenue"),
            money_total(F.col("profit")).alias("total_profit"),
            _margin().alias("profit_margin_pct"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy(F.desc("total_revenue"), *PRODUCT_KEYS)
        .limit(n),
        n,
    )
    same = " AND ".join(f"t.{c} <=> p.{c}" for c in PRODUCT_KEYS)
    # At most n rows are broadcast here; one product name may have several ids.
    members = products.alias("p").join(F.broadcast(top.alias("t")), F.expr(same)).select("product_id", "t.*")
    counted = hold(
        orders.select("product_id", "order_id")
        .join(broadcast_if_small(members), "product_id")
        .groupBy(*top.columns)
        .agg(F.count_distinct("order_id").alias("order_count")),
        n,
    )
    return counted.select(*top.columns, "order_count").orderBy(F.desc("total_revenue"), *PRODUCT_KEYS)


def loss_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Products that lose money over all their lines."""
    return (
        _per_product(orders, products)
        .groupBy(*PRODUCT_KEYS)
        .agg(
            money_total(F.col("sales")).alias("total_revenue"),
            money_total(F.col("profit")).alias("total_profit"),
            _margin().alias("profit_margin_pct"),
            F.round(quotient(F.sum("discount"), F.sum("discounts")), 2).alias("avg_discount"),
            F.sum("profit").alias("_profit"),
        )
        .where(F.col("_profit") < 0)
        .drop("_profit")
    )


def _per_category(orders: DataFrame, products: DataFrame, *measures: Column) -> DataFrame:
    return (
        _per_product(orders, products)
        .groupBy("category", "sub_category")
        .agg(
            money_total(F.col("sales")).alias("revenue"),
            money_total(F.col("profit")).alias("profit"),
            *measures,
        )
    )


def category_contribution(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Share of revenue per sub-category, over all and within its category."""
    # One row per sub-category reaches these windows.
    everything, category = Window.partitionBy(), Window.partitionBy("category")
    revenue = F.col("revenue")
    return _per_category(orders, products).select(
        "*",
        percent(revenue, F.sum(revenue).over(everything)).alias("pct_of_total_revenue"),
        percent(revenue, F.sum(revenue).over(category)).alias("pct_within_category"),
        F.rank().over(category.orderBy(F.desc("revenue"))).alias("rank_in_category"),
    )


def vw_category_performance(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, profit, margin, units and share of total per sub-category."""
    groups = _per_category(
        orders, products, _margin().alias("margin_pct"), F.sum("quantity").alias("units_sold")
    )
    total = F.sum("revenue").over(Window.partitionBy())
    return groups.withColumn("pct_of_total", percent(F.col("revenue"), total))


def category_rollup(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue of categories and of their sub-categories in one list.

    ``level`` tells them apart; the sub-category of a category row is NULL.
    """
    return (
        _per_category(orders, products)
        .rollup("category", "sub_category")
        .agg(F.sum("revenue").alias("revenue"), F.grouping_id().alias("_grouped"))
        .where(F.col("_grouped") < 3)
        .select(
            F.when(F.col("_grouped") == 1, "category").otherwise("sub_category").alias("level"),
            "category",
            "sub_category",
            "revenue",
        )
    )


def _per_state(orders: DataFrame, customers: DataFrame, order_count: str, customer_count: str):
    """Sums per region and state.

    Lines become one row per order and customer before the join, which is also
    the grain the two distinct counts need.
    """
    places = customers.select("customer_id", "region", "state")
    return (
        orders.groupBy("order_id", "customer_id")
        .agg(*_sums("sales", "profit", "discount"), F.count("discount").alias("discounts"))
        .join(places, "customer_id")
        .groupBy("region", "state")
        .agg(
            F.count_distinct("order_id").alias(order_count),
            F.count_distinct("customer_id").alias(customer_count),
            *_sums("sales", "profit", "discount", "discounts"),
        )
        .withColumn("revenue", F.round("sales", 2))
        .withColumn("margin", percent(F.col("profit"), F.col("sales")))
    )


def regional_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, customers, revenue, margin and order value per region and state."""
    return _per_state(orders, customers, "total_orders", "unique_customers").select(
        "region",
        "state",
        "total_orders",
        "unique_customers",
        "revenue",
        "profit",
        F.col("margin").alias("profit_margin_pct"),
        F.round(quotient(F.col("discount"), F.col("discounts")), 3).alias("avg_discount"),
        F.round(quotient(F.col("sales"), F.col("total_orders")), 2).alias("avg_order_value"),
    )


def vw_regional_kpi(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, customers, revenue, profit and margin per region and state."""
    return _per_state(orders, customers, "orders", "customers").select(
        "region",
        "state",
        "orders",
        "customers",
        "revenue",
        "profit",
        F.col("margin").alias("margin_pct"),
    )


def shipping_performance(orders: DataFrame) -> DataFrame:
    """Late lines per ship mode.  A missing date counts as a line, not as late."""
    days = days_between(F.col("order_date"), F.col("ship_date"))
    return (
        orders.groupBy("ship_mode")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            count_where(days > on_time_limit(F.col("ship_mode"))).alias("late_deliveries"),
            rounded(F.avg(days), 1).alias("avg_ship_days"),
        )
        .select(
            "ship_mode",
            "total_orders",
            "late_deliveries",
            percent(F.col("late_deliveries"), F.col("total_orders")).alias(
                "late_delivery_rate_pct"
            ),
            "avg_ship_days",
        )
    )


def discount_impact(orders: DataFrame) -> DataFrame:
    """Lines, revenue, profit and margin per discount band."""
    return orders.groupBy(
        discount_band(F.col("discount"), DISCOUNT_REPORT_LABELS).alias("discount_bucket")
    ).agg(
        F.count(F.lit(1)).alias("orders"),
        money_total(F.col("sales")).alias("total_revenue"),
        money_total(F.col("profit")).alias("total_profit"),
        rounded(F.avg("profit"), 2).alias("avg_profit_per_order"),
        _margin().alias("profit_margin_pct"),
    )


def vw_discount_impact(orders: DataFrame) -> DataFrame:
    """The four chart measures per discount band, with the chart's labels."""
    return orders.groupBy(
        discount_band(F.col("discount"), DISCOUNT_DASHBOARD_LABELS).alias("discount_bucket")
    ).agg(
        F.count(F.lit(1)).alias("orders"),
        money_total(F.col("sales")).alias("revenue"),
        money_total(F.col("profit")).alias("profit"),
        _margin().alias("margin_pct"),
    )


def sales_kpi_summary(orders: DataFrame) -> DataFrame:
    """One row: revenue, profit, margin, lines, orders and order value.

    Lines and distinct orders are both given, and the average value of each.
    """
    return orders.agg(
        money_total(F.col("sales")).alias("total_revenue"),
        money_total(F.col("profit")).alias("total_profit"),
        _margin().alias("profit_margin_pct"),
        F.count(F.lit(1)).alias("order_lines"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("sales").alias("_sales"),
    ).select(
        "total_revenue",
        "total_profit",
        "profit_margin_pct",
        "order_lines",
        "orders",
        F.round(quotient(F.col("_sales"), F.col("order_lines")), 2).alias("avg_line_value"),
        F.round(quotient(F.col("_sales"), F.col("orders")), 2).alias("avg_order_value"),
    )


def monthly_kpi_report(orders: DataFrame, year: int, month: int) -> DataFrame:
    """Key figures of a month and of the month before it: always two rows.

    A month without orders has zero counts and NULL measures.  Both months come
    from one scan, bounded by date so that files outside are skipped.
    """
    start = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    periods = (
        orders.sparkSession.range(2)
        .select(
            F.when(F.col("id") == 0, "Current Month").otherwise("Previous Month").alias("period"),
            F.add_months(start, -F.col("id").cast("int")).alias("_start"),
        )
        .withColumn("month", F.date_format("_start", "MMM yyyy"))
    )
    inside = orders.where(
        F.col("order_date").cast("date").between(F.add_months(start, -1), F.last_day(start))
    )
    measured = (
        inside.groupBy(F.trunc("order_date", "month").alias("_start"), "order_id", "customer_id")
        .agg(*_sums("sales", "profit"))
        .groupBy("_start")
        .agg(
            F.count_distinct("order_id").alias("_orders"),
            F.count_distinct("customer_id").alias("_customers"),
            money_total(F.col("sales")).alias("revenue"),
            money_total(F.col("profit")).alias("profit"),
            _margin().alias("profit_margin_pct"),
            F.sum("sales").alias("_sales"),
        )
    )
    return periods.join(measured, "_start", "left").select(
        "period",
        "month",
        F.coalesce("_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("_customers", F.lit(0)).alias("unique_customers"),
        "revenue",
        "profit",
        "profit_margin_pct",
        F.round(quotient(F.col("_sales"), F.col("_orders")), 2).alias("avg_order_value"),
    )

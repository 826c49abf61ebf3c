"""Parameterised reports for Spark SQL.

A report with parameters is a table function: ``SELECT * FROM monthly_kpi_report(2017,
11)``.  Its body is SQL over a table or view of order lines, so that arguments are
folded into the plan and a date filter reaches the scan.

A temporary function goes with the session and may stand on a temporary view; one in
the catalog needs a table of the catalog, and outlives the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PERCENT = (
    "round(CAST(CAST({part} * 100 AS DECIMAL(38,6))"
    " / nullif(CAST({whole} AS DECIMAL(38,6)), 0) AS DECIMAL(38,6)), 2)"
)
_QUOTIENT = (
    "round(CAST(CAST({part} AS DECIMAL(38,6))"
    " / nullif(CAST({whole} AS DECIMAL(38,6)), 0) AS DECIMAL(38,6)), 2)"
)

_MONTHS = f"""
  SELECT trunc(order_date, 'month') AS start, order_id, customer_id,
    sum(sales) AS sales, sum(profit) AS profit
  FROM {{orders}}
  WHERE order_date BETWEEN {{first}} AND {{last}}
  GROUP BY trunc(order_date, 'month'), order_id, customer_id
"""

_MEASURES = f"""
  SELECT start, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers,
    round(CAST(sum(sales) AS DECIMAL(38,2)), 2) AS revenue,
    round(CAST(sum(profit) AS DECIMAL(38,2)), 2) AS profit,
    {_PERCENT.format(part='sum(profit)', whole='sum(sales)')} AS margin,
    {_QUOTIENT.format(part='sum(sales)', whole='count(DISTINCT order_id)')} AS order_value
  FROM ({_MONTHS}) GROUP BY start
"""

_COLUMNS = (
    "period STRING, month STRING, total_orders BIGINT, unique_customers BIGINT,"
    " revenue DECIMAL(38,2), profit DECIMAL(38,2), profit_margin_pct DECIMAL(38,2),"
    " avg_order_value DECIMAL(38,2)"
)

_START = "make_date(report_year, report_month, 1)"

MONTHLY_KPI_REPORT = f"""
CREATE OR REPLACE {{kind}} FUNCTION {{name}}(report_year INT, report_month INT)
RETURNS TABLE ({_COLUMNS})
RETURN
SELECT p.period, date_format(p.start, 'MMM yyyy'), coalesce(m.orders, 0L), coalesce(m.customers, 0L),
  m.revenue, m.profit, m.margin, m.order_value
FROM (
  SELECT inline(array(named_struct('period', 'Current Month', 'start', {_START}),
    named_struct('period', 'Previous Month', 'start', add_months({_START}, -1))))
) AS p LEFT JOIN ({_MEASURES.replace('{first}', f'add_months({_START}, -1)').replace('{last}', f'last_day({_START})')}) AS m
ON m.start = p.start
"""

# Months of a range that have orders, each with its key figures.
KPI_BY_MONTH = f"""
CREATE OR REPLACE {{kind}} FUNCTION {{name}}(first_day DATE, last_day DATE)
RETURNS TABLE ({_COLUMNS.replace('period STRING, ', '')})
RETURN
SELECT date_format(start, 'yyyy-MM'), orders, customers, revenue, profit, margin, order_value
FROM ({_MEASURES.replace('{first}', 'first_day').replace('{last}', 'last_day')})
"""

FUNCTIONS = {"monthly_kpi_report": MONTHLY_KPI_REPORT, "kpi_by_month": KPI_BY_MONTH}


def register_functions(spark: SparkSession, orders: DataFrame, view: str = "sales_order_lines") -> list[str]:
    """Temporary functions over ``orders``, which becomes a temporary view."""
    orders.createOrReplaceTempView(view)
    for name, statement in FUNCTIONS.items():
        spark.sql(statement.format(kind="TEMPORARY", name=name, orders=view))
    return list(FUNCTIONS)


def create_functions(spark: SparkSession, table: str) -> list[str]:
    """Functions of the catalog's current schema over a table of the catalog.

    They outlive the session.  Spark calls table functions without their schema's name.
    """
    for name, statement in FUNCTIONS.items():
        spark.sql(statement.format(kind="", name=name, orders=table))
    return list(FUNCTIONS)

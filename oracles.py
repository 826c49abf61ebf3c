"""DuckDB statements that answer each registered query independently.

They read the same parquet tables through their view names.  Percentages are
rounded the way the library documents: six decimals first, then half away from
zero.  Decimals leave as DOUBLE, dates as text, counts as BIGINT.
"""

from __future__ import annotations


def pct(part: str, whole: str, places: int = 2) -> str:
    return (
        f"round(CAST(CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)"
        f" AS DECIMAL(38,6)), {places})::DOUBLE"
    )


def rest(part: str, whole: str) -> str:
    return (
        f"round(100 - CAST(CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)"
        f" AS DECIMAL(38,6)), 2)::DOUBLE"
    )


def mean(value: str, places: int = 2) -> str:
    return f"round(CAST(avg({value}) AS DECIMAL(38,6)), {places})::DOUBLE"


def per(part: str, whole: str) -> str:
    return (
        f"round(CAST(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
        f" AS DECIMAL(38,6)), 2)::DOUBLE"
    )


def money(value: str) -> str:
    return f"sum({value})::DOUBLE"


# --------------------------------------------------------------------------
# The three business areas

SUBSCRIBERS = """
last_orders AS (
  SELECT o_custkey, max(o_orderdate)::DATE AS last_order FROM orders GROUP BY o_custkey
),
base_subscribers AS (
  SELECT c_custkey::VARCHAR AS customer_id,
    ((c_custkey * 7 + c_nationkey) % 73)::INTEGER AS tenure,
    ['Fiber optic', 'DSL', 'No'][(c_custkey % 3 + 1)::INTEGER] AS internet_service,
    CASE WHEN c_custkey % 3 = 2 THEN 'No internet service' WHEN c_custkey % 17 = 3 THEN NULL
      WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS online_security,
    CASE WHEN c_custkey % 3 = 2 THEN 'No internet service' WHEN c_custkey % 19 = 5 THEN NULL
      WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS tech_support,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'One year' WHEN 'MACHINERY' THEN 'Two year'
      ELSE 'Month-to-month' END AS contract,
    ['Electronic check', 'Mailed check', 'Bank transfer', 'Credit card']
      [(c_nationkey % 4 + 1)::INTEGER] AS payment_method,
    round((c_acctbal::DECIMAL(12,2) + 1000) * 0.01::DECIMAL(3,2), 2)::DECIMAL(8,2)
      AS monthly_charges,
    if(coalesce(last_order >= DATE '2001-01-31', false), 'No', 'Yes') AS churn
  FROM customer LEFT JOIN last_orders ON o_custkey = c_custkey
),
subscribers AS (
  SELECT *, (CASE WHEN tenure > 0 THEN monthly_charges * tenure END)::DECIMAL(10,2) AS total_charges,
    CASE WHEN tenure <= 12 THEN 1 WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 3 ELSE 4 END
      AS band,
    ['0–12 months', '13–24 months', '25–48 months', '48+ months'][band] AS cohort,
    churn = 'Yes' AS gone
  FROM base_subscribers
)
"""

SALES = """
buyers AS (
  SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
    r_name AS region, n_name AS state, n_name AS city
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
),
goods AS (
  SELECT p_partkey::VARCHAR AS product_id, p_type AS category, p_brand AS sub_category,
    p_name AS product_name, p_size
  FROM part
),
unpriced AS (
  SELECT l_orderkey AS order_id, o_orderdate::DATE AS order_date, l_shipdate::DATE AS ship_date,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'Same Day' WHEN '2' THEN 'First Class'
      WHEN '3' THEN 'Second Class' ELSE 'Standard Class' END AS ship_mode,
    o_custkey::VARCHAR AS customer_id, l_partkey::VARCHAR AS product_id, l_returnflag,
    l_extendedprice::DECIMAL(10,2) AS sales, l_quantity::INTEGER AS quantity,
    (l_discount * 4)::DECIMAL(5,2) AS discount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
),
sold AS (
  SELECT unpriced.*,
    round(sales * (0.05::DECIMAL(5,2) * (p_size % 6 + 1) - discount), 2) AS profit
  FROM unpriced LEFT JOIN goods USING (product_id)
)
"""

FUNNEL = """
t1 AS (
  SELECT user_id, min(ts) AS moment FROM events WHERE event_type = 'signup' GROUP BY user_id
),
t2 AS (
  SELECT t1.user_id, min(e.ts) AS moment FROM t1 JOIN events e ON e.user_id = t1.user_id
  WHERE e.event_type = 'view' AND e.ts > t1.moment AND e.ts <= t1.moment + INTERVAL 3 DAY
  GROUP BY t1.user_id
),
t3 AS (
  SELECT t2.user_id, min(e.ts) AS moment FROM t2 JOIN events e ON e.user_id = t2.user_id
  WHERE e.event_type = 'purchase' AND e.ts > t2.moment AND e.ts <= t2.moment + INTERVAL 2 DAY
  GROUP BY t2.user_id
),
t4 AS (
  SELECT t3.user_id, min(e.ts) AS moment FROM t3 JOIN events e ON e.user_id = t3.user_id
  WHERE e.event_type = 'purchase' AND e.ts > t3.moment AND e.ts <= t3.moment + INTERVAL 2 DAY
  GROUP BY t3.user_id
),
happened AS (
  SELECT user_id, 'signed_up' AS event_type, moment FROM t1
  UNION ALL SELECT user_id, 'completed_onboarding', moment FROM t2
  UNION ALL SELECT user_id, 'first_purchase', moment FROM t3
  UNION ALL SELECT user_id, 'second_purchase', moment FROM t4
),
stage_events AS (
  SELECT user_id, event_type, moment::DATE + ((user_id * 7) % 364)::INTEGER AS event_date
  FROM happened
),
members AS (
  SELECT c_custkey AS user_id,
    coalesce(moment::DATE, DATE '2024-01-01') + ((c_custkey * 7) % 364)::INTEGER AS signup_date,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'organic' WHEN 'BUILDING' THEN 'paid_search'
      WHEN 'FURNITURE' THEN 'referral' WHEN 'HOUSEHOLD' THEN 'email' ELSE 'social' END AS channel,
    if(c_custkey % 3 = 0, 'returning', 'new') AS segment,
    ['mobile', 'desktop', 'tablet'][(c_custkey % 3 + 1)::INTEGER] AS device,
    n_name AS city
  FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN t1 ON t1.user_id = c_custkey
),
reached AS (
  SELECT user_id,
    min(event_date) FILTER (event_type = 'signed_up') AS d1,
    min(event_date) FILTER (event_type = 'completed_onboarding') AS d2,
    min(event_date) FILTER (event_type = 'first_purchase') AS d3,
    min(event_date) FILTER (event_type = 'second_purchase') AS d4
  FROM stage_events GROUP BY user_id
),
journeys AS (SELECT members.*, d1, d2, d3, d4 FROM members LEFT JOIN reached USING (user_id))
"""


def over(area: str, body: str) -> str:
    return f"WITH {area.strip()}\n{body.strip()}"


# --------------------------------------------------------------------------
# Churn

GONE = "count(*) FILTER (gone)"


def churn_rates(keys: str, total: str = "total", extra: str = "", having: str = "") -> str:
    return over(
        SUBSCRIBERS,
        f"""SELECT {keys}, count(*) AS {total}, {GONE} AS churned,
  {pct(GONE, 'count(*)')} AS churn_rate_pct{extra}
FROM subscribers GROUP BY ALL {having}""",
    )


RETAINED = f", {rest(GONE, 'count(*)')} AS retention_rate_pct"

RISK = """CASE WHEN tenure <= 12 AND monthly_charges > 65 AND tech_support = 'No' THEN 'High Risk'
    WHEN tenure <= 24 AND monthly_charges > 50 THEN 'Medium Risk' ELSE 'Low Risk' END"""

# Any answer but Yes, none included, is not having it.
SUPPORT = "coalesce(tech_support = 'Yes', false)"
SECURITY = "coalesce(online_security = 'Yes', false)"

CHURN = {
    "churn_overall": over(
        SUBSCRIBERS,
        f"""SELECT churn, count(*) AS total_customers,
  {pct('count(*)', '(SELECT count(*) FROM subscribers)')} AS churn_pct
FROM subscribers GROUP BY churn""",
    ),
    "churn_profile": over(
        SUBSCRIBERS,
        f"""SELECT churn, count(*) AS customers,
  (sum(tenure) // count(tenure))::BIGINT AS avg_tenure_months,
  {mean('monthly_charges')} AS avg_monthly_charges, {mean('total_charges')} AS avg_total_charges
FROM subscribers GROUP BY churn""",
    ),
    "churn_by_contract": churn_rates("contract"),
    "churn_by_payment": churn_rates("payment_method"),
    "churn_by_internet": churn_rates("internet_service"),
    "risk_segment": churn_rates("tech_support, online_security"),
    "high_value_churned": over(
        SUBSCRIBERS,
        """SELECT customer_id, tenure, contract, monthly_charges::DOUBLE AS monthly_charges,
  total_charges::DOUBLE AS total_charges, payment_method
FROM subscribers, (SELECT avg(monthly_charges) AS typical FROM subscribers)
WHERE gone AND monthly_charges > typical""",
    ),
    "cohort_tenure": churn_rates(
        "'0' || band || '. ' || cohort AS cohort", "total_customers", RETAINED
    ),
    "contract_cohort": churn_rates("contract, cohort"),
    "running_churn": over(
        SUBSCRIBERS,
        f""", months AS (
  SELECT tenure, count(*) AS n, {GONE} AS g FROM subscribers GROUP BY tenure
), summed AS (
  SELECT a.tenure, any_value(a.n) AS n, any_value(a.g) AS g,
    sum(b.n)::BIGINT AS upto_n, sum(b.g)::BIGINT AS upto_g
  FROM months a JOIN months b ON b.tenure <= a.tenure GROUP BY a.tenure
)
SELECT tenure, n AS total_at_tenure, g AS churned_at_tenure, upto_g AS running_total_churned,
  upto_n AS running_total_users, {pct('upto_g', 'upto_n')} AS cumulative_churn_rate_pct
FROM summed""",
    ),
    "risk_ranking": over(
        SUBSCRIBERS,
        """SELECT customer_id, contract, tenure, monthly_charges::DOUBLE AS monthly_charges,
  internet_service,
  rank() OVER (PARTITION BY contract ORDER BY monthly_charges DESC, tenure)
    AS risk_rank_within_contract,
  rank() OVER (ORDER BY monthly_charges DESC, tenure) AS overall_risk_rank
FROM subscribers WHERE NOT gone""",
    ),
    "charges_percentile": over(
        SUBSCRIBERS,
        """SELECT customer_id, contract, monthly_charges::DOUBLE AS monthly_charges,
  round(CAST(percent_rank() OVER (PARTITION BY contract ORDER BY monthly_charges) * 100
    AS DECIMAL(38,6)), 1)::DOUBLE AS charges_percentile_in_contract, churn
FROM subscribers""",
    ),
    "churn_month_lag": over(
        SUBSCRIBERS,
        f""", months AS (
  SELECT tenure AS month, {GONE} AS churned, count(*) AS total,
    {pct(GONE, 'count(*)')} AS churn_rate
  FROM subscribers GROUP BY tenure
), lagged AS (
  SELECT *, lag(churn_rate) OVER (ORDER BY month) AS prev_month_churn_rate FROM months
)
SELECT *, round(CAST(churn_rate - prev_month_churn_rate AS DECIMAL(38,6)), 2)::DOUBLE
  AS churn_rate_change
FROM lagged""",
    ),
    "vw_churn_kpi_summary": over(
        SUBSCRIBERS,
        f"""SELECT count(*) AS total_customers, {GONE} AS total_churned,
  count(*) FILTER (NOT gone) AS total_retained,
  {pct(GONE, 'count(*)')} AS overall_churn_rate_pct,
  {mean('if(gone, monthly_charges, NULL)')} AS avg_charges_churned,
  {mean('if(gone, NULL, monthly_charges)')} AS avg_charges_retained,
  {mean('if(gone, tenure, NULL)', 1)} AS avg_tenure_churned,
  {mean('if(gone, NULL, tenure)', 1)} AS avg_tenure_retained
FROM subscribers""",
    ),
    "vw_churn_by_contract": churn_rates(
        "contract", "total_customers", f", {mean('monthly_charges')} AS avg_monthly_charges"
    ),
    "vw_cohort_retention": churn_rates("cohort, contract", "total_customers", RETAINED),
    "vw_churn_by_payment": churn_rates("payment_method"),
    "vw_active_customer_risk": over(
        SUBSCRIBERS,
        f"""SELECT customer_id, contract, tenure, monthly_charges::DOUBLE AS monthly_charges,
  internet_service, tech_support, online_security, {RISK} AS churn_risk_segment,
  rank() OVER (ORDER BY monthly_charges DESC, tenure) AS overall_risk_rank
FROM subscribers WHERE NOT gone""",
    ),
    "vw_churn_drivers": churn_rates(
        "internet_service, tech_support, online_security, contract", having="HAVING count(*) >= 10"
    ),
    "kpi_retention_rate": over(
        SUBSCRIBERS,
        f"""SELECT count(*) AS total_customers, count(*) FILTER (NOT gone) AS retained,
  {pct('count(*) FILTER (NOT gone)', 'count(*)')} AS retention_rate_pct FROM subscribers""",
    ),
    "kpi_highest_risk_segment": churn_rates("tech_support, online_security")
    + " ORDER BY churn_rate_pct DESC, tech_support NULLS FIRST, online_security NULLS FIRST LIMIT 1",
    "cohort_risk_badge": over(
        SUBSCRIBERS,
        f""", kept AS (
  SELECT '0' || band || '. ' || cohort AS cohort, count(*) AS total_customers{RETAINED}
  FROM subscribers GROUP BY ALL
)
SELECT *, CASE WHEN retention_rate_pct < 50 THEN 'High' WHEN retention_rate_pct < 90
  THEN 'Medium' ELSE 'Low' END AS risk FROM kept""",
    ),
    "churn_by_6m_tenure": over(
        SUBSCRIBERS,
        f""", steps AS (
  SELECT greatest((tenure + 5) // 6 * 6, 6)::INTEGER AS tenure_upto, count(*) AS customers,
    {GONE} AS churned FROM subscribers GROUP BY ALL
)
SELECT a.tenure_upto, a.customers, a.churned,
  {pct('a.churned', 'a.customers')} AS churn_rate_pct,
  {pct('(SELECT sum(churned) FROM steps b WHERE b.tenure_upto <= a.tenure_upto)',
       '(SELECT sum(customers) FROM steps b WHERE b.tenure_upto <= a.tenure_upto)')}
    AS cumulative_churn_rate_pct
FROM steps a""",
    ),
    "driver_matrix": over(
        SUBSCRIBERS,
        "SELECT internet_service, "
        + ", ".join(
            pct(
                f"count(*) FILTER (gone AND {a} AND {b})",
                f"count(*) FILTER ({a} AND {b})",
            )
            + f" AS {name}"
            for a, b, name in (
                (f"NOT {SUPPORT}", f"NOT {SECURITY}", "no_support_no_security"),
                (f"NOT {SUPPORT}", SECURITY, "no_support_security"),
                (SUPPORT, f"NOT {SECURITY}", "support_no_security"),
                (SUPPORT, SECURITY, "support_security"),
            )
        )
        + " FROM subscribers GROUP BY internet_service",
    ),
    "top_at_risk": over(
        SUBSCRIBERS,
        f"""SELECT customer_id, contract, tenure, monthly_charges::DOUBLE AS monthly_charges,
  internet_service, tech_support, online_security, {RISK} AS churn_risk_segment,
  rank() OVER (ORDER BY monthly_charges DESC, tenure) AS overall_risk_rank
FROM subscribers WHERE NOT gone
ORDER BY overall_risk_rank, customer_id LIMIT 6""",
    ),
    "load_subscribers": over(
        SUBSCRIBERS,
        """, keyed AS (SELECT *, customer_id::BIGINT AS k FROM subscribers)
SELECT customer_id, if(k % 2 = 0, 'Female', 'Male') AS gender, 0 AS senior_citizen,
  if(k % 5 < 2, 'Yes', 'No') AS partner, if(k % 7 < 2, 'Yes', 'No') AS dependents, tenure,
  if(k % 11 = 0, 'No', 'Yes') AS phone_service,
  if(k % 11 = 0, 'No phone "line", none', 'Yes') AS multiple_lines, internet_service,
  online_security, if(k % 4 = 0, 'Yes', 'No') AS online_backup,
  if(k % 6 = 0, 'Yes', 'No') AS device_protection, tech_support,
  if(k % 8 < 3, 'Yes', 'No') AS streaming_tv, if(k % 9 < 4, 'Yes', 'No') AS streaming_movies,
  contract, if(k % 10 < 6, 'Yes', 'No') AS paperless_billing,
  payment_method, monthly_charges::DOUBLE AS monthly_charges,
  total_charges::DOUBLE AS total_charges, churn FROM keyed""",
    ),
}
CHURN["load_subscribers_with_rejects"] = (
    CHURN["load_subscribers"] + " WHERE k % 50 NOT IN (7, 8, 9, 10)"
)
CHURN["rejected_lines"] = """
SELECT CASE c_custkey % 50 WHEN 7 THEN 'too many values' WHEN 8 THEN 'too few values'
    WHEN 9 THEN 'tenure: not int' WHEN 10 THEN 'tenure: not int; monthly_charges: not decimal(8,2)'
    ELSE 'loaded' END AS reason, count(*) AS lines
FROM customer GROUP BY ALL"""
CHURN["ranks_after_inserts"] = CHURN["risk_ranking"]
CHURN["publish_view"] = CHURN["vw_churn_by_contract"]
CHURN["replace_published_view"] = f"""
SELECT 1 AS version, * FROM ({CHURN["vw_churn_by_contract"]})
UNION ALL
SELECT 2 AS version, * FROM (
{CHURN["vw_churn_by_contract"].replace("FROM subscribers", "FROM subscribers WHERE tenure > 12")})"""
CHURN["preview_view"] = CHURN["vw_churn_kpi_summary"]


# --------------------------------------------------------------------------
# Sales

MARGIN = pct("sum(profit)", "sum(sales)")


def monthly(columns: str, picked: str, rolling: str) -> str:
    return over(
        SALES,
        f""", months AS (
  SELECT strftime(order_date, '%Y-%m') AS month_label, sum(sales) AS revenue,
    sum(profit) AS profit, {columns}
  FROM sold GROUP BY ALL
), lagged AS (
  SELECT *, lag(revenue) OVER w AS before,
    round(CAST(avg(revenue) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(38,6)), 2)
      ::DOUBLE AS {rolling}
  FROM months WINDOW w AS (ORDER BY month_label)
)
SELECT month_label, revenue::DOUBLE AS revenue, profit::DOUBLE AS profit, {picked},
  before::DOUBLE AS prev_month_revenue, {pct('revenue - before', 'before')} AS mom_growth_pct,
  {rolling}
FROM lagged""",
    )


PRODUCT_GROUP = f"""product_name, category, sub_category, {money('sales')} AS total_revenue,
  {money('profit')} AS total_profit, {MARGIN} AS profit_margin_pct"""


def discounts(labels: tuple[str, ...], columns: str) -> str:
    names = ", ".join(f"'{label}'" for label in labels)
    return over(
        SALES,
        f"""SELECT [{names}][CASE WHEN discount = 0 THEN 1 WHEN discount <= 0.10 THEN 2
    WHEN discount <= 0.20 THEN 3 WHEN discount <= 0.30 THEN 4 ELSE 5 END] AS discount_bucket,
  count(*) AS orders, {columns}
FROM sold GROUP BY ALL""",
    )


RFM = SALES.rstrip() + """,
spend AS (
  SELECT customer_id, (DATE '2001-08-01' - max(order_date))::INTEGER AS recency_days,
    count(DISTINCT order_id) AS frequency, sum(sales) AS monetary
  FROM unpriced GROUP BY customer_id
),
scored AS (
  SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id)::INTEGER AS r_score,
    ntile(5) OVER (ORDER BY frequency, customer_id)::INTEGER AS f_score,
    ntile(5) OVER (ORDER BY monetary, customer_id)::INTEGER AS m_score
  FROM spend
),
segmented AS (
  SELECT *, CASE
    WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champions'
    WHEN least(r_score, f_score) >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 THEN 'Recent Customers'
    WHEN r_score = 3 AND m_score >= 3 THEN 'Potential Loyalists'
    WHEN r_score = 3 THEN 'Need Attention'
    WHEN least(f_score, m_score) >= 3 THEN 'At Risk'
    WHEN f_score >= 4 THEN 'Cannot Lose Them'
    WHEN greatest(f_score, m_score) <= 2 THEN 'Lost'
    WHEN f_score <= 2 AND m_score >= 4 THEN 'Big Spenders'
    ELSE 'Need Attention' END AS customer_segment
  FROM scored
)
"""

RFM_SUMMARY = f"""customer_segment, count(*) AS customer_count, {mean('monetary')} AS avg_spend"""


def kpi_month(period: str, label: str, first: str, last: str) -> str:
    return f"""SELECT '{period}' AS period, '{label}' AS month,
  count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  {money('sales')} AS revenue, {money('profit')} AS profit, {MARGIN} AS profit_margin_pct,
  {per('sum(sales)', 'count(DISTINCT order_id)')} AS avg_order_value
FROM sold WHERE order_date BETWEEN DATE '{first}' AND DATE '{last}'"""


SALES_QUERIES = {
    "monthly_revenue": monthly(
        "count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers",
        "total_orders, unique_customers",
        "rolling_3m_avg_revenue",
    ),
    "vw_monthly_revenue_trend": monthly(
        "count(DISTINCT order_id) AS orders", "orders", "rolling_3m_avg"
    ),
    "quarterly_yoy": over(
        SALES,
        f""", quarters AS (
  SELECT year(order_date) AS yr, quarter(order_date) AS qtr, sum(sales) AS revenue,
    sum(profit) AS profit, {MARGIN} AS profit_margin_pct
  FROM sold GROUP BY ALL
), lagged AS (
  SELECT *, lag(revenue, 4) OVER (ORDER BY yr, qtr) AS before FROM quarters
)
SELECT 'Q' || qtr || '-' || yr AS quarter_label, revenue::DOUBLE AS revenue,
  profit::DOUBLE AS profit, profit_margin_pct, before::DOUBLE AS same_qtr_last_year,
  {pct('revenue - before', 'before')} AS yoy_growth_pct
FROM lagged""",
    ),
    "top_products": over(
        SALES,
        f"""SELECT {PRODUCT_GROUP}, sum(quantity)::BIGINT AS units_sold,
  count(DISTINCT order_id) AS order_count
FROM sold JOIN goods USING (product_id) GROUP BY ALL
ORDER BY total_revenue DESC, product_name, category, sub_category LIMIT 10""",
    ),
    "loss_products": over(
        SALES,
        f"""SELECT {PRODUCT_GROUP}, {mean('discount')} AS avg_discount
FROM sold JOIN goods USING (product_id) GROUP BY ALL HAVING sum(profit) < 0""",
    ),
    "category_contribution": over(
        SALES,
        f""", kinds AS (
  SELECT category, sub_category, sum(sales) AS revenue, sum(profit) AS profit
  FROM sold JOIN goods USING (product_id) GROUP BY ALL
)
SELECT category, sub_category, revenue::DOUBLE AS revenue, profit::DOUBLE AS profit,
  {pct('revenue', 'sum(revenue) OVER ()')} AS pct_of_total_revenue,
  {pct('revenue', 'sum(revenue) OVER (PARTITION BY category)')} AS pct_within_category,
  rank() OVER (PARTITION BY category ORDER BY revenue DESC)::INTEGER AS rank_in_category
FROM kinds""",
    ),
    "vw_category_performance": over(
        SALES,
        f"""SELECT category, sub_category, {money('sales')} AS revenue,
  {money('profit')} AS profit, {MARGIN} AS margin_pct, sum(quantity)::BIGINT AS units_sold,
  {pct('sum(sales)', '(SELECT sum(sales) FROM sold)')} AS pct_of_total
FROM sold JOIN goods USING (product_id) GROUP BY category, sub_category""",
    ),
    "category_rollup": over(
        SALES,
        f"""SELECT 'category' AS level, category, NULL::VARCHAR AS sub_category,
  {money('sales')} AS revenue FROM sold JOIN goods USING (product_id) GROUP BY category
UNION ALL
SELECT 'sub_category', category, sub_category, {money('sales')}
FROM sold JOIN goods USING (product_id) GROUP BY category, sub_category""",
    ),
    "regional_performance": over(
        SALES,
        f"""SELECT region, state, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers, {money('sales')} AS revenue,
  {money('profit')} AS profit, {MARGIN} AS profit_margin_pct, {mean('discount', 3)} AS avg_discount,
  {per('sum(sales)', 'count(DISTINCT order_id)')} AS avg_order_value
FROM sold JOIN buyers USING (customer_id) GROUP BY region, state""",
    ),
    "vw_regional_kpi": over(
        SALES,
        f"""SELECT region, state, count(DISTINCT order_id) AS orders,
  count(DISTINCT customer_id) AS customers, {money('sales')} AS revenue,
  {money('profit')} AS profit, {MARGIN} AS margin_pct
FROM sold JOIN buyers USING (customer_id) GROUP BY region, state""",
    ),
    "shipping_performance": over(
        SALES,
        f""", timed AS (
  SELECT ship_mode, ship_date - order_date AS days,
    CASE ship_mode WHEN 'First Class' THEN 2 WHEN 'Second Class' THEN 5
      WHEN 'Standard Class' THEN 7 ELSE 1 END AS allowed
  FROM unpriced
)
SELECT ship_mode, count(*) AS total_orders, count(*) FILTER (days > allowed) AS late_deliveries,
  {pct('count(*) FILTER (days > allowed)', 'count(*)')} AS late_delivery_rate_pct,
  {mean('days', 1)} AS avg_ship_days
FROM timed GROUP BY ship_mode""",
    ),
    "discount_impact": discounts(
        ("0% — No Discount", "1–10%", "11–20%", "21–30%", "30%+ Heavy Discount"),
        f"{money('sales')} AS total_revenue, {money('profit')} AS total_profit, "
        f"{mean('profit')} AS avg_profit_per_order, {MARGIN} AS profit_margin_pct",
    ),
    "vw_discount_impact": discounts(
        ("0% No Discount", "1–10%", "11–20%", "21–30%", "30%+ Heavy"),
        f"{money('sales')} AS revenue, {money('profit')} AS profit, {MARGIN} AS margin_pct",
    ),
    "rfm_base": over(
        RFM, "SELECT customer_id, recency_days, frequency, monetary::DOUBLE AS monetary FROM spend"
    ),
    "vw_rfm_segments": over(
        RFM,
        """SELECT customer_id, recency_days, frequency, monetary::DOUBLE AS monetary,
  r_score, f_score, m_score, customer_segment FROM segmented""",
    ),
    "rfm_customers": over(
        RFM,
        """SELECT customer_id, customer_name, segment, region, recency_days, frequency,
  monetary::DOUBLE AS monetary, r_score, f_score, m_score,
  r_score + f_score + m_score AS total_rfm_score, format('{}{}{}', r_score, f_score, m_score)
    AS rfm_cell, customer_segment
FROM segmented JOIN buyers USING (customer_id)""",
    ),
    "rfm_segment_summary": over(
        RFM,
        f"""SELECT {RFM_SUMMARY}, (sum(recency_days) // count(recency_days))::BIGINT
    AS avg_recency_days, {mean('frequency', 1)} AS avg_orders, {money('monetary')} AS total_revenue
FROM segmented GROUP BY customer_segment""",
    ),
    "rfm_segment_share": over(
        RFM,
        f"""SELECT {RFM_SUMMARY},
  {pct('count(*)', '(SELECT count(*) FROM segmented)')} AS pct_of_customers,
  {pct('sum(monetary)', '(SELECT sum(monetary) FROM segmented)')} AS revenue_pct
FROM segmented GROUP BY customer_segment""",
    ),
    "monthly_kpi_report": over(
        SALES,
        kpi_month("Current Month", "Nov 2000", "2000-11-01", "2000-11-30")
        + "\nUNION ALL\n"
        + kpi_month("Previous Month", "Oct 2000", "2000-10-01", "2000-10-31"),
    ),
    "sales_kpi_summary": over(
        SALES,
        f"""SELECT {money('sales')} AS total_revenue, {money('profit')} AS total_profit,
  {MARGIN} AS profit_margin_pct, count(*) AS order_lines, count(DISTINCT order_id) AS orders,
  {per('sum(sales)', 'count(*)')} AS avg_line_value,
  {per('sum(sales)', 'count(DISTINCT order_id)')} AS avg_order_value
FROM sold""",
    ),
    "split_star_schema": over(
        SALES,
        """SELECT 'customers' AS table_name, count(DISTINCT customer_id) AS row_count,
  0::BIGINT AS conflicting_keys FROM unpriced
UNION ALL SELECT 'products', count(DISTINCT product_id), 0 FROM unpriced
UNION ALL SELECT 'orders', count(*), NULL FROM unpriced
UNION ALL SELECT 'returns', count(DISTINCT order_id), NULL FROM unpriced
  WHERE l_returnflag = 'R'""",
    ),
    "split_star_customers": over(
        SALES, "SELECT * FROM buyers SEMI JOIN unpriced USING (customer_id)"
    ),
    "split_star_products": over(
        SALES,
        "SELECT product_id, category, sub_category, product_name FROM goods "
        "SEMI JOIN unpriced USING (product_id)",
    ),
    "split_star_orders": over(
        SALES,
        """SELECT order_id::VARCHAR AS order_id, order_date::VARCHAR AS order_date,
  ship_date::VARCHAR AS ship_date, ship_mode, customer_id, product_id, sales::DOUBLE AS sales,
  quantity, discount::DOUBLE AS discount, profit::DOUBLE AS profit FROM sold""",
    ),
    "load_sales_flat": over(
        SALES,
        """SELECT order_id::VARCHAR AS order_id, order_date::VARCHAR AS order_date,
  ship_date::VARCHAR AS ship_date, ship_mode, customer_id, product_id, sales::DOUBLE AS sales,
  quantity, discount::DOUBLE AS discount, profit::DOUBLE AS profit, customer_name, segment,
  region, state, city, category, sub_category, product_name,
  CASE WHEN l_returnflag = 'R' THEN 'Yes' END AS returned
FROM sold JOIN buyers USING (customer_id) JOIN goods USING (product_id)""",
    ),
    "split_star_returns": over(
        SALES,
        "SELECT DISTINCT order_id::VARCHAR AS order_id, 'Yes' AS returned FROM unpriced WHERE l_returnflag = 'R'",
    ),
}


# --------------------------------------------------------------------------
# Funnel

STAGE = """CASE WHEN d1 IS NOT NULL AND d2 IS NULL THEN 'Dropped at Onboarding'
    WHEN d2 IS NOT NULL AND d3 IS NULL THEN 'Dropped after Onboarding'
    WHEN d3 IS NOT NULL AND d4 IS NULL THEN 'One-time Buyers'
    WHEN d4 IS NOT NULL THEN 'Repeat Buyers' ELSE 'Unknown' END"""

STEPS = FUNNEL.rstrip() + """,
steps AS (
  SELECT step_order, funnel_step, count(DISTINCT user_id) AS users
  FROM (VALUES (1, 'Signed Up', 'signed_up'), (2, 'Completed Onboarding', 'completed_onboarding'),
    (3, 'First Purchase', 'first_purchase'), (4, 'Second Purchase', 'second_purchase'))
    AS s(step_order, funnel_step, event_type) LEFT JOIN stage_events USING (event_type)
  GROUP BY ALL
)
"""

DROPS = f"""SELECT a.step_order, a.funnel_step, a.users,
  {pct('a.users', '(SELECT users FROM steps WHERE step_order = 1)')} AS pct_of_signups,
  b.users - a.users AS users_lost, {rest('a.users', 'b.users')} AS drop_pct
FROM steps a LEFT JOIN steps b ON b.step_order = a.step_order - 1"""


def funnel_by(key: str, columns: str) -> str:
    return over(
        FUNNEL,
        f""", totals AS (
  SELECT {key}, count(*) AS signups, count(d2) AS onboarded, count(d3) AS purchased,
    count(d4) AS repeat_buyers FROM journeys GROUP BY {key}
)
SELECT {columns} FROM totals""",
    )


def rows(kind: str) -> str:
    return f"count(*) FILTER (event_type = '{kind}')"


def within(days: int) -> str:
    return f"count(*) FILTER (d3 - signup_date <= {days})"


# US week: days since the Sunday on or before 1 January, in sevens.
WEEK = """((date_diff('day', date_trunc('year', signup_date)::DATE, signup_date)
    + dayofweek(date_trunc('year', signup_date))) // 7 + 1)::INTEGER"""

MATRIX = f"""SELECT year(signup_date)::INTEGER AS yr, {WEEK} AS wk, count(*) AS cohort_size,
  {pct(within(30), 'count(*)')} AS retention_30d, {pct(within(60), 'count(*)')} AS retention_60d,
  {pct(within(90), 'count(*)')} AS retention_90d
FROM journeys GROUP BY ALL"""

FUNNEL_QUERIES = {
    "event_type_counts": over(
        FUNNEL, "SELECT event_type, count(*) AS cnt FROM stage_events GROUP BY event_type"
    ),
    "funnel_overall": over(
        FUNNEL,
        f"""SELECT {rows('signed_up')} AS step1_signups,
  {rows('completed_onboarding')} AS step2_onboarded,
  {rows('first_purchase')} AS step3_first_purchase,
  {rows('second_purchase')} AS step4_second_purchase,
  {pct(rows('completed_onboarding'), rows('signed_up'))} AS signup_to_onboard_pct,
  {pct(rows('first_purchase'), rows('completed_onboarding'))} AS onboard_to_purchase_pct,
  {pct(rows('second_purchase'), rows('first_purchase'))} AS first_to_second_purchase_pct,
  {pct(rows('second_purchase'), rows('signed_up'))} AS overall_conversion_pct
FROM stage_events""",
    ),
    "channel_funnel": funnel_by(
        "channel",
        f"""*, {pct('onboarded', 'signups')} AS onboard_rate_pct,
  {pct('purchased', 'onboarded')} AS purchase_rate_pct,
  {pct('repeat_buyers', 'purchased')} AS repeat_rate_pct,
  {pct('purchased', 'signups')} AS overall_conv_pct""",
    ),
    "device_funnel": funnel_by(
        "device",
        f"""device, signups, onboarded, purchased,
  {pct('onboarded', 'signups')} AS onboard_rate_pct,
  {pct('purchased', 'onboarded')} AS purchase_rate_pct,
  {pct('repeat_buyers', 'purchased')} AS repeat_rate_pct""",
    ),
    "vw_channel_conversion": funnel_by(
        "channel", f"*, {pct('purchased', 'signups')} AS conv_rate_pct"
    ),
    "time_to_convert": over(
        FUNNEL,
        f"""SELECT channel, device, count(*) AS converters,
  {mean('d2 - d1', 1)} AS avg_days_to_onboard, {mean('d3 - d1', 1)} AS avg_days_to_purchase,
  min(d3 - d1)::INTEGER AS fastest_days, max(d3 - d1)::INTEGER AS slowest_days
FROM journeys WHERE d3 IS NOT NULL GROUP BY channel, device""",
    ),
    "cohort_retention": over(
        FUNNEL,
        f"""SELECT year(signup_date)::INTEGER AS signup_year, {WEEK} AS signup_week,
  count(*) AS cohort_size, count(d3) AS ever_purchased, {within(30)} AS purchased_in_30d,
  {within(60)} AS purchased_in_60d, {within(90)} AS purchased_in_90d,
  {pct(within(30), 'count(*)')} AS retention_30d_pct,
  {pct(within(60), 'count(*)')} AS retention_60d_pct,
  {pct(within(90), 'count(*)')} AS retention_90d_pct
FROM journeys GROUP BY ALL""",
    ),
    "vw_cohort_matrix": over(FUNNEL, MATRIX),
    "cohort_matrix_first": over(FUNNEL, MATRIX + " ORDER BY yr, wk LIMIT 5"),
    "dropoff_users": over(
        FUNNEL,
        f"""SELECT {STAGE} AS drop_off_stage, channel, device, count(*) AS user_count,
  {pct('count(*)', '(SELECT count(*) FROM members)')} AS pct_of_all_users
FROM journeys GROUP BY ALL""",
    ),
    "vw_dropoff_by_stage": over(
        FUNNEL,
        f"SELECT {STAGE} AS stage, channel, device, count(*) AS users FROM journeys GROUP BY ALL",
    ),
    "journey_report": over(
        FUNNEL,
        f"""SELECT channel, count(*) AS total_users,
  count(coalesce(d2, d3, d4)) AS onboarded, count(coalesce(d3, d4)) AS purchased,
  count(d4) AS repeat_buyers, {mean('d2 - d1', 1)} AS avg_days_to_onboard,
  {mean('d3 - d1', 1)} AS avg_days_to_purchase, {mean('d4 - d3', 1)} AS avg_days_between_purchases,
  {pct('count(coalesce(d3, d4))', 'count(*)')} AS overall_conv_pct
FROM journeys WHERE d1 IS NOT NULL GROUP BY channel""",
    ),
    "vw_funnel_summary": over(STEPS, "SELECT * FROM steps"),
    "funnel_summary_ordered": over(STEPS, "SELECT * FROM steps ORDER BY step_order"),
    "funnel_step_drop": over(STEPS, DROPS),
    "biggest_dropoff": over(
        STEPS,
        f"""SELECT funnel_step, users_lost, drop_pct FROM ({DROPS}) WHERE drop_pct IS NOT NULL
ORDER BY drop_pct DESC, step_order LIMIT 1""",
    ),
    "dropoff_by_device": over(
        FUNNEL,
        """SELECT device, count(*) FILTER (d1 IS NOT NULL AND d2 IS NULL) AS dropped_at_onboarding,
  count(*) FILTER (d2 IS NOT NULL AND d3 IS NULL) AS dropped_after_onboarding,
  count(*) FILTER (d1 IS NOT NULL AND d2 IS NOT NULL AND d3 IS NOT NULL AND d4 IS NULL)
    AS one_time_buyers,
  count(*) FILTER (d1 IS NOT NULL AND d2 IS NOT NULL AND d3 IS NOT NULL AND d4 IS NOT NULL)
    AS repeat_buyers,
  count(*) FILTER (coalesce(d1, d2, d3, d4) IS NULL) AS unknown
FROM journeys GROUP BY device""",
    ),
    "cohort_heat_band": over(
        FUNNEL,
        f""", matrix AS ({MATRIX}), cells AS (
  SELECT yr, wk, 30 AS within_days, retention_30d AS retention_pct FROM matrix
  UNION ALL SELECT yr, wk, 60, retention_60d FROM matrix
  UNION ALL SELECT yr, wk, 90, retention_90d FROM matrix
)
SELECT *, CASE WHEN retention_pct >= 40 THEN '≥40' WHEN retention_pct >= 30 THEN '≥30'
  WHEN retention_pct >= 20 THEN '≥20' ELSE '<20' END AS band FROM cells""",
    ),
    "assign_event_id": over(
        FUNNEL,
        """SELECT row_number() OVER (ORDER BY event_date, user_id, event_type) AS event_id,
  user_id, event_type, event_date::VARCHAR AS event_date FROM stage_events""",
    ),
    "continue_event_ids": over(
        FUNNEL,
        """SELECT row_number() OVER (ORDER BY event_date >= DATE '2024-07-01', event_date, user_id, event_type)
    AS event_id, user_id, event_type, event_date::VARCHAR AS event_date FROM stage_events""",
    ),
}


# --------------------------------------------------------------------------
# Generated data and checks


def drawn(name: str, choices: int) -> str:
    return (
        f"(('0x' || left(md5('7:{name}:' || user_id), 8))::BIGINT % {choices})::INTEGER"
    )


GENERATED = f"""
ids AS (SELECT c_custkey AS user_id FROM customer),
made AS (
  SELECT user_id, DATE '2024-01-01' - {drawn('signup', 365)} AS signup_date,
    ['organic', 'paid_search', 'referral', 'email', 'social'][{drawn('channel', 5)} + 1] AS channel,
    if(user_id % 3 = 0, 'returning', 'new') AS segment,
    ['Mumbai', 'Delhi', 'Bangalore', 'Hyderabad', 'Chennai', 'Pune'][{drawn('city', 6)} + 1] AS city,
    ['mobile', 'desktop', 'tablet'][{drawn('device', 3)} + 1] AS device
  FROM ids
),
onboarding AS (
  SELECT user_id, signup_date + {drawn('completed_onboarding gap', 3)} + 1 AS day FROM made
  WHERE {drawn('completed_onboarding', 100)} < 72
),
buying AS (
  SELECT user_id, day + {drawn('first_purchase gap', 14)} + 1 AS day FROM onboarding
  WHERE {drawn('first_purchase', 100)} < 45
),
repeated AS (
  SELECT user_id, day + {drawn('second_purchase gap', 30)} + 1 AS day FROM buying
  WHERE {drawn('second_purchase', 100)} < 40
)
"""

PRIMARY_KEYS = (
    ("subscribers", "customer", "c_custkey"),
    ("sales.customers", "customer", "c_custkey"),
    ("sales.products", "part", "p_partkey"),
    ("funnel.users", "members", "user_id"),
    ("order lines", "lineitem", "l_orderkey, l_linenumber"),
)


def key_check(name: str, source: str, keys: str) -> str:
    missing = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"""SELECT '{name}' AS table_name, sum(n)::BIGINT AS checked_rows,
  coalesce(sum(n) FILTER ({missing}), 0)::BIGINT AS null_key_rows,
  count(*) FILTER (n > 1 AND NOT ({missing})) AS repeated_keys,
  coalesce(sum(n) FILTER (n > 1 AND NOT ({missing})), 0)::BIGINT AS repeated_rows
FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


def reference_check(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, count(DISTINCT {key}) AS orphan_keys,
  count(*) AS orphan_rows
FROM {child} WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})"""


def domain_check(table: str, source: str, column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  count(*) FILTER ({column} NOT IN ({listed})) AS outside_rows,
  count(*) FILTER ({column} IS NULL) AS null_rows FROM {source}"""


CHANNEL_LIST = ("organic", "paid_search", "referral", "email", "social")
STAGE_LIST = ("signed_up", "completed_onboarding", "first_purchase", "second_purchase")

LOADING = {
    "generate_users": over(
        GENERATED, "SELECT * REPLACE (signup_date::VARCHAR AS signup_date) FROM made"
    ),
    "generate_stage_events": over(
        GENERATED,
        """SELECT user_id, 'signed_up' AS event_type, signup_date::VARCHAR AS event_date FROM made
UNION ALL SELECT user_id, 'completed_onboarding', day::VARCHAR FROM onboarding
UNION ALL SELECT user_id, 'first_purchase', day::VARCHAR FROM buying
UNION ALL SELECT user_id, 'second_purchase', day::VARCHAR FROM repeated""",
    ),
    "check_primary_key": over(
        FUNNEL, "\nUNION ALL\n".join(key_check(*entry) for entry in PRIMARY_KEYS)
    ),
    "check_foreign_key": over(
        FUNNEL,
        "\nUNION ALL\n".join(
            (
                reference_check("orders.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
                reference_check("orders.product_id", "lineitem", "l_partkey", "part", "p_partkey"),
                reference_check("events.user_id", "events", "user_id", "members", "user_id"),
            )
        ),
    ),
    "check_domain": over(
        SUBSCRIBERS.rstrip() + ",\n" + FUNNEL.strip(),
        "\nUNION ALL\n".join(
            (
                domain_check("subscribers", "subscribers", "contract",
                             ("Month-to-month", "One year", "Two year")),
                domain_check("subscribers", "subscribers", "churn", ("Yes", "No")),
                domain_check("sales.customers", "(SELECT c_mktsegment AS segment FROM customer)",
                             "segment", ("Consumer", "Corporate", "Home Office")),
                domain_check("funnel.users", "members", "channel", CHANNEL_LIST),
                domain_check("funnel.users", "members", "segment", ("new", "returning")),
                domain_check("funnel.users", "members", "device", ("mobile", "desktop", "tablet")),
                domain_check("funnel.events", "stage_events", "event_type", STAGE_LIST),
            )
        ),
    ),
}



def view_counts(known: dict[str, str], names: tuple[str, ...]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS view_name, count(*) AS row_count FROM (\n{known[name]}\n)"
        for name in names
    )


LOADING["publish_churn_views"] = view_counts(
    CHURN,
    ("vw_churn_kpi_summary", "vw_churn_by_contract", "vw_cohort_retention", "vw_churn_by_payment",
     "vw_active_customer_risk", "vw_churn_drivers"),
)
LOADING["publish_sales_views"] = view_counts(
    SALES_QUERIES,
    ("vw_monthly_revenue_trend", "vw_category_performance", "vw_regional_kpi", "vw_rfm_segments",
     "vw_discount_impact"),
)
LOADING["publish_funnel_views"] = view_counts(
    FUNNEL_QUERIES,
    ("vw_funnel_summary", "vw_channel_conversion", "vw_cohort_matrix", "vw_dropoff_by_stage"),
)

LOADING["sql_monthly_kpi_report"] = SALES_QUERIES["monthly_kpi_report"]
LOADING["sql_kpi_by_month"] = over(
    SALES,
    f"""SELECT strftime(order_date, '%Y-%m') AS month, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers, {money('sales')} AS revenue, {money('profit')} AS profit,
  {MARGIN} AS profit_margin_pct, {per('sum(sales)', 'count(DISTINCT order_id)')} AS avg_order_value
FROM sold GROUP BY ALL""",
)
LOADING["monthly_revenue_from_sets"] = SALES_QUERIES["monthly_revenue"]
LOADING["regional_performance_from_sets"] = SALES_QUERIES["regional_performance"]
LOADING["quarterly_customers"] = over(
    SALES,
    f"""SELECT 'Q' || quarter(order_date) || '-' || year(order_date) AS quarter_label,
  {money('sales')} AS revenue, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers
FROM sold GROUP BY ALL""",
)
LOADING["merge_user_state"] = FUNNEL_QUERIES["journey_report"]

ORACLES = {**CHURN, **SALES_QUERIES, **FUNNEL_QUERIES, **LOADING}

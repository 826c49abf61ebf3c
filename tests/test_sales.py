import datetime as dt
from decimal import Decimal

from builders import as_dict, make_orders

from cohortry.operators import rfm, sales

PRODUCT_DDL = "product_id STRING, category STRING, sub_category STRING, product_name STRING"


def products(spark, rows):
    return spark.createDataFrame(rows, PRODUCT_DDL)


def test_growth_skips_missing_months(spark):
    orders = make_orders(
        spark,
        [
            {"order_date": "2020-01-05", "sales": 100},
            {"order_date": "2020-03-05", "sales": 150, "order_id": "O2"},
            {"order_date": "2020-03-06", "sales": 0, "order_id": "O2", "customer_id": "C2"},
        ],
    )
    january, march = sales.monthly_revenue(orders).orderBy("month_label").collect()
    assert january["prev_month_revenue"] is None and january["mom_growth_pct"] is None
    assert march["mom_growth_pct"] == Decimal("50.00")
    assert march["rolling_3m_avg_revenue"] == Decimal("125.00")
    assert (march["total_orders"], march["unique_customers"]) == (1, 2)


def test_growth_from_nothing_is_null(spark):
    orders = make_orders(
        spark, [{"order_date": "2020-01-05", "sales": 0}, {"order_date": "2020-02-05"}]
    )
    rows = sales.vw_monthly_revenue_trend(orders).orderBy("month_label").collect()
    assert rows[1]["mom_growth_pct"] is None


def test_year_on_year_counts_rows(spark):
    days = ["2019-01-01", "2019-04-01", "2019-07-01", "2019-10-01", "2020-04-01"]
    orders = make_orders(spark, [{"order_date": d, "sales": 100 + i} for i, d in enumerate(days)])
    found = as_dict(sales.quarterly_yoy(orders), "quarter_label", "same_qtr_last_year")
    assert found["Q2-2020"] == Decimal("100.00")
    assert found["Q4-2019"] is None


def test_shipping_limits(spark):
    def line(mode, days):
        shipped = None if days is None else str(dt.date(2020, 1, 5) + dt.timedelta(days))
        return {"ship_mode": mode, "ship_date": shipped}

    orders = make_orders(
        spark,
        [
            line("First Class", 2), line("First Class", 3), line("Second Class", 5),
            line("Second Class", 6), line("Standard Class", 7), line("Standard Class", 8),
            line("Same Day", 1), line("Same Day", 2), line(None, 2), line("Same Day", None),
        ],
    )
    rows = {r["ship_mode"]: r for r in sales.shipping_performance(orders).collect()}
    assert {m: r["late_deliveries"] for m, r in rows.items()} == {
        "First Class": 1, "Second Class": 1, "Standard Class": 1, "Same Day": 1, None: 1,
    }
    assert rows["Same Day"]["total_orders"] == 3
    assert rows["Same Day"]["late_delivery_rate_pct"] == Decimal("33.33")
    assert rows["Same Day"]["avg_ship_days"] == Decimal("1.5")


def test_products_with_one_name_are_one_product(spark):
    goods = products(
        spark, [("P1", "A", "x", "pen"), ("P2", "A", "x", "pen"), ("P3", "A", "y", "ink")]
    )
    orders = make_orders(
        spark,
        [
            {"product_id": "P1"}, {"product_id": "P2"},
            {"product_id": "P3", "profit": -5, "discount": "0.25", "sales": 10},
            {"product_id": "P3", "profit": 1, "discount": None, "sales": 10},
        ],
    )
    top = sales.top_products(orders, goods).collect()
    assert [r["product_name"] for r in top] == ["pen", "ink"]
    assert (top[0]["order_count"], top[0]["units_sold"]) == (1, 2)
    assert sales.top_products(orders, goods, 1).count() == 1
    loss = sales.loss_products(orders, goods).collect()
    assert [r["product_name"] for r in loss] == ["ink"]
    assert loss[0]["avg_discount"] == Decimal("0.25")
    levels = sales.category_rollup(orders, goods).collect()
    assert sorted((r["level"], r["sub_category"] or "", r["revenue"]) for r in levels) == [
        ("category", "", Decimal("220.00")),
        ("sub_category", "x", Decimal("200.00")),
        ("sub_category", "y", Decimal("20.00")),
    ]


def test_order_shared_by_two_customers_counts_once(spark):
    people = spark.createDataFrame(
        [("C1", "North", "S"), ("C2", "North", "S")], "customer_id STRING, region STRING, state STRING"
    )
    orders = make_orders(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}])
    row = sales.regional_performance(orders, people).first()
    assert (row["total_orders"], row["unique_customers"]) == (1, 2)
    assert row["avg_order_value"] == Decimal("200.00")


def test_kpi_report_always_has_two_rows(spark):
    orders = make_orders(
        spark, [{"order_date": "2020-01-31"}, {"order_date": "2020-02-29", "order_id": "O2"}]
    )
    rows = {r["period"]: r for r in sales.monthly_kpi_report(orders, 2020, 3).collect()}
    assert rows["Current Month"]["month"] == "Mar 2020"
    assert rows["Current Month"]["total_orders"] == 0
    assert rows["Current Month"]["revenue"] is None
    assert rows["Previous Month"]["total_orders"] == 1
    january = {r["period"]: r["month"] for r in sales.monthly_kpi_report(orders, 2020, 1).collect()}
    assert january == {"Current Month": "Jan 2020", "Previous Month": "Dec 2019"}


def test_kpis_of_nothing(spark):
    nothing = make_orders(spark, [{}]).where("false")
    row = sales.sales_kpi_summary(nothing).first()
    assert (row["order_lines"], row["orders"], row["total_revenue"]) == (0, 0, None)
    assert row["avg_order_value"] is None
    assert sales.monthly_revenue(nothing).count() == 0
    assert rfm.vw_rfm_segments(nothing).count() == 0


def test_rfm_base(spark):
    orders = make_orders(
        spark,
        [
            {"order_date": "2017-12-01"}, {"order_date": "2017-12-01"},
            {"order_date": "2017-12-30", "order_id": "O2"},
            {"order_date": "2017-12-30", "order_id": None, "customer_id": "C2"},
        ],
    )
    rows = {r["customer_id"]: tuple(r)[1:] for r in rfm.rfm_base(orders).collect()}
    assert rows == {"C1": (1, 2, Decimal("300.00")), "C2": (1, 0, Decimal("100.00"))}


def test_segments_cover_all_customers(spark, folder):
    from cohortry.sources import testbed

    orders = testbed.sales_orders(spark, folder, with_profit=False)
    scored = rfm.vw_rfm_segments(orders, testbed.AS_OF).cache()
    customers = scored.count()
    summary = rfm.summarise_segments(scored).collect()
    assert sum(r["customer_count"] for r in summary) == customers
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r["count"] for r in scored.groupBy(score).count().orderBy(score).collect()]
        assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)

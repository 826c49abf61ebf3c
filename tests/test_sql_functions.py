"""Reports with parameters, from Spark SQL."""

import pytest
from builders import make_orders

from cohortry.operators import sales
from cohortry.plans.sql_functions import create_functions, register_functions


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def orders(spark):
    return make_orders(
        spark,
        [{"order_id": "O1", "order_date": "2017-11-02", "sales": "10.50", "profit": "-1.25"},
         {"order_id": "O1", "order_date": "2017-11-02", "customer_id": "C2"},
         {"order_id": "O2", "order_date": "2017-11-30", "customer_id": "C1", "sales": "0.01", "profit": "0.01"},
         {"order_id": "O3", "order_date": "2017-09-30"}, {"order_id": "O4", "order_date": "2016-12-31"}],
    )


@pytest.mark.parametrize("year,month", [(2017, 11), (2017, 10), (2017, 12), (2017, 1), (1999, 5)])
def test_the_function_is_the_report(spark, orders, year, month):
    assert "monthly_kpi_report" in register_functions(spark, orders)
    found = spark.sql(f"SELECT * FROM monthly_kpi_report({year}, {month})")
    expected = sales.monthly_kpi_report(orders, year, month)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_the_function_joins_and_filters_like_a_table(spark, orders):
    register_functions(spark, orders)
    found = spark.sql("SELECT period, revenue FROM monthly_kpi_report(2017, 11) WHERE total_orders > 0")
    assert [tuple(r)[0] for r in found.collect()] == ["Current Month"]
    months = spark.sql("SELECT month, total_orders FROM kpi_by_month(DATE'2017-01-01', DATE'2017-12-31')")
    assert rows(months) == [("2017-09", 1), ("2017-11", 2)]


def test_the_dates_reach_the_scan(spark, orders, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    orders.write.parquet(str(tmp_path / "orders"))
    register_functions(spark, spark.read.parquet(str(tmp_path / "orders")))
    text = spark.sql("SELECT * FROM monthly_kpi_report(2017, 11)")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2017-10-01)" in text
    assert "LessThanOrEqual(order_date,2017-11-30)" in text


def test_functions_of_the_catalog(spark, orders):
    spark.sql("DROP TABLE IF EXISTS kept_orders")
    orders.write.saveAsTable("kept_orders")
    owner, names = spark.newSession(), []
    try:
        names = create_functions(owner, "kept_orders")
        other = spark.newSession()
        assert sorted(map(str, other.sql(f"SELECT * FROM {names[0]}(2017, 11)").collect())) == sorted(
            map(str, sales.monthly_kpi_report(orders, 2017, 11).collect())
        )
    finally:
        for name in names:
            owner.sql(f"DROP FUNCTION IF EXISTS {name}")
        spark.sql("DROP TABLE IF EXISTS kept_orders")

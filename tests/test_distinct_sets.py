"""Exact distinct counts from bitmaps that merge."""

import datetime as dt
import random

import pytest
from builders import make_orders
from pyspark.sql import functions as F

from cohortry.operators import sales
from cohortry.plans.distinct_sets import KeyNumbers, SalesSets, build_sets, count_sets, merge_sets


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sets_count_like_distinct(spark):
    """A third of the rows share a key, some have none, and ids reach over buckets."""
    frame = spark.range(30_000).selectExpr(
        "id % 4 AS g", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id * 7919 % 90000 + 1 END AS a",
        "id % 500 + 1 AS b",
    )
    sets = build_sets(frame, ["g"], {"a": "a", "b": "b"})
    found = count_sets(sets, ["g"], ["a", "b"])
    expected = frame.groupBy("g").agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"))
    assert rows(found) == rows(expected) and "Expand" not in plan(found)
    coarse = merge_sets(sets, {"half": F.col("g") % 2})
    expected = frame.groupBy((F.col("g") % 2).alias("half")).agg(
        F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")
    )
    assert rows(count_sets(coarse, ["half"], ["a", "b"])) == rows(expected)


def test_numbers_of_keys_continue(spark, tmp_path):
    keys = KeyNumbers(spark, str(tmp_path))
    batches = [["b", "a", None, "a"], ["c", "a"], [], ["d"], ["c", "a"]]
    for n, batch in enumerate(batches):
        keys.extend(spark.createDataFrame([(k,) for k in batch], "k STRING"), f"batch {min(n, 3)}" if n < 4 else "batch 1")
    assert rows(keys.frame()) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    lines = [
        {"order_id": f"O{rng.randrange(120)}", "order_date": str(dt.date(2017, 1, 1) + dt.timedelta(rng.randrange(400))),
         "customer_id": rng.choice(["C1", "C1", f"C{rng.randrange(30)}"]), "sales": rng.randrange(1, 900),
         "profit": rng.randrange(-50, 50), "discount": rng.choice([None, "0.1", "0.25"])}
        for _ in range(700)
    ]
    people = [(f"C{k}", f"R{k % 2}", f"S{k % 5}") for k in range(28)]
    return make_orders(spark, lines), spark.createDataFrame(people, "customer_id STRING, region STRING, state STRING")


def test_reports_from_sets_equal_the_reports(spark, tmp_path, tables):
    orders, customers = tables
    sets = SalesSets(spark, str(tmp_path))
    with pytest.raises(LookupError):
        sets.by({"month": F.col("month")})
    # Deliveries cut through months, orders and customers, and one comes again.
    parts = [orders.where("day(order_date) < 9"), orders.where("day(order_date) BETWEEN 9 AND 20"), orders.where("day(order_date) > 20")]
    for n in (2, 0, 1, 0):
        sets.append(parts[n], customers, f"part {n}")
    months = sales.monthly_revenue_from_sets(sets)
    assert months.columns == sales.monthly_revenue(orders).columns
    assert rows(months) == rows(sales.monthly_revenue(orders))
    assert "Expand" not in plan(months) and "order_id" not in plan(months)
    states = sales.regional_performance_from_sets(sets)
    expected = sales.regional_performance(orders, customers)
    assert states.columns == expected.columns
    assert rows(states.select([F.col(c).cast("string") for c in states.columns])) == rows(
        expected.select([F.col(c).cast("string") for c in expected.columns])
    )
    quarters = orders.groupBy(F.concat_ws("-", F.concat(F.lit("Q"), F.quarter("order_date")), F.year("order_date"))).agg(
        F.sum("sales"), F.count_distinct("order_id"), F.count_distinct("customer_id")
    )
    assert [tuple(map(str, r)) for r in rows(sales.quarterly_customers(sets))] == [tuple(map(str, r)) for r in rows(quarters)]


def test_a_delivery_that_fails_leaves_nothing(spark, tmp_path, tables):
    orders, customers = tables
    sets = SalesSets(spark, str(tmp_path))
    sets.append(orders.where("month(order_date) = 1"), customers, "january")
    before = rows(sets.by({"month": F.col("month")}))
    broken = orders.withColumn("sales", F.when(F.col("quantity") == 1, F.raise_error("lost")).cast("decimal(10,2)"))
    with pytest.raises(Exception, match="lost"):
        sets.append(broken, customers, "the rest")
    assert rows(sets.by({"month": F.col("month")})) == before

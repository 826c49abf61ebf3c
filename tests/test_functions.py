from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import percent, percent_left, quotient, whole_average
from cohortry.functions.buckets import (
    DISCOUNT_DASHBOARD_LABELS,
    DISCOUNT_REPORT_LABELS,
    churn_risk,
    discount_band,
    rfm_segment,
    tenure_cohort,
)
from cohortry.functions.dates import days_between, us_week


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "part,whole,expected",
    [(201, 20000, "1.01"), (1, 800, "0.13"), (-1, 800, "-0.13"), (1, 3, "33.33"), (0, 5, "0.00")],
)
def test_percent_rounds_half_away_from_zero(spark, part, whole, expected):
    assert one(spark, percent(F.lit(part), F.lit(whole))) == Decimal(expected)


def test_percent_of_zero_or_null_is_null(spark):
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(None).cast("bigint"))) is None
    assert one(spark, quotient(F.lit(1), F.lit(0))) is None


def test_rest_is_taken_from_the_unrounded_percentage(spark):
    assert one(spark, percent_left(F.lit(1), F.lit(800))) == Decimal("99.88")


def test_whole_average_truncates(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "x INT")
    assert frame.agg(whole_average(F.col("x")).alias("a")).first()["a"] == 1
    assert frame.where("x > 9").agg(whole_average(F.col("x")).alias("a")).first()["a"] is None


@pytest.mark.parametrize(
    "day,week",
    [
        ("2022-01-01", 1), ("2022-01-02", 2), ("2023-01-01", 1), ("2023-01-07", 1),
        ("2023-01-08", 2), ("2024-01-06", 1), ("2024-01-07", 2), ("2024-12-31", 53),
    ],
)
def test_us_week(spark, day, week):
    assert one(spark, us_week(F.lit(day))) == week


def test_days_count_date_boundaries(spark):
    start = F.lit("2024-01-01 23:59:00").cast("timestamp_ntz")
    end = F.lit("2024-01-02 00:01:00").cast("timestamp_ntz")
    assert one(spark, days_between(start, end)) == 1


@pytest.mark.parametrize(
    "tenure,label",
    [
        (None, "48+ months"), (-1, "48+ months"), (0, "0–12 months"), (12, "0–12 months"),
        (13, "13–24 months"), (24, "13–24 months"), (25, "25–48 months"), (48, "25–48 months"),
        (49, "48+ months"),
    ],
)
def test_tenure_cohort(spark, tenure, label):
    assert one(spark, tenure_cohort(F.lit(tenure).cast("int"))) == label
    numbered = one(spark, tenure_cohort(F.lit(tenure).cast("int"), numbered=True))
    assert numbered[4:] == label and numbered[:2] in ("01", "02", "03", "04")


@pytest.mark.parametrize("labels", [DISCOUNT_REPORT_LABELS, DISCOUNT_DASHBOARD_LABELS])
@pytest.mark.parametrize(
    "discount,band",
    [
        (None, 4), ("-0.05", 1), ("0", 0), ("0.01", 1), ("0.10", 1), ("0.11", 2), ("0.20", 2),
        ("0.21", 3), ("0.30", 3), ("0.31", 4),
    ],
)
def test_discount_band(spark, discount, band, labels):
    value = F.lit(discount).cast("decimal(5,2)")
    assert one(spark, discount_band(value, labels)) == labels[band]


@pytest.mark.parametrize(
    "tenure,charges,support,label",
    [
        (12, "65.00", "No", "Medium Risk"), (12, "65.01", "No", "High Risk"),
        (12, "65.01", "Yes", "Medium Risk"), (24, "50.00", "No", "Low Risk"),
        (24, "50.01", "No", "Medium Risk"), (25, "90.00", "No", "Low Risk"),
    ],
)
def test_churn_risk(spark, tenure, charges, support, label):
    risk = churn_risk(F.lit(tenure), F.lit(charges).cast("decimal(8,2)"), F.lit(support))
    assert one(spark, risk) == label


def test_rfm_segment_of_all_125_cells(spark):
    scores = spark.range(1, 6)
    cells = (
        scores.withColumnRenamed("id", "r")
        .join(scores.withColumnRenamed("id", "f"))
        .join(scores.withColumnRenamed("id", "m"))
        .select(rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    )
    assert {r["s"]: r["count"] for r in cells.groupBy("s").count().collect()} == {
        "Champions": 8, "Loyal Customers": 37, "Recent Customers": 20, "Potential Loyalists": 6,
        "At Risk": 18, "Cannot Lose Them": 8, "Lost": 8, "Big Spenders": 8, "Need Attention": 12,
    }


def test_rates_of_values_below_a_cent(spark):
    row = spark.createDataFrame([("0.004", "0.008")], "a STRING, b STRING").select(
        percent(F.col("a").cast("decimal(10,4)"), F.col("b").cast("decimal(10,4)")).alias("p")
    ).first()
    assert row["p"] == 50

from decimal import Decimal

from builders import as_dict, make_subscribers

from cohortry.operators import churn, dashboard


def test_profile_truncates_average_tenure(spark):
    people = make_subscribers(spark, [{"tenure": 1}, {"tenure": 2}])
    row = churn.churn_profile(people).first()
    assert row["avg_tenure_months"] == 1
    assert row["avg_total_charges"] is None


def test_summary_of_nobody(spark):
    nobody = make_subscribers(spark, [{}]).where("false")
    row = churn.vw_churn_kpi_summary(nobody).first()
    assert row["total_customers"] == 0
    assert row["total_churned"] is None and row["overall_churn_rate_pct"] is None
    for grouped in (churn.churn_overall, churn.churn_by_contract, churn.running_churn,
                    churn.risk_ranking, churn.charges_percentile, churn.vw_churn_drivers):
        assert grouped(nobody).count() == 0


def test_shares_and_rates(spark):
    people = make_subscribers(
        spark, [{"churn": "Yes"}, {"churn": "No"}, {"churn": "No"}, {"churn": None}]
    )
    assert as_dict(churn.churn_overall(people), "churn", "churn_pct") == {
        "Yes": Decimal("25.00"), "No": Decimal("50.00"), None: Decimal("25.00"),
    }
    row = churn.churn_by_contract(people).first()
    assert (row["total"], row["churned"], row["churn_rate_pct"]) == (4, 1, Decimal("25.00"))


def test_high_value_uses_the_average_of_everyone(spark):
    people = make_subscribers(
        spark,
        [
            {"churn": "Yes", "monthly_charges": 60}, {"churn": "Yes", "monthly_charges": 90},
            {"churn": "No", "monthly_charges": 100}, {"churn": "No", "monthly_charges": 20},
        ],
    )
    assert [r["customer_id"] for r in churn.high_value_churned(people).collect()] == ["C001"]


def test_rank_ties(spark):
    people = make_subscribers(
        spark,
        [
            {"monthly_charges": 90, "tenure": 5}, {"monthly_charges": 90, "tenure": 5},
            {"monthly_charges": 80, "tenure": 1}, {"monthly_charges": 99, "churn": "Yes"},
        ],
    )
    assert as_dict(churn.risk_ranking(people), "customer_id", "overall_risk_rank") == {
        "C000": 1, "C001": 1, "C002": 3,
    }
    assert as_dict(churn.top_at_risk(people, 2), "customer_id", "overall_risk_rank") == {
        "C000": 1, "C001": 1,
    }


def test_percentile_of_a_lone_customer_is_zero(spark):
    people = make_subscribers(spark, [{"contract": "Two year"}, {}, {"monthly_charges": 70}])
    found = as_dict(churn.charges_percentile(people), "customer_id", "charges_percentile_in_contract")
    assert found == {"C000": Decimal("0.0"), "C001": Decimal("0.0"), "C002": Decimal("100.0")}


def test_lag_skips_missing_months(spark):
    people = make_subscribers(
        spark, [{"tenure": 1, "churn": "Yes"}, {"tenure": 4}, {"tenure": 4, "churn": "Yes"}]
    )
    rows = churn.churn_month_lag(people).orderBy("month").collect()
    assert [r["prev_month_churn_rate"] for r in rows] == [None, Decimal("100.00")]
    assert rows[1]["churn_rate_change"] == Decimal("-50.00")


def test_drivers_need_ten_customers(spark):
    people = make_subscribers(spark, [{}] * 10 + [{"contract": "Two year"}] * 9)
    assert [r["contract"] for r in churn.vw_churn_drivers(people).collect()] == ["One year"]


def test_cumulative_rate_ends_at_the_overall_rate(spark, folder):
    from cohortry.sources import testbed

    people = testbed.subscribers(spark, folder).select("tenure", "churn", "monthly_charges").cache()
    overall = churn.vw_churn_kpi_summary(people).first()
    last = churn.running_churn(people).orderBy("tenure").collect()[-1]
    assert last["cumulative_churn_rate_pct"] == overall["overall_churn_rate_pct"]
    assert overall["total_churned"] + overall["total_retained"] == overall["total_customers"]
    steps = dashboard.churn_by_6m_tenure(people).orderBy("tenure_upto").collect()
    assert steps[-1]["cumulative_churn_rate_pct"] == overall["overall_churn_rate_pct"]


def test_driver_matrix_has_all_four_mixes(spark):
    people = make_subscribers(spark, [{"churn": "Yes"}, {}])
    row = dashboard.driver_matrix(people).first()
    assert row["no_support_no_security"] == Decimal("50.00")
    assert row["support_security"] is None


def test_badges(spark):
    people = make_subscribers(
        spark,
        [{"tenure": 1, "churn": "Yes"}, {"tenure": 13, "churn": "Yes"}, {"tenure": 13}, {"tenure": 50}],
    )
    assert sorted(as_dict(dashboard.cohort_risk_badge(people), "cohort", "risk").items()) == [
        ("01. 0–12 months", "High"), ("02. 13–24 months", "Medium"), ("04. 48+ months", "Low"),
    ]


def test_six_month_steps(spark):
    people = make_subscribers(spark, [{"tenure": t} for t in (None, -1, 0, 6, 7, 12, 13)])
    assert as_dict(dashboard.churn_by_6m_tenure(people), "tenure_upto", "customers") == {
        None: 1, 6: 3, 12: 2, 18: 1,
    }

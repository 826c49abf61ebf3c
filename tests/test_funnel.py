from decimal import Decimal

import pytest
from builders import as_dict, make_events, make_users

from cohortry.operators import dashboard, funnel

UP, ON, FIRST, SECOND = funnel.STAGES


@pytest.fixture(scope="module")
def users(spark):
    return make_users(spark, [(i, "2023-01-01", "email", "mobile") for i in range(1, 8)])


@pytest.fixture(scope="module")
def events(spark):
    return make_events(
        spark,
        [
            (1, UP, "2023-01-01"),
            (2, UP, "2023-01-01"), (2, ON, "2023-01-02"),
            (3, UP, "2023-01-01"), (3, ON, "2023-01-02"), (3, FIRST, "2023-01-10"),
            (4, UP, "2023-01-01"), (4, ON, "2023-01-02"), (4, FIRST, "2023-01-10"),
            (4, SECOND, "2023-02-01"),
            (6, UP, "2023-01-01"), (6, FIRST, "2023-01-05"),
            (7, UP, "2023-01-01"), (7, ON, "2023-01-03"), (7, FIRST, "2023-01-09"),
            (7, FIRST, "2023-01-08"),
        ],
    )


def test_drop_off_stages(users, events):
    assert as_dict(funnel.dropoff_users(users, events), "drop_off_stage", "user_count") == {
        "Dropped at Onboarding": 2, "Dropped after Onboarding": 1, "One-time Buyers": 2,
        "Repeat Buyers": 1, "Unknown": 1,
    }


def test_several_events_of_a_type_do_not_multiply_a_journey(users, events):
    row = funnel.journey_report(users, events).first()
    assert row["total_users"] == 6
    assert row["onboarded"] == 5  # the buyer who skipped onboarding counts here
    assert (row["purchased"], row["repeat_buyers"]) == (4, 1)
    assert row["avg_days_between_purchases"] == Decimal("22.0")


def test_rows_and_users_are_counted_apart(users, events):
    assert funnel.funnel_overall(events).first()["step3_first_purchase"] == 5
    steps = as_dict(funnel.vw_funnel_summary(events), "funnel_step", "users")
    assert steps == {
        "Signed Up": 6, "Completed Onboarding": 4, "First Purchase": 4, "Second Purchase": 1,
    }


def test_users_without_events_count_as_signed_up(users, events):
    row = funnel.channel_funnel(users, events).first()
    assert (row["signups"], row["onboarded"], row["purchased"]) == (7, 4, 4)
    assert row["purchase_rate_pct"] == Decimal("100.00")


def test_time_to_convert_takes_the_earliest_purchase(users, events):
    row = funnel.time_to_convert(users, events).first()
    assert (row["converters"], row["fastest_days"], row["slowest_days"]) == (4, 4, 9)
    assert row["avg_days_to_onboard"] == Decimal("1.3")


def test_retention_windows_are_cumulative(spark):
    gaps = {1: "2023-01-31", 2: "2023-02-01", 3: "2023-03-02", 4: "2023-03-03", 5: "2023-04-01",
            6: "2023-04-02", 8: "2022-12-25"}
    users = make_users(spark, [(i, "2023-01-01", "email", "mobile") for i in range(1, 9)])
    events = make_events(spark, [(u, FIRST, d) for u, d in gaps.items()])
    row = funnel.cohort_retention(users, events).first()
    assert (row["signup_year"], row["signup_week"], row["cohort_size"]) == (2023, 1, 8)
    assert row["ever_purchased"] == 7
    assert [row[f"purchased_in_{n}d"] for n in (30, 60, 90)] == [2, 4, 6]
    assert row["retention_30d_pct"] == Decimal("25.00")
    bands = as_dict(dashboard.cohort_heat_band(users, events), "within_days", "band")
    assert bands == {30: "≥20", 60: "≥40", 90: "≥40"}


def test_empty_funnel(spark, users, events):
    none = events.where("false")
    row = funnel.funnel_overall(none).first()
    assert row["step1_signups"] is None and row["signup_to_onboard_pct"] is None
    assert [r["users"] for r in funnel.funnel_summary_ordered(none).collect()] == [0, 0, 0, 0]
    assert as_dict(funnel.dropoff_users(users, none), "drop_off_stage", "user_count") == {"Unknown": 7}
    assert dashboard.biggest_dropoff(none).count() == 0


def test_step_drop(events):
    rows = dashboard.funnel_step_drop(events).orderBy("step_order").collect()
    assert [r["users_lost"] for r in rows] == [None, 2, 0, 3]
    assert rows[1]["drop_pct"] == Decimal("33.33")
    assert dashboard.biggest_dropoff(events).first()["funnel_step"] == "Second Purchase"


def test_drop_off_by_device(users, events):
    row = dashboard.dropoff_by_device(users, events).first()
    assert (row["dropped_at_onboarding"], row["dropped_after_onboarding"]) == (2, 1)
    assert (row["one_time_buyers"], row["repeat_buyers"]) == (2, 1)


def test_reports_share_a_stored_stage_table(users, events, tmp_path):
    funnel.user_stages(events).write.parquet(str(tmp_path / "stages"))
    stages = funnel.UserStages(events.sparkSession.read.parquet(str(tmp_path / "stages")))
    for report in (
        funnel.channel_funnel, funnel.device_funnel, funnel.time_to_convert,
        funnel.cohort_retention, funnel.vw_cohort_matrix, funnel.dropoff_users,
        funnel.vw_dropoff_by_stage, funnel.journey_report, funnel.vw_channel_conversion,
    ):
        assert sorted(report(users, stages).collect()) == sorted(report(users, events).collect())
    summary = funnel.vw_funnel_summary
    assert sorted(summary(stages).collect()) == sorted(summary(events).collect())

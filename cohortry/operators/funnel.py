"""User funnel: step conversion, drop-off, time to convert, purchase cohorts.

``users`` has one row per ``user_id``; ``events`` any number per user and type.
All per-user reports start from one row per user that ``user_stages`` makes with
a single aggregate, so the events are shuffled once, after partial aggregation,
and never joined row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.arithmetic import count_where, percent, rounded, sum_where
from cohortry.functions.buckets import first_match
from cohortry.functions.dates import days_between, us_week

# Event types in funnel order, and their labels in reports.
SIGNED_UP = "signed_up"
ONBOARDED = "completed_onboarding"
FIRST_PURCHASE = "first_purchase"
SECOND_PURCHASE = "second_purchase"
STAGES = (SIGNED_UP, ONBOARDED, FIRST_PURCHASE, SECOND_PURCHASE)
STAGE_LABELS = ("Signed Up", "Completed Onboarding", "First Purchase", "Second Purchase")

RETENTION_DAYS = (30, 60, 90)


@dataclass(frozen=True)
class UserStages:
    """A stored result of ``user_stages``, which reports take in place of the events.

    Several reports then share one pass over the events; ``plans.user_state`` keeps
    such a table up to date.
    """

    frame: DataFrame


Events = DataFrame | UserStages


def user_stages(events: Events) -> DataFrame:
    """Per user: ``did_<stage>`` flags and the earliest ``<stage>_date``."""
    if isinstance(events, UserStages):
        return events.frame
    kind = F.col("event_type")
    flags = [F.max(F.when(kind == s, 1).otherwise(0)).alias(f"did_{s}") for s in STAGES]
    dates = [F.min(F.when(kind == s, F.col("event_date"))).alias(f"{s}_date") for s in STAGES]
    return (
        events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*flags, *dates)
    )


def _did(stage: str) -> Column:
    return F.coalesce(F.col(f"did_{stage}"), F.lit(0)) == 1


def _all_users(users: DataFrame, events: Events) -> DataFrame:
    """Every user, with the stages of those who have events."""
    return users.join(user_stages(events), "user_id", "left")


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


def funnel_overall(events: DataFrame) -> DataFrame:
    """One row of step counts and rates.  Counts event *rows*, not users."""
    step = {s: sum_where(F.col("event_type") == s) for s in STAGES}
    return events.agg(
        step[SIGNED_UP].alias("step1_signups"),
        step[ONBOARDED].alias("step2_onboarded"),
        step[FIRST_PURCHASE].alias("step3_first_purchase"),
        step[SECOND_PURCHASE].alias("step4_second_purchase"),
        percent(step[ONBOARDED], step[SIGNED_UP]).alias("signup_to_onboard_pct"),
        percent(step[FIRST_PURCHASE], step[ONBOARDED]).alias("onboard_to_purchase_pct"),
        percent(step[SECOND_PURCHASE], step[FIRST_PURCHASE]).alias("first_to_second_purchase_pct"),
        percent(step[SECOND_PURCHASE], step[SIGNED_UP]).alias("overall_conversion_pct"),
    )


def _funnel_by(users: DataFrame, events: Events, key: str) -> DataFrame:
    """Users per key who reached each stage; all users count as signed up."""
    return (
        _all_users(users, events)
        .groupBy(key)
        .agg(
            F.count("user_id").alias("signups"),
            count_where(_did(ONBOARDED)).alias("onboarded"),
            count_where(_did(FIRST_PURCHASE)).alias("purchased"),
            count_where(_did(SECOND_PURCHASE)).alias("repeat_buyers"),
        )
    )


def _rate(part: str, whole: str, name: str) -> Column:
    return percent(F.col(part), F.col(whole)).alias(name)


def channel_funnel(users: DataFrame, events: Events) -> DataFrame:
    return _funnel_by(users, events, "channel").select(
        "*",
        _rate("onboarded", "signups", "onboard_rate_pct"),
        _rate("purchased", "onboarded", "purchase_rate_pct"),
        _rate("repeat_buyers", "purchased", "repeat_rate_pct"),
        _rate("purchased", "signups", "overall_conv_pct"),
    )


def device_funnel(users: DataFrame, events: Events) -> DataFrame:
    return _funnel_by(users, events, "device").select(
        "device",
        "signups",
        "onboarded",
        "purchased",
        _rate("onboarded", "signups", "onboard_rate_pct"),
        _rate("purchased", "onboarded", "purchase_rate_pct"),
        _rate("repeat_buyers", "purchased", "repeat_rate_pct"),
    )


def vw_channel_conversion(users: DataFrame, events: Events) -> DataFrame:
    return _funnel_by(users, events, "channel").select(
        "*", _rate("purchased", "signups", "conv_rate_pct")
    )


def time_to_convert(users: DataFrame, events: Events) -> DataFrame:
    """Days from signup to onboarding and to first purchase, buyers only."""
    bought = user_stages(events).where(F.col(f"{FIRST_PURCHASE}_date").isNotNull())
    signup = F.col(f"{SIGNED_UP}_date")
    to_onboard = days_between(signup, F.col(f"{ONBOARDED}_date"))
    to_purchase = days_between(signup, F.col(f"{FIRST_PURCHASE}_date"))
    return (
        users.select("user_id", "channel", "device")
        .join(bought, "user_id")
        .groupBy("channel", "device")
        .agg(
            F.count(F.lit(1)).alias("converters"),
            rounded(F.avg(to_onboard), 1).alias("avg_days_to_onboard"),
            rounded(F.avg(to_purchase), 1).alias("avg_days_to_purchase"),
            F.min(to_purchase).alias("fastest_days"),
            F.max(to_purchase).alias("slowest_days"),
        )
    )


def _purchase_cohorts(users: DataFrame, events: Events, year: str, week: str) -> DataFrame:
    """Signup-week cohorts and how many bought within each retention window.

    The windows are cumulative, and a purchase dated before signup counts too.
    """
    signup = F.col("signup_date")
    purchase = F.col(f"{FIRST_PURCHASE}_date")
    days = days_between(signup, purchase)
    return (
        _all_users(users, events)
        .groupBy(F.year(signup).alias(year), us_week(signup).alias(week))
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            count_where(purchase.isNotNull()).alias("ever_purchased"),
            *[count_where(days <= n).alias(f"purchased_in_{n}d") for n in RETENTION_DAYS],
        )
    )


def cohort_retention(users: DataFrame, events: Events) -> DataFrame:
    return _purchase_cohorts(users, events, "signup_year", "signup_week").select(
        "*",
        *[_rate(f"purchased_in_{n}d", "cohort_size", f"retention_{n}d_pct") for n in RETENTION_DAYS],
    )


def vw_cohort_matrix(users: DataFrame, events: Events) -> DataFrame:
    """Retention percentages only.  Any purchase within n days of signup means
    the earliest one is, so this is ``cohort_retention`` with fewer columns."""
    return _purchase_cohorts(users, events, "yr", "wk").select(
        "yr",
        "wk",
        "cohort_size",
        *[_rate(f"purchased_in_{n}d", "cohort_size", f"retention_{n}d") for n in RETENTION_DAYS],
    )


def drop_off_stage() -> Column:
    """Where a user stopped.  A buyer who skipped onboarding stopped there.

    The stage names are fixed values; users without events are Unknown.
    """
    return first_match(
        [
            (_did(SIGNED_UP) & ~_did(ONBOARDED), "Dropped at Onboarding"),
            (_did(ONBOARDED) & ~_did(FIRST_PURCHASE), "Dropped after Onboarding"),
            (_did(FIRST_PURCHASE) & ~_did(SECOND_PURCHASE), "One-time Buyers"),
            (_did(SECOND_PURCHASE), "Repeat Buyers"),
        ],
        "Unknown",
    )


def dropoff_users(users: DataFrame, events: Events) -> DataFrame:
    """Users per stopping stage, channel and device, and their share of all."""
    groups = (
        _all_users(users, events)
        .groupBy(drop_off_stage().alias("drop_off_stage"), "channel", "device")
        .agg(F.count(F.lit(1)).alias("user_count"))
    )
    everyone = F.sum("user_count").over(Window.partitionBy())
    return groups.withColumn("pct_of_all_users", percent(F.col("user_count"), everyone))


def vw_dropoff_by_stage(users: DataFrame, events: Events) -> DataFrame:
    return (
        _all_users(users, events)
        .groupBy(drop_off_stage().alias("stage"), "channel", "device")
        .agg(F.count(F.lit(1)).alias("users"))
    )


def journey_report(users: DataFrame, events: Events) -> DataFrame:
    """Journeys of signed-up users per channel: stages reached and gaps in days.

    A user has one journey, made of the earliest event of each type; several
    events of a type do not multiply it.  Stages count by the furthest one
    reached, so a buyer who skipped onboarding counts as onboarded.
    """
    signup = F.col(f"{SIGNED_UP}_date")
    onboard = F.col(f"{ONBOARDED}_date")
    purchase = F.col(f"{FIRST_PURCHASE}_date")
    repeat = F.col(f"{SECOND_PURCHASE}_date")
    furthest = (
        F.when(repeat.isNotNull(), 4)
        .when(purchase.isNotNull(), 3)
        .when(onboard.isNotNull(), 2)
        .otherwise(1)
    )
    journeys = (
        user_stages(events)
        .where(F.col(f"did_{SIGNED_UP}") == 1)
        .join(users.select("user_id", "channel"), "user_id")
        .withColumn("_stage", furthest)
    )
    return (
        journeys.groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            count_where(F.col("_stage") >= 2).alias("onboarded"),
            count_where(F.col("_stage") >= 3).alias("purchased"),
            count_where(F.col("_stage") >= 4).alias("repeat_buyers"),
            rounded(F.avg(days_between(signup, onboard)), 1).alias("avg_days_to_onboard"),
            rounded(F.avg(days_between(signup, purchase)), 1).alias("avg_days_to_purchase"),
            rounded(F.avg(days_between(purchase, repeat)), 1).alias("avg_days_between_purchases"),
        )
        .withColumn("overall_conv_pct", percent(F.col("purchased"), F.col("total_users")))
    )


def vw_funnel_summary(events: Events) -> DataFrame:
    """Distinct users per stage: always four rows, 0 for an empty stage."""
    totals = user_stages(events).agg(*[count_where(_did(s)).alias(s) for s in STAGES])
    steps = [
        F.struct(
            F.lit(i).alias("step_order"),
            F.lit(label).alias("funnel_step"),
            F.col(stage).alias("users"),
        )
        for i, (stage, label) in enumerate(zip(STAGES, STAGE_LABELS), start=1)
    ]
    return totals.select(F.inline(F.array(*steps)))


def funnel_summary_ordered(events: Events) -> DataFrame:
    """The funnel summary in step order."""
    return vw_funnel_summary(events).orderBy("step_order")


def cohort_matrix_first(users: DataFrame, events: Events, n: int = 5) -> DataFrame:
    """The first ``n`` cohorts of the matrix by year and week."""
    return vw_cohort_matrix(users, events).orderBy("yr", "wk").limit(n)

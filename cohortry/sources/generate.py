"""Seeded users and funnel events.

Every draw is a hash of the user id and a name for the draw, so the data does
not depend on partitioning and is the same on every run with the same seed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.schemas import CHANNELS, CITIES, DEVICES, EVENT_TYPES

# Last signup day, days of signups, share that returns.
LAST_SIGNUP = dt.date(2024, 1, 1)
SIGNUP_DAYS = 365
RETURNING_EVERY = 3

# Percentage that goes on to the next stage, longest gap in days.
NEXT_STAGES = (
    ("completed_onboarding", 72, 3),
    ("first_purchase", 45, 14),
    ("second_purchase", 40, 30),
)


def draw(user: Column, name: str, choices: int, seed: int) -> Column:
    """A number from 0 to ``choices - 1`` for a user."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(name), user.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(choices)).cast("int")


def _pick(user: Column, name: str, values: tuple[str, ...], seed: int) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, draw(user, name, len(values), seed) + 1)


def users_from_ids(ids: DataFrame, seed: int = 0) -> DataFrame:
    """A generated user for every ``user_id``."""
    user = F.col("user_id")
    return ids.select(
        "user_id",
        F.date_sub(F.lit(LAST_SIGNUP), draw(user, "signup", SIGNUP_DAYS, seed)).alias("signup_date"),
        _pick(user, "channel", CHANNELS, seed).alias("channel"),
        F.when(user % RETURNING_EVERY == 0, "returning").otherwise("new").alias("segment"),
        _pick(user, "city", CITIES, seed).alias("city"),
        _pick(user, "device", DEVICES, seed).alias("device"),
    )


def generate_users(spark: SparkSession, n: int = 5000, seed: int = 0) -> DataFrame:
    """Users 1..n."""
    return users_from_ids(spark.range(1, n + 1).withColumnRenamed("id", "user_id"), seed)


def generate_stage_events(users: DataFrame, seed: int = 0) -> DataFrame:
    """One event per user and stage reached; everyone signs up.

    The stages of a user are worked out in one pass over the users: a stage date
    is NULL once the user has stopped.
    """
    user = F.col("user_id")
    reached = users.select("user_id", F.col("signup_date").alias(EVENT_TYPES[0]))
    for before, (stage, percentage, longest) in zip(EVENT_TYPES, NEXT_STAGES):
        gap = draw(user, f"{stage} gap", longest, seed) + 1
        goes_on = draw(user, stage, 100, seed) < percentage
        reached = reached.withColumn(stage, F.when(goes_on, F.date_add(before, gap)))
    events = [
        F.struct(F.lit(stage).alias("event_type"), F.col(stage).alias("event_date"))
        for stage in EVENT_TYPES
    ]
    return reached.select("user_id", F.inline(F.array(*events))).where(
        F.col("event_date").isNotNull()
    )

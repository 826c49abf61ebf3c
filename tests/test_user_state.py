"""Funnel state per user, merged day by day."""

import datetime as dt
import random

import pytest
from builders import make_events, make_users

from cohortry.operators import funnel
from cohortry.operators.funnel import STAGES
from cohortry.plans.user_state import UserState


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def log():
    rng = random.Random(8)
    day = dt.date(2024, 1, 1)
    return [
        (rng.choice([None, 1, 1, 1, *range(2, 60)]), rng.choice([*STAGES, "other"]),
         str(day + dt.timedelta(rng.randrange(10))))
        for _ in range(900)
    ]


def test_merged_days_equal_a_rebuild(spark, tmp_path, log):
    state = UserState(spark, str(tmp_path), buckets=4)
    days = sorted({d for _, _, d in log})
    random.Random(1).shuffle(days)
    for day in [*days, days[0], days[3]]:
        state.merge(make_events(spark, [e for e in log if e[2] == day]))
    rebuilt = funnel.user_stages(make_events(spark, log))
    assert rows(state.stages().frame.select(*rebuilt.columns)) == rows(rebuilt)
    # Another session finds the newest state.
    other = UserState(spark.newSession(), str(tmp_path))
    assert other.buckets == 4 and rows(other.stages().frame.select(*rebuilt.columns)) == rows(rebuilt)


def test_reports_join_bucket_by_bucket(spark, tmp_path, log):
    state = UserState(spark, str(tmp_path), buckets=4)
    users = make_users(spark, [(u, "2024-01-01", "ab"[u % 2], "m") for u in range(1, 70)])
    state.set_users(users)
    state.merge(make_events(spark, log))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = funnel.channel_funnel(state.users(), state.stages())
        text = report._jdf.queryExecution().executedPlan().toString()
        join = text[text.index("SortMergeJoin"):]
        assert "Exchange" not in join and text.count("Exchange hashpartitioning(channel") == 1
        found = rows(report)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == rows(funnel.channel_funnel(users, make_events(spark, log)))


def test_a_merge_that_fails_changes_nothing(spark, tmp_path, log):
    state = UserState(spark, str(tmp_path), buckets=3)
    with pytest.raises(LookupError):
        state.stages()
    state.merge(make_events(spark, log[:300]))
    before = rows(state.stages().frame)
    early = state.stages().frame
    broken = spark.range(20).selectExpr(
        "IF(id < 19, id, raise_error('lost')) AS user_id", "'signed_up' AS event_type", "DATE'2024-01-01' AS event_date"
    )
    with pytest.raises(Exception, match="lost"):
        state.merge(broken)
    assert rows(state.stages().frame) == before
    # A reader keeps its version while the next one is committed.
    state.merge(make_events(spark, log[300:]))
    assert rows(early) == before != rows(state.stages().frame)
    assert state.retire(keep=1) == 1 and len(rows(state.stages().frame)) > 0


def test_writers_at_the_same_time_do_not_lose_a_merge(spark, tmp_path, log):
    one, two = (UserState(spark, str(tmp_path), buckets=3) for _ in range(2))
    one.merge(make_events(spark, log[:10]))
    number, old = two._read("stages")
    one.merge(make_events(spark, log[10:20]))
    with pytest.raises(RuntimeError, match="meanwhile"):
        two._save("stages", old, number)

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cohortry.plans import publishing
from cohortry.plans.ledger import Ledger
from cohortry.plans.views import CHURN_VIEWS, publish_views
from cohortry.sources import testbed


def numbers(spark, n, extra=None):
    return spark.range(n).withColumn("v", F.lit(extra))


def test_a_reader_finishes_on_the_version_it_started_with(spark, tmp_path):
    path = str(tmp_path / "p")
    publishing.publish({"a": numbers(spark, 5, "old")}, path)
    early = publishing.read_published(spark, path, "a")
    publishing.publish({"a": numbers(spark, 9, "new")}, path)
    late = publishing.read_published(spark, path, "a")
    assert early.count() == 5 and {r["v"] for r in early.collect()} == {"old"}
    assert late.count() == 9 and {r["v"] for r in late.collect()} == {"new"}
    assert publishing.read_published(spark, path, "a", number=1).count() == 5


def test_a_failed_publish_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "p")
    publishing.publish({"a": numbers(spark, 5), "b": numbers(spark, 2)}, path)
    broken = spark.range(10).selectExpr("IF(id < 9, id, raise_error('lost')) AS id", "'x' AS v")
    with pytest.raises(Exception, match="lost"):
        publishing.publish({"a": numbers(spark, 7), "b": broken}, path)
    version = publishing.current_version(spark, path)
    assert version.number == 1 and dict(version.rows) == {"a": 5, "b": 2}
    assert publishing.read_published(spark, path, "a").count() == 5
    # What the failed one wrote goes once it is old enough.
    assert len(os.listdir(tmp_path / "p" / "versions")) == 2
    publishing.retire(spark, path, keep=1)
    assert len(os.listdir(tmp_path / "p" / "versions")) == 2
    publishing.retire(spark, path, keep=1, uncommitted_seconds=0)
    assert len(os.listdir(tmp_path / "p" / "versions")) == 1
    assert publishing.read_published(spark, path, "b").count() == 2


def test_all_views_of_a_version_appear_together(spark, folder, tmp_path):
    path = str(tmp_path / "churn")
    people = testbed.subscribers(spark, folder)
    names = publish_views(CHURN_VIEWS, people, path)
    assert names == list(CHURN_VIEWS) and len(publishing.versions(spark, path)) == 1
    other = spark.newSession()
    assert publishing.attach(other, path) == names
    assert other.table("vw_churn_by_contract").count() == 3
    publish_views(CHURN_VIEWS, people.where("contract = 'One year'"), path)
    assert other.table("vw_churn_by_contract").count() == 3
    publishing.attach(other, path)
    assert other.table("vw_churn_by_contract").count() == 1
    publishing.attach(other, path, number=1)
    assert other.table("vw_churn_by_contract").count() == 3


def test_versions_are_restored_and_retired(spark, tmp_path):
    path = str(tmp_path / "p")
    for n in (1, 2, 3):
        publishing.publish({"a": numbers(spark, n)}, path)
    assert publishing.restore(spark, path, 1).number == 4
    assert publishing.read_published(spark, path, "a").count() == 1
    # Version 4 keeps the files of version 1, though that entry goes.
    assert publishing.retire(spark, path, keep=2) == [1, 2]
    assert [v.number for v in publishing.versions(spark, path)] == [3, 4]
    assert publishing.read_published(spark, path, "a").count() == 1
    assert publishing.read_published(spark, path, "a", number=3).count() == 3
    with pytest.raises(ValueError):
        publishing.retire(spark, path, keep=0)


def test_publishers_at_the_same_time_take_different_numbers(spark, tmp_path):
    path = str(tmp_path / "p")
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda n: publishing.publish({"a": numbers(spark, n)}, path), range(1, 7)))
    assert sorted(v.number for v in found) == [1, 2, 3, 4, 5, 6]
    newest = max(found, key=lambda v: v.number)
    assert publishing.read_published(spark, path, "a").count() == newest.rows["a"]


def test_a_number_is_committed_once(spark, tmp_path):
    log = Ledger(spark, str(tmp_path / "log"))
    assert log.latest() is None
    assert log.commit(1, {"x": "é"}) and not log.commit(1, {"x": "other"})
    assert log.read(1) == {"x": "é"} and log.numbers() == [1]
    assert [n for n in os.listdir(tmp_path / "log") if "draft" in n] == []


def test_unknown_views_and_partitioned_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(LookupError):
        publishing.current_version(spark, path)
    with pytest.raises(ValueError):
        publishing.publish({}, path)
    frame = spark.range(6).selectExpr("id % 2 AS side", "id AS `odd name`", "CAST(id AS STRING) AS t")
    publishing.publish({"a": frame}, path, partition_by="side")
    found = publishing.read_published(spark, path, "a")
    assert found.columns == frame.columns and found.where("side = 1").count() == 3
    with pytest.raises(LookupError):
        publishing.read_published(spark, path, "b")

"""Ranks from a stored index, after inserts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortry.plans.order_index import OrderIndex

RANKS = {"inside": ["g"], "overall": []}


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def people(spark, n, seed=1, kind="INT"):
    rng = random.Random(seed)
    data = [
        (seed * 100_000 + i, rng.choice("abc") if i % 9 else None, rng.choice([None, 5, 5, 5, rng.randrange(100)]), rng.randrange(4))
        for i in range(n)
    ]
    return spark.createDataFrame(data, f"id INT, g STRING, v {kind}, w INT")


def plain(frame, descending):
    first = F.desc("v") if descending else F.asc("v")
    order = [first, F.asc("w")]
    return frame.select(
        "*", F.rank().over(Window.partitionBy("g").orderBy(*order)).alias("inside"),
        F.rank().over(Window.orderBy(*order)).alias("overall"),
    )


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_ranks_after_inserts_equal_full_ranks(spark, tmp_path, descending, ranges):
    index = OrderIndex(spark, str(tmp_path), [("v", descending), ("w", False)], RANKS, ranges)
    parts = [people(spark, n, seed) for seed, n in enumerate((400, 150, 1, 0), start=1)]
    index.build(parts[0])
    so_far = parts[0]
    assert rows(index.rank(so_far)) == rows(plain(so_far, descending))
    for part in parts[1:]:
        index.insert(part)
        so_far = so_far.unionByName(part)
        assert rows(index.rank(so_far)) == rows(plain(so_far, descending))


def test_an_insert_reads_and_writes_changed_ranges_only(spark, tmp_path, monkeypatch):
    index = OrderIndex(spark, str(tmp_path), [("v", True)], {"r": []}, ranges=20)
    frame = spark.range(2000).selectExpr("id", "CAST(id % 1000 AS DECIMAL(12,2)) AS v")
    index.build(frame)
    before = index._latest()[1]["ranges"]
    read, stored = [], OrderIndex._stored
    monkeypatch.setattr(OrderIndex, "_stored", lambda self, entry, chosen: read.append(list(chosen)) or stored(self, entry, chosen))
    new = spark.createDataFrame([(9001, "501.50"), (9002, "502.25")], "id BIGINT, v STRING").selectExpr("id", "CAST(v AS DECIMAL(12,2)) AS v")
    changed = index.insert(new)
    after = index._latest()[1]["ranges"]
    assert len(changed) <= 2 and [r for part in read for r in part] == changed
    assert {r for r in before if before[r] != after[r]} == set(map(str, changed))
    every = frame.unionByName(new)
    expected = every.select("*", F.rank().over(Window.orderBy(F.desc("v"))).alias("r"))
    assert rows(index.rank(every)) == rows(expected)


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    index = OrderIndex(spark, str(tmp_path), [("v", False), ("w", False)], RANKS, 4)
    with pytest.raises(LookupError):
        index.index()
    index.build(people(spark, 50))
    known = index._latest()
    index.insert(people(spark, 20, 2))
    monkeypatch.setattr(OrderIndex, "_latest", lambda self: known)
    with pytest.raises(RuntimeError, match="meanwhile"):
        index.insert(people(spark, 20, 3))


@pytest.mark.parametrize("kind,value", [("DATE", "date_add(DATE'2024-01-01', CAST(id % 90 AS INT))"), ("DOUBLE", "id * 0.37 % 11")])
def test_other_types_of_the_first_column(spark, tmp_path, kind, value):
    frame = spark.range(300).selectExpr("id", f"CAST({value} AS {kind}) AS v")
    index = OrderIndex(spark, str(tmp_path), [("v", False)], {"r": []}, 8)
    index.build(frame.where("id < 200"))
    index.insert(frame.where("id >= 200"))
    assert rows(index.rank(frame)) == rows(frame.select("*", F.rank().over(Window.orderBy("v")).alias("r")))


def test_only_rows_without_a_parent_are_shuffled(spark, monkeypatch):
    from cohortry.sources import checks

    child = spark.range(5000).selectExpr("IF(id % 50 = 0, NULL, IF(id % 3 = 0, 7, id - 2500)) AS k")
    parent = spark.range(-1500, 1500).selectExpr("CAST(id AS INT) AS p").unionByName(spark.createDataFrame([(None,)], "p INT"))
    found = checks.orphans(child, "k", parent, "p")
    text = found._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange hashpartitioning(_key"):]
    assert "BroadcastHashJoin" in below and text.count("Exchange hashpartitioning") == 1
    expected = rows(found)
    keys = [r["k"] for r in child.collect() if r["k"] is not None]
    assert expected == sorted(((k, keys.count(k)) for k in set(keys) if not -1500 <= k < 1500), key=str)
    # New rows only, against stored words.
    words = checks.key_words(parent, "p")
    report = checks.check_foreign_key(child.where("k > 0"), "k", parent, "p", "new rows", words).first()
    assert tuple(report) == ("new rows", *[f([n for k, n in expected if k > 0]) for f in (len, sum)])
    monkeypatch.setattr(checks, "MEMBER_WORDS", 1)
    assert rows(checks.orphans(child, "k", parent, "p")) == expected
    odd = child.selectExpr("CAST(k AS STRING) AS k")
    assert rows(checks.orphans(odd, "k", parent.selectExpr("CAST(p AS STRING) AS p"), "p")) == sorted(
        ((str(k), n) for k, n in expected), key=str
    )

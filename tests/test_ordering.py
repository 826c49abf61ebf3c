"""Distributed ranks, tiles and row numbers against Spark's own windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortry.plans.ordering import add_ranks, add_row_number, add_tiles


def skewed(spark, rows=2003):
    """A third of the rows share one key; some values are missing."""
    return spark.range(rows).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 101 = 1 THEN NULL ELSE id * 7919 % 500 END AS a",
        "CAST(CASE WHEN id % 2 = 0 THEN 1 ELSE id % 9 END AS DECIMAL(10,2)) AS b",
        "CASE WHEN id % 5 < 3 THEN 'big' WHEN id % 5 = 3 THEN 'small' END AS g",
    )


@pytest.fixture(params=[1, 3, 40])
def partitions(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_ranks(spark, partitions):
    frame = skewed(spark)
    order = [F.desc("a"), F.asc("b")]
    found = add_ranks(
        frame, [("a", True), ("b", False)], {"inside": ["g"], "overall": []}, {"inside": "peers"}
    ).select("id", "inside", "overall", "peers")
    expected = frame.select(
        "id",
        F.rank().over(Window.partitionBy("g").orderBy(*order)).alias("inside"),
        F.rank().over(Window.orderBy(*order)).alias("overall"),
        F.count(F.lit(1)).over(Window.partitionBy("g")).alias("peers"),
    )
    assert rows(found) == rows(expected)


def test_rank_within_groups_only(spark, partitions):
    frame = skewed(spark)
    found = add_ranks(frame, [("a", False)], {"r": ["g"]}).select("id", "r")
    expected = frame.select("id", F.rank().over(Window.partitionBy("g").orderBy("a")))
    assert rows(found) == rows(expected)


def test_tiles(spark, partitions):
    frame = skewed(spark)
    scores = {"t1": ("a", True), "t2": ("b", False), "t3": ("id", True)}
    found = add_tiles(frame, "id", scores).select("id", "t1", "t2", "t3")
    expected = frame.select(
        "id",
        F.ntile(5).over(Window.orderBy(F.desc_nulls_last("a"), "id")),
        F.ntile(5).over(Window.orderBy("b", "id")),
        F.ntile(5).over(Window.orderBy(F.desc("id"))),
    )
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [1]), (3, [1, 1, 1]), (7, [2, 2, 1, 1, 1])])
def test_tiles_of_few_rows(spark, n, sizes):
    tiled = add_tiles(spark.range(n), "id", {"t": ("id", False)})
    assert [r["count"] for r in tiled.groupBy("t").count().orderBy("t").collect()] == sizes


def test_tiles_with_text_keys(spark):
    frame = spark.createDataFrame([(f"it's \\{i:02d}", 1) for i in range(11)], "k STRING, v INT")
    found = add_tiles(frame, "k", {"t": ("v", False)}).select("k", "t")
    expected = frame.select("k", F.ntile(5).over(Window.orderBy("v", "k")))
    assert rows(found) == rows(expected)


def test_row_numbers_are_dense_and_ordered(spark, partitions):
    frame = skewed(spark).select("a", "b")
    found = add_row_number(frame, ["a", "b"], "n").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, 2004))
    keys = [(r["a"] is not None, r["a"] or 0, r["b"]) for r in found]
    assert keys == sorted(keys)


def test_equal_rows_are_spread_over_ranges(spark):
    """One key holding every row must not end in one range."""
    from cohortry.plans.durable import freeze
    from cohortry.plans.ordering import _ranged

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = freeze(spark.range(4000).selectExpr("1 AS k")).selectExpr(
            "k", "monotonically_increasing_id() AS _tie"
        )
        sizes = [r["count"] for r in _ranged(same, "k", "_tie").groupBy("_slice").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1000


@pytest.mark.parametrize("kind", ["DOUBLE", "DECIMAL(38,12)", "BIGINT", "DATE", "STRING"])
def test_tiles_order_values_in_their_own_type(spark, kind):
    value = {
        "DOUBLE": "CASE WHEN id % 7 = 0 THEN NULL ELSE pow(10D, id - 9) * (id % 3 - 1) END",
        "DECIMAL(38,12)": "id * 0.000000001BD",
        "BIGINT": "9223372036854775807 - id",
        "DATE": "date_add(DATE'2020-01-01', CAST(id AS INT))",
        "STRING": "concat('it\\'s ', id)",
    }[kind]
    frame = spark.range(43).selectExpr("id", f"CAST({value} AS {kind}) AS v")
    found = add_tiles(frame, "id", {"up": ("v", False), "down": ("v", True)}).select("id", "up", "down")
    expected = frame.select(
        "id",
        F.ntile(5).over(Window.orderBy(F.asc_nulls_first("v"), "id")),
        F.ntile(5).over(Window.orderBy(F.desc_nulls_last("v"), "id")),
    )
    assert rows(found) == rows(expected)


def test_tiles_of_tiny_and_huge_values(spark):
    frame = spark.range(10).selectExpr("id", "(id + 1) * 1e-7 AS small", "(id + 1) * 1e33 AS big")
    found = add_tiles(frame, "id", {"s": ("small", False), "b": ("big", False)}).select("id", "s", "b")
    assert rows(found) == [(i, i // 2 + 1, i // 2 + 1) for i in range(10)]


def test_ranks_are_of_one_moment(spark, tmp_path):
    """Rows written after the call change neither the ranks nor the rows."""
    path = str(tmp_path / "people")
    spark.createDataFrame([(1, 5), (2, 3)], "id INT, v INT").write.parquet(path)
    ranked = add_ranks(spark.read.parquet(path), [("v", True)], {"r": []}).select("id", "r")
    spark.createDataFrame([(3, 9)], "id INT, v INT").write.mode("overwrite").parquet(path)
    assert rows(ranked) == [(1, 1), (2, 2)]


def test_views_of_one_moment(spark):
    from builders import SUBSCRIBER_DDL, make_subscribers

    from cohortry.plans.views import CHURN_VIEWS, register_views

    spark.sql("DROP TABLE IF EXISTS people")
    spark.sql(f"CREATE TABLE people ({SUBSCRIBER_DDL}) USING parquet")
    try:
        make_subscribers(spark, [{"monthly_charges": 40}, {"monthly_charges": 60}]).write.insertInto("people")
        register_views(CHURN_VIEWS, spark.table("people"))
        more = make_subscribers(spark, [{"monthly_charges": 99, "customer_id": "new"}])
        more.write.insertInto("people")
        found = spark.table("vw_active_customer_risk").select("customer_id", "overall_risk_rank")
        assert rows(found) == [("C000", 2), ("C001", 1)]
        register_views(CHURN_VIEWS, spark.table("people"))
        found = spark.table("vw_active_customer_risk").select("customer_id", "overall_risk_rank")
        assert rows(found) == [("C000", 3), ("C001", 2), ("new", 1)]
    finally:
        spark.sql("DROP TABLE IF EXISTS people")


def test_row_numbers_of_many_equal_rows(spark, monkeypatch):
    """A row that fills most of the table is numbered in parts."""
    from cohortry.plans import ordering

    monkeypatch.setattr(ordering, "_PART_ROWS", 10)
    frame = spark.range(500).selectExpr("IF(id % 3 < 2, 7, id) AS k", "IF(id % 3 < 2, NULL, 'x') AS t")
    found = add_row_number(frame, ["k"], "n").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, 501))
    keys = [r["k"] for r in found]
    assert keys == sorted(keys) and keys.count(7) == 334


def test_hot_keys_are_bounded_by_their_share(spark):
    from cohortry.plans import hot_keys

    counts = spark.range(1000).selectExpr("id", "IF(id < 3, 5000, 2) AS rows")
    found = hot_keys.HotKeys(counts, "id", "rows", slice_rows=1000).slices
    assert rows(found) == [(0, 5), (1, 5), (2, 5)]
    assert rows(hot_keys.HotKeys(counts, "id", "rows", slice_rows=5000).slices) == []
    assert rows(hot_keys.HotKeys(counts.where("id < 0"), "id", "rows").slices) == []

"""Places in an order, found by histograms, against Spark's own windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortry.operators import rfm
from cohortry.plans import durable, ordering, selection
from cohortry.plans.ordering import add_tiles


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(params=[(7, 4), (40, 16), (300, 2048)])
def narrow(request, monkeypatch):
    """So few rows are sorted that the histograms do the work."""
    monkeypatch.setattr(selection, "FEW_ROWS", request.param[0])
    monkeypatch.setattr(selection, "BUCKETS", request.param[1])


def check_tiles(frame, key="id", tiles=5, column="v"):
    found = add_tiles(frame, key, {"up": (column, False), "down": (column, True)}, tiles).select(key, "up", "down")
    expected = frame.select(
        key,
        F.ntile(tiles).over(Window.orderBy(F.asc_nulls_first(column), key)),
        F.ntile(tiles).over(Window.orderBy(F.desc_nulls_last(column), key)),
    )
    assert rows(found) == rows(expected)


VALUES = {
    "skewed": "CAST(IF(id % 3 = 0, 7, id * 7919 % 50) AS INT)",
    "one value": "CAST(3 AS BIGINT)",
    "no value": "CAST(NULL AS BIGINT)",
    "some values": "CAST(IF(id % 7 < 5, NULL, id % 11) AS SMALLINT)",
    "far apart": "IF(id % 2 = 0, id - 9223372036854775807L, 9223372036854775807L - id)",
    "close together": "9223372036854775000L + id % 100",
    "money": "CAST(IF(id % 5 = 0, 0, (id * 104729 % 1000003) - 500000) AS DECIMAL(12,2))",
    "fine decimals": "CAST(99999999999999999999 AS DECIMAL(38,15)) + CAST(id % 90 AS DECIMAL(38,15)) * 0.000000000000001BD",
    "doubles": "CASE WHEN id % 13 = 0 THEN double('nan') WHEN id % 13 = 1 THEN double('infinity') "
    "WHEN id % 13 = 2 THEN double('-infinity') WHEN id % 13 = 3 THEN NULL ELSE pow(10D, id % 300) * (id % 3 - 1) END",
    "huge doubles": "IF(id % 2 = 0, 1.7e308D, -1.7e308D) * (id % 10) / 10",
    "tiny doubles": "4.9e-324D * (id % 5)",
    "dates": "date_add(DATE'1969-01-01', CAST(id * 31 % 900 AS INT))",
    "moments": "timestamp_micros(id * 999983 % 100000000 - 50000000)",
    "moments without a zone": "CAST(timestamp_micros(id * 999983 % 100000000) AS TIMESTAMP_NTZ)",
    "flags": "id % 4 = 0",
    "text": "IF(id % 3 = 0, 'the same', concat('customer number ', id * 7919 % 400))",
    "texts that begin alike": "substring(repeat('ab', 300), 1, CAST(id % 250 AS INT))",
    "odd text": "elt(CAST(id % 6 AS INT) + 1, '', 'é', 'e', chr(0), concat('a', chr(0)), '日本')",
}


@pytest.mark.usefixtures("narrow")
@pytest.mark.parametrize("name", list(VALUES))
def test_tiles_by_histograms(spark, name):
    check_tiles(spark.range(997).selectExpr("id", f"{VALUES[name]} AS v"))


@pytest.mark.usefixtures("narrow")
def test_ties_of_text_keys(spark):
    """All values are equal, and the keys share a long beginning."""
    frame = spark.range(600).selectExpr("concat(repeat('x', 50), id * 7919 % 600) AS k", "1 AS v")
    check_tiles(frame, "k")
    check_tiles(spark.range(600).selectExpr("CAST(id AS STRING) AS k", "IF(id % 3 = 0, NULL, 0) AS v"), "k", tiles=7)


@pytest.mark.usefixtures("narrow")
def test_places_of_several_orders_share_their_scans(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([None, 1, 1, 1, 2, 900]), rng.random(), rng.choice("abc")) for i in range(1200)]
    frame = spark.createDataFrame(data, "id BIGINT, a INT, b DOUBLE, c STRING").repartition(6)
    orders = [selection.Order("a", True), selection.Order("b", False), selection.Order("c", True)]
    wanted = {0: [0, 5, 700, 1199], 1: [600], 2: [3, 400, 401]}
    found = {(o, p): r["_key"] for o, p, r in selection.rows_at(frame, "id", orders, wanted, 1200)}
    plain = [
        sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])),
        sorted(data, key=lambda r: (r[2], r[0])),
        sorted(data, key=lambda r: (-ord(r[3]), r[0])),
    ]
    assert found == {(o, p): plain[o][p][0] for o, ps in wanted.items() for p in ps}


def test_types_without_an_order_are_refused(spark):
    with pytest.raises(TypeError):
        add_tiles(spark.range(9).selectExpr("id", "map('a', id) AS v"), "id", {"t": ("v", False)})


def test_segments_neither_sort_nor_checkpoint_customers(spark, folder, monkeypatch):
    from cohortry.sources import testbed

    def refuse(frame):
        raise AssertionError("a checkpoint")

    seen = []

    def record(frame):
        seen.append(frame)
        return durable.store(frame)

    monkeypatch.setattr(ordering, "freeze", refuse)
    monkeypatch.setattr(ordering, "store", record)
    orders = testbed.sales(spark, folder, False).orders
    scored = rfm.vw_rfm_segments(orders, testbed.AS_OF)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1 and "Sort" not in plan and "Exchange" not in plan
    assert "rangepartitioning" not in seen[0]._jdf.queryExecution().executedPlan().toString()

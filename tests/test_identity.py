"""Dense ids that continue over batches."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from test_ordering import partitions, rows, skewed  # noqa: F401

from cohortry.plans.identity import NumberedTable, number_rows


@pytest.mark.usefixtures("partitions")
def test_row_numbers_are_dense_and_ordered(spark):
    frame = skewed(spark).select("a", "b")
    found = number_rows(frame, ["a", "b"], "n").orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, 2004))
    keys = [(r["a"] is not None, r["a"] or 0, r["b"]) for r in found]
    assert keys == sorted(keys)


def table(spark, tmp_path):
    return NumberedTable(spark, str(tmp_path / "t"), ["k"], "n")


def test_batches_continue_without_gaps(spark, tmp_path):
    ids = table(spark, tmp_path)
    assert ids.high_water() == 0
    first = ids.append(spark.range(500).selectExpr("500 - id AS k", "CAST(id AS STRING) AS t"), "monday")
    before = rows(first)
    second = ids.append(spark.range(300).selectExpr("id AS k", "'x' AS t"), "tuesday")
    assert sorted(r[0] for r in before) == list(range(1, 501))
    assert sorted(r[0] for r in rows(second)) == list(range(501, 801))
    assert [r[1] for r in before] == sorted(r[1] for r in before)
    # Old ids have not changed, and the whole table has both.
    assert rows(first) == before and set(before) <= set(rows(ids.read()))
    assert sorted(r["n"] for r in ids.read().collect()) == list(range(1, 801)) and ids.high_water() == 800


def test_a_batch_that_comes_again_keeps_its_ids(spark, tmp_path):
    ids = table(spark, tmp_path)
    batch = spark.range(200).selectExpr("id % 3 AS k", "id AS v")
    once = rows(ids.append(batch, "monday"))
    ids.append(spark.range(10).selectExpr("id AS k", "id AS v"), "tuesday")
    # Another order of arrival and another process, but the same batch.
    again = table(spark, tmp_path).append(batch.repartition(7), "monday")
    assert rows(again) == once and ids.high_water() == 210
    assert len(ids.entries()) == 2


def test_a_batch_that_failed_gets_no_ids(spark, tmp_path):
    ids = table(spark, tmp_path)
    broken = spark.range(50).selectExpr("IF(id < 49, id, raise_error('lost')) AS k", "id AS v")
    with pytest.raises(Exception, match="lost"):
        ids.append(broken, "monday")
    assert ids.high_water() == 0
    assert sorted(r[0] for r in rows(ids.append(spark.range(5).selectExpr("id AS k", "id AS v"), "monday"))) == [1, 2, 3, 4, 5]


def test_writers_at_the_same_time_share_no_id(spark, tmp_path):
    def write(i):
        return table(spark, tmp_path).append(spark.range(20 + i).selectExpr("id AS k", f"{i} AS v"), f"batch {i}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(5)))
    found = rows(table(spark, tmp_path).read())
    assert [r[0] for r in found] == list(range(1, 111))
    # The ids of a batch follow each other.
    starts = [v for i, (_, _, v) in enumerate(found) if not i or found[i - 1][2] != v]
    assert sorted(starts) == [0, 1, 2, 3, 4]


def test_a_row_that_fills_a_table_is_spread(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = table(spark, tmp_path)
        found = ids.append(spark.range(4000).selectExpr("1 AS k", "'same' AS t"), "all")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r[0] for r in rows(found)) == list(range(1, 4001))
    stored = spark.read.parquet(f"{tmp_path}/t/{ids.entries()[0]['folder']}/rows")
    sizes = [r["count"] for r in stored.selectExpr("shiftright(_spot, 33) AS s").groupBy("s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_empty_batches_and_clashing_names(spark, tmp_path):
    ids = table(spark, tmp_path)
    with pytest.raises(LookupError):
        ids.read()
    assert ids.append(spark.range(0).selectExpr("id AS k"), "none").count() == 0
    assert sorted(r[0] for r in rows(ids.append(spark.range(2).selectExpr("id AS k"), "two"))) == [1, 2]
    with pytest.raises(ValueError, match="_spot"):
        ids.append(spark.range(2).selectExpr("id AS k", "id AS _spot"), "three")
    odd = spark.range(3).selectExpr("id AS `odd name`", "ARRAY(id) AS list", "map('a', id) AS m")
    assert number_rows(odd, ["list"], "n").columns == ["n", "odd name", "list", "m"]

"""What the plans must look like to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from cohortry.operators import churn, funnel, rfm, sales
from cohortry.plans import durable, ordering, sizes
from cohortry.sources import checks, star_schema, testbed


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """The business tables as parquet, the way reports meet them."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    root = tmp_path_factory.mktemp("stored")
    area = testbed.sales(spark, folder)
    data = testbed.funnel(spark, folder)
    frames = {
        "subscribers": testbed.subscribers(spark, folder),
        "orders": area.orders, "customers": area.customers, "products": area.products,
        "users": data.users, "events": data.events,
    }
    tables = {}
    for name, frame in frames.items():
        frame.write.parquet(str(root / name))
        tables[name] = spark.read.parquet(str(root / name))
    return tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", text)


def columns(scan):
    return {c.split("#")[0] for c in scan.split(",")}


def test_reports_read_only_their_columns(stored):
    (scan,) = scans(plan(churn.churn_by_contract(stored["subscribers"])))
    assert columns(scan) == {"contract", "churn"}
    (scan,) = scans(plan(sales.shipping_performance(stored["orders"])))
    assert columns(scan) == {"order_date", "ship_date", "ship_mode"}


def test_month_report_pushes_its_dates_down(stored):
    text = plan(sales.monthly_kpi_report(stored["orders"], 2000, 11))
    assert len(scans(text)) == 1
    assert "GreaterThanOrEqual(order_date,2000-10-01)" in text
    assert "LessThanOrEqual(order_date,2000-11-30)" in text


@pytest.fixture
def frozen(monkeypatch):
    """The plans of what is checkpointed."""
    plans = []

    def record(frame):
        plans.append(plan(frame))
        return durable.freeze(frame)

    monkeypatch.setattr(ordering, "freeze", record)
    return plans


def test_active_filter_is_pushed_down(stored):
    assert "EqualTo(churn,No)" in plan(churn.top_at_risk(stored["subscribers"]))


def test_ranks_read_their_input_once(stored, frozen):
    ranked = churn.risk_ranking(stored["subscribers"])
    assert sum(len(scans(p)) for p in frozen) == 1 and not scans(plan(ranked))
    (scan,) = scans(frozen[0])
    assert columns(scan) == {"customer_id", "contract", "tenure", "monthly_charges", "internet_service", "churn"}


def test_row_numbers_take_one_shuffle(stored, frozen, monkeypatch):
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet

    def record(writer, *args, **options):
        plans.append(plan(writer._df))
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    found = checks.assign_event_id(stored["events"])
    assert not frozen
    # The batch as it came, the rows in ranges, and the sizes of the ranges.
    arrived, ranged, slices = plans
    assert "Exchange" not in arrived and ranged.count("Exchange rangepartitioning") == 1
    assert "Aggregate" not in ranged and columns(scans(slices)[0]) == {"_spot"}
    assert "Exchange hashpartitioning" not in plan(found)


def test_derived_tables_are_written_once(spark, folder):
    before = testbed.funnel(spark, folder)
    again = testbed.funnel(spark, folder)
    assert again.events.inputFiles() == before.events.inputFiles()
    report = funnel.dropoff_users(again.users, again.events)
    assert sum("event_type" in scan for scan in scans(plan(report))) == 1
    assert testbed.flat_file(spark, folder).inputFiles() == testbed.flat_file(spark, folder).inputFiles()
    flat = testbed.sales_flat(spark, folder)
    assert sum("p_partkey" in scan for scan in scans(plan(flat))) == 1


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize(
    "report",
    [sales.category_rollup, sales.loss_products, sales.category_contribution,
     sales.vw_category_performance, sales.top_products, "split_star_products"],
)
def test_a_hot_product_is_split(spark, folder, tmp_path, monkeypatch, report):
    """With 80 % of the lines on one product, the join of lines and products is split."""
    for name in ("region", "nation", "customer", "part", "orders"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{folder}/{name}.parquet")
    lines = testbed.table(spark, folder, "lineitem")
    lines.withColumn(
        "l_partkey", F.when(F.col("l_orderkey") % 10 < 8, 7).otherwise(F.col("l_partkey"))
    ).repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    plans = []

    def run_and_record(frame, most):
        frame.collect()
        plans.append(plan(frame))
        return durable.hold(frame, most)

    monkeypatch.setattr(sales, "hold", run_and_record)
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        if report == "split_star_products":
            flat = testbed.sales_flat(spark, str(tmp_path))
            shown = star_schema.split_star_schema(flat).products
        else:
            area = testbed.sales(spark, str(tmp_path))
            shown = report(area.orders, area.products)
        shown.collect()
        plans.append(plan(shown))
    finally:
        for key in SKEW:
            spark.conf.unset(key)
    assert any("skew=true" in text for text in plans)


@pytest.mark.parametrize("report", [funnel.journey_report, funnel.dropoff_users, funnel.channel_funnel])
def test_funnel_reports_scan_events_once(stored, report):
    text = plan(report(stored["users"], stored["events"]))
    assert sum("event_type" in scan for scan in scans(text)) == 1


def test_funnel_summary_scans_events_once(stored):
    assert len(scans(plan(funnel.vw_funnel_summary(stored["events"])))) == 1


def test_top_rows_are_taken_per_partition(stored):
    assert "TakeOrderedAndProject" in plan(churn.top_at_risk(stored["subscribers"]))


def below_single_partition(text):
    """Columns that reach an exchange into one partition."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_ranks_never_sort_all_customers_in_one_task(stored):
    for report in (churn.risk_ranking, churn.charges_percentile, churn.vw_active_customer_risk):
        for line in below_single_partition(plan(report(stored["subscribers"]))):
            assert "customer_id" not in line and "keys=[_slice" in line


def test_ranks_join_by_shuffle_beyond_the_broadcast_limit(stored, monkeypatch):
    def ranked():
        return churn.risk_ranking(stored["subscribers"])

    small = ranked()
    assert "BroadcastHashJoin [coalesce(contract" in plan(small)
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 10)
    large = ranked()
    assert sorted(large.collect()) == sorted(small.collect())


def test_tile_scores_do_not_shuffle_the_customers(stored):
    text = plan(rfm.rfm_scores(rfm.rfm_base(stored["orders"])))
    assert "Exchange" not in text


def test_lines_are_summed_before_products_join(stored):
    text = plan(sales.vw_category_performance(stored["orders"], stored["products"]))
    join = text.index("Join")
    assert "partial_sum" in text[join:]
    assert "SinglePartition" in text  # the grand total over sub-categories


def test_no_python_workers(stored):
    for frame in (
        funnel.cohort_retention(stored["users"], stored["events"]),
        sales.monthly_revenue(stored["orders"]),
        churn.running_churn(stored["subscribers"]),
    ):
        assert "Python" not in plan(frame)


def test_display_order(spark, folder):
    import __spark_entry__ as registry
    from cohortry.plans.display import DISPLAY_ORDER, for_display

    queries = registry.queries()
    for name, wanted in DISPLAY_ORDER.items():
        assert name in queries and wanted
        report = queries[name](spark, folder)
        once = for_display(name, report).collect()
        again = for_display(name, report.repartition(5)).collect()
        assert once == again
        names = [c.removeprefix("-") for c in wanted]
        low = [min((r[c] for r in once if r[c] is not None), default=0) for c in names]
        keys = [[(r[c] is not None, low[k] if r[c] is None else r[c]) for k, c in enumerate(names)] for r in once]
        for column in reversed(range(len(names))):
            keys.sort(key=lambda row: row[column], reverse=wanted[column].startswith("-"))
        assert [[r[c] for c in names] for r in once] == [
            [value if there else None for there, value in row] for row in keys
        ]
    shown = for_display("churn_by_payment", queries["churn_by_payment"](spark, folder)).collect()
    rates = [r["churn_rate_pct"] for r in shown]
    assert rates == sorted(rates, reverse=True)
    quarters = [
        r["quarter_label"]
        for r in for_display("quarterly_yoy", queries["quarterly_yoy"](spark, folder)).collect()
    ]
    assert quarters == sorted(quarters, key=lambda q: (q[3:], q[1]))


def test_order_counts_do_not_shuffle_every_line(stored, monkeypatch):
    """Only lines of the top products reach the distinct count."""
    plans = []

    def record(frame, most):
        plans.append(plan(frame))
        return durable.hold(frame, most)

    monkeypatch.setattr(sales, "hold", record)
    shown = sales.top_products(stored["orders"], stored["products"])
    text = plans[-1]
    assert [columns(s) for s in scans(text) if "order_id" in s] == [{"product_id", "order_id"}]
    assert "SortMergeJoin" not in text and not scans(plan(shown))


def test_top_products_without_broadcast(stored, monkeypatch):
    expected = sales.top_products(stored["orders"], stored["products"]).collect()
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 0)
    assert sales.top_products(stored["orders"], stored["products"]).collect() == expected


def test_lines_of_the_flat_file_are_not_shuffled_by_buyer(spark, folder):
    """Orders get their buyer; with no broadcast the wide lines would be shuffled again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(testbed.sales_flat(spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert any("l_orderkey" in line for line in shuffled)
    assert not any("hashpartitioning(customer_id" in line for line in shuffled)


def test_each_split_report_stages_its_own_flat_file(spark, folder):
    from __spark_entry__ import queries

    first, second = (set(queries()["split_star_schema"](spark, folder).inputFiles()) for _ in range(2))
    assert first and second and not first & second
    assert all(name.endswith(".zstd.parquet") for name in first)


@pytest.mark.parametrize("name", ["customers", "products", "orders", "returns"])
def test_one_table_of_the_split_writes_no_flat_file(spark, folder, name):
    from __spark_entry__ import queries

    files = queries()[f"split_star_{name}"](spark, folder).inputFiles()
    assert files and all(f"{folder}/" in path for path in files)

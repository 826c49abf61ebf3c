import datetime as dt
import random

import pytest
from builders import make_events, make_orders
from pyspark.sql import functions as F

from cohortry.operators import funnel
from cohortry.plans.durable import shared_dir
from cohortry.plans.publishing import read_published
from cohortry.plans.views import (
    CHURN_VIEWS,
    FUNNEL_VIEWS,
    SALES_VIEWS,
    preview_view,
    publish_view,
    publish_views,
    register_views,
)
from cohortry.sources import checks, generate, load, testbed
from cohortry.sources.schemas import CHANNELS, SALES_FLAT, SALES_ORDERS, SUBSCRIBERS
from cohortry.sources.star_schema import save_star_schema, split_star_schema


def subscriber_line(**values):
    default = {"customer_id": "C1", "senior_citizen": "0", "tenure": "3", "monthly_charges": "50.25",
               "total_charges": "", "churn": "No"}
    row = {**default, **values}
    return ",".join(row.get(name, "No") for name in SUBSCRIBERS.fieldNames())


def write(tmp_path, *lines):
    path = tmp_path / "subscribers.csv"
    path.write_text("\n".join([",".join(SUBSCRIBERS.fieldNames()), *lines]) + "\n")
    return str(path)


def test_load_types_and_spelling(spark, tmp_path):
    path = write(
        tmp_path,
        subscriber_line(churn="yes", contract="MONTH-TO-MONTH "),
        subscriber_line(customer_id="C2", churn="Yes ", tech_support="no internet service"),
    )
    loaded = load.load_subscribers(spark, path)
    assert loaded.schema == SUBSCRIBERS
    first, second = loaded.orderBy("customer_id").collect()
    assert (first["churn"], first["contract"], first["total_charges"]) == ("Yes", "Month-to-month", None)
    assert (second["churn"], second["tech_support"]) == ("Yes", "No internet service")


def test_malformed_record_stops_the_load(spark, tmp_path):
    path = write(tmp_path, subscriber_line(tenure="three"))
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        load.load_subscribers(spark, path).collect()


def broken_file(tmp_path):
    good = [subscriber_line(customer_id=f"G{k}", churn="yes ", payment_method=["Card", "card"][k % 2]) for k in range(5)]
    bad = [
        subscriber_line(customer_id="B1", tenure="three"),
        subscriber_line(customer_id="B2", tenure="x", monthly_charges="free"),
        subscriber_line(customer_id="B3") + ",more",
        subscriber_line(customer_id="B4") + ",",
        "B5,Male,0",
        subscriber_line(customer_id="B6", total_charges="12345678901.00"),
        subscriber_line(customer_id="B7", multiple_lines='"a, ""b"""') + ",",
        subscriber_line(customer_id="B8", gender='"open'),
    ]
    return write(tmp_path, *good[:2], *bad, *good[2:]), bad


def test_malformed_lines_are_put_aside(spark, tmp_path):
    path, bad = broken_file(tmp_path)
    found = load.load_subscribers_with_rejects(spark, path)
    assert found.rows.schema == SUBSCRIBERS and (found.n_rows, found.n_rejected) == (5, 8)
    rows = {r["customer_id"]: r for r in found.rows.collect()}
    assert set(rows) == {f"G{k}" for k in range(5)} and {r["churn"] for r in rows.values()} == {"Yes"}
    assert {r["payment_method"] for r in rows.values()} == {"Card"}
    rejected = {r["line"]: r for r in found.rejected.collect()}
    assert set(rejected) == set(bad) and all("subscribers.csv" in r["file"] for r in rejected.values())
    assert [rejected[line]["reason"] for line in bad] == [
        "tenure: not int", "tenure: not int; monthly_charges: not decimal(8,2)", "too many values",
        "too many values", "too few values", "total_charges: not decimal(10,2)", "too many values", "open quote",
    ]
    counts = {r["reason"]: r["lines"] for r in found.reasons().collect()}
    assert counts["too many values"] == 3 and sum(counts.values()) == 8
    # Nothing reads the text again.
    for frame in (found.rows, found.rejected, found.reasons()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "parquet" in plan.lower() and "csv" not in plan.replace("from_csv", "").replace(path, "").lower()


def test_rejected_lines_are_published(spark, tmp_path):
    path, bad = broken_file(tmp_path)
    load.load_subscribers_with_rejects(spark, path).publish_rejected(str(tmp_path / "out"))
    lines = read_published(spark, str(tmp_path / "out"), "rejected_lines")
    assert {r["line"] for r in lines.collect()} == set(bad)


def test_a_load_may_allow_few_malformed_lines(spark, tmp_path):
    path, _ = broken_file(tmp_path)
    assert load.load_subscribers_with_rejects(spark, path, max_rejected=8).n_rejected == 8
    with pytest.raises(load.TooManyRejected, match="8 malformed lines"):
        load.load_subscribers_with_rejects(spark, path, max_rejected=7)
    clean = write(tmp_path, subscriber_line())
    found = load.load_subscribers_with_rejects(spark, clean, max_rejected=0)
    assert found.rows.count() == 1 and found.rejected.collect() == [] == found.reasons().collect()
    assert sorted(map(tuple, found.rows.collect())) == sorted(map(tuple, load.load_subscribers(spark, clean).collect()))


def test_a_strict_load_parses_the_text_once(spark, tmp_path):
    loaded = load.load_subscribers(spark, write(tmp_path, subscriber_line()))
    assert "FileScan csv" not in loaded._jdf.queryExecution().executedPlan().toString()


def test_malformed_sales_lines(spark, tmp_path):
    path = tmp_path / "sales.csv"
    good = "O1,2017-01-02,2017-01-05,second class ,C1,P1,12.50,2,0.20,-1.25,Ann,Consumer,East,Ohio,Akron,Tools,Saws,Saw,yes"
    path.write_text("\n".join([",".join(SALES_FLAT.fieldNames()), good, good.replace("2017-01-05", "2017-13-05"),
                               good.replace("12.50,2", "12.50,two")]) + "\n")
    found = load.load_sales_flat_with_rejects(spark, str(path))
    assert found.n_rows == 1 and found.rows.first()["ship_mode"] == "Second Class"
    assert {r["reason"] for r in found.rejected.collect()} == {"ship_date: not date", "quantity: not int"}


def test_canonical_keeps_unknown_values(spark):
    frame = spark.createDataFrame([("first class ",), ("Drone ",), (None,)], "ship_mode STRING")
    assert [r[0] for r in load.normalise_orders(frame).collect()] == ["First Class", "Drone", None]


def test_star_schema_conflicts(spark):
    orders = make_orders(spark, [{}, {"order_id": "O2"}, {"order_id": "O3", "customer_id": "C2"}])
    flat = orders.selectExpr(
        "*",
        "if(order_id = 'O2', 'Zed', 'Ann') AS customer_name", "'Consumer' AS segment",
        "'N' AS region", "'S' AS state", "'T' AS city", "'A' AS category", "'x' AS sub_category",
        "'pen' AS product_name", "if(order_id = 'O3', 'Yes', NULL) AS returned",
    )
    star = split_star_schema(flat)
    assert {r["table_name"]: (r["keys"], r["conflicting_keys"]) for r in star.conflicts.collect()} == {
        "customers": (2, 1), "products": (1, 0),
    }
    assert {r["customer_id"]: r["customer_name"] for r in star.customers.collect()} == {
        "C1": "Ann", "C2": "Ann",
    }
    assert [tuple(r) for r in star.returns.collect()] == [("O3", "Yes")]
    assert star.orders.count() == 3


def test_flat_sales_file(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        ",".join(SALES_FLAT.fieldNames())
        + "\nO1,2017-01-02,2017-01-05,second class ,C1,P1,12.50,2,0.20,-1.25,"
        + "Ann,Consumer,East,Ohio,Akron,Tools,Saws,Saw,yes\n"
    )
    star = split_star_schema(load.load_sales_flat(spark, str(path)))
    order = star.orders.first()
    assert (order["ship_mode"], order["order_date"]) == ("Second Class", dt.date(2017, 1, 2))
    assert star.orders.schema == SALES_ORDERS
    assert [tuple(r) for r in star.products.collect()] == [("P1", "Tools", "Saws", "Saw")]
    assert [tuple(r) for r in star.returns.collect()] == [("O1", "Yes")]


def test_saved_orders_are_in_date_ranges(spark, folder, tmp_path):
    star = split_star_schema(testbed.sales_flat(spark, folder))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        save_star_schema(star, str(tmp_path))
    finally:
        spark.conf.set(coalesce, "true")
    orders = spark.read.parquet(str(tmp_path / "orders"))
    assert orders.count() == star.orders.count()
    ranges = (
        orders.groupBy(F.input_file_name().alias("file"))
        .agg(F.min("order_date").alias("low"), F.max("order_date").alias("high"))
        .orderBy("low", "high")
        .collect()
    )
    assert len(ranges) > 4
    assert all(a["high"] <= b["low"] for a, b in zip(ranges, ranges[1:]))
    for name in ("customers", "products", "returns"):
        assert spark.read.parquet(str(tmp_path / name)).count() > 0


def test_generated_users_do_not_depend_on_partitions(spark):
    once = generate.generate_users(spark, 1000, seed=3)
    again = generate.users_from_ids(once.select("user_id").repartition(7), seed=3)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    assert once.agg(F.min("signup_date")).first()[0] >= dt.date(2023, 1, 2)
    assert once.agg(F.max("signup_date")).first()[0] <= dt.date(2024, 1, 1)
    counts = {r["channel"]: r["count"] for r in once.groupBy("channel").count().collect()}
    assert set(counts) == set(CHANNELS) and min(counts.values()) > 140
    other = generate.generate_users(spark, 1000, seed=4)
    assert sorted(map(tuple, once.collect())) != sorted(map(tuple, other.collect()))


def test_generated_funnel(spark):
    users = generate.generate_users(spark, 5000).cache()
    events = generate.generate_stage_events(users).cache()
    counts = {r["event_type"]: r["cnt"] for r in funnel.event_type_counts(events).collect()}
    assert counts["signed_up"] == 5000
    for stage, expected in (("completed_onboarding", 3600), ("first_purchase", 1620), ("second_purchase", 648)):
        assert abs(counts[stage] - expected) < 0.1 * expected
    row = funnel.cohort_retention(users, events).agg(
        F.sum("purchased_in_30d").alias("a"), F.sum("purchased_in_90d").alias("b")
    ).first()
    assert row["a"] == row["b"] == counts["first_purchase"]
    gaps = funnel.time_to_convert(users, events).agg(F.min("fastest_days"), F.max("slowest_days")).first()
    assert gaps[0] >= 2 and gaps[1] <= 17


def test_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "a")], "k INT, v STRING")
    row = checks.check_primary_key(frame, "t", ["k"]).first()
    assert tuple(row) == ("t", 4, 1, 1, 2)
    assert [tuple(r) for r in checks.duplicate_keys(frame, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "p INT")
    assert tuple(checks.check_foreign_key(frame, "k", parent, "p", "f").first()) == ("f", 1, 1)
    rows = checks.check_domain(frame, "t", {"v": ("a", "b"), "k": (1,)}).collect()
    assert [tuple(r) for r in rows] == [("t", "v", 1, 0), ("t", "k", 1, 1)]


def test_event_ids_are_dense(spark):
    events = make_events(spark, [(1, "signed_up", "2023-01-01")] * 5 + [(2, "signed_up", None)])
    ids = sorted(r["event_id"] for r in checks.assign_event_id(events).collect())
    assert ids == [1, 2, 3, 4, 5, 6]


def by_hand(log):
    """Stage times per user, one event at a time."""
    found = {}
    for user in {u for _, u, _, _ in log}:
        mine = sorted((t, k) for _, u, k, t in log if u == user)
        signups = [t for t, k in mine if k == "signup"]
        if not signups:
            continue
        times = [signups[0]]
        for kind, days in (("view", 3), ("purchase", 2), ("purchase", 2)):
            later = [
                t for t, k in mine
                if k == kind and times[-1] < t <= times[-1] + dt.timedelta(days=days)
            ]
            if not later:
                break
            times.append(later[0])
        shift = dt.timedelta(days=user * 7 % 364)
        for stage, moment in zip(funnel.STAGES, times):
            found[user, stage] = moment.date() + shift
    return found


@pytest.mark.parametrize("slice_rows", [10, 1_000_000])
def test_stage_times_with_hot_users(spark, slice_rows):
    """A third of the log belongs to one user; slices must not change the result."""
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    log = [
        (
            i,
            1 if i % 3 == 0 else rnd.randrange(2, 40),
            rnd.choice(["signup", "view", "purchase", "click", "error"]),
            start + dt.timedelta(minutes=rnd.randrange(30 * 24 * 60)),
        )
        for i in range(1500)
    ]
    frame = spark.createDataFrame(
        log, "event_id BIGINT, user_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ"
    )
    found = {
        (r["user_id"], r["event_type"]): r["event_date"]
        for r in testbed.funnel_events(frame, slice_rows).collect()
    }
    assert found == by_hand(log)


def test_views_register_and_publish(spark, folder, tmp_path):
    names = register_views(CHURN_VIEWS, testbed.subscribers(spark, folder))
    names += register_views(SALES_VIEWS, testbed.sales(spark, folder))
    names += register_views(FUNNEL_VIEWS, testbed.funnel(spark, folder))
    assert len(names) == 15
    for name in names:
        assert 0 < preview_view(spark, name, 3).count() <= 3
    view = spark.table("vw_channel_conversion")
    path = str(tmp_path / "view")
    for _ in range(2):
        written = publish_view(view, path, partition_by="channel")
    assert written.count() == view.count()
    names = publish_views(CHURN_VIEWS, testbed.subscribers(spark, folder), str(tmp_path))
    for name in names:
        assert read_published(spark, str(tmp_path), name).count() == spark.table(name).count()


def test_group_keys_have_one_spelling(spark, tmp_path):
    path = write(
        tmp_path,
        *[subscriber_line(customer_id=f"C{k}", payment_method=p)
          for k, p in enumerate(["Mailed check", "mailed check  ", "Mailed check", "MAILED CHECK", "Card", "card"])],
        subscriber_line(customer_id="C9", payment_method='"Bank, ""auto"""', internet_service="dsl"),
    )
    loaded = load.load_subscribers(spark, path)
    found = {r["customer_id"]: r["payment_method"] for r in loaded.collect()}
    assert [found[f"C{k}"] for k in range(6)] == ["Mailed check"] * 4 + ["card"] * 2
    assert loaded.schema == SUBSCRIBERS and loaded.count() == 7


def test_users_and_events_are_respelled(spark):
    users = spark.createDataFrame([("ORGANIC ", "New", "Mobile"), (None, "x ", "tablet")], "channel STRING, segment STRING, device STRING")
    assert [tuple(r) for r in load.normalise_users(users).collect()] == [("organic", "new", "mobile"), (None, "x", "tablet")]
    events = spark.createDataFrame([("Signed_Up",), ("other ",)], "event_type STRING")
    assert [r[0] for r in load.normalise_events(events).collect()] == ["signed_up", "other"]


def test_dropoff_matrix_holds_all_users(spark, folder):
    from cohortry.operators import dashboard

    data = testbed.funnel(spark, folder)
    matrix = dashboard.dropoff_by_device(data.users, data.events).collect()
    stages = funnel.dropoff_users(data.users, data.events).collect()
    assert sum(sum(r[1:]) for r in matrix) == sum(r["user_count"] for r in stages) == data.users.count()
    assert sum(r["unknown"] for r in matrix) > 0


def test_scratch_is_released(spark):
    import os

    from cohortry.plans.durable import release_scratch, scratch_path

    release_scratch(spark)
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path) and release_scratch(spark) == 1 and not os.path.exists(path)


class Unconfigured:
    """A cluster session that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_its_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    for master in ("spark://somewhere:7077", "local-cluster[2,1,1024]", "yarn"):
        Unconfigured.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Unconfigured)


def test_the_flat_text_is_compressed_in_bounded_files(spark, folder, monkeypatch):
    import __spark_entry__ as entry

    seen = []

    def load_and_note(session, path):
        seen.append(session.read.text(path).select(F.input_file_name().alias("file")))
        return load_flat(session, path)

    load_flat = load.load_sales_flat
    monkeypatch.setattr(load, "load_sales_flat", load_and_note)
    monkeypatch.setattr(entry, "FILE_LINES", 5_000, raising=False)
    loaded = entry.load_sales_flat(spark, folder)
    lines = {r["file"]: r["count"] for r in seen[0].groupBy("file").count().collect()}
    assert all(name.endswith(".csv.gz") for name in lines)
    assert max(lines.values()) <= 5_001 and sum(lines.values()) - len(lines) == loaded.count()
    assert loaded.inputFiles() and all(name.endswith(".zstd.parquet") for name in loaded.inputFiles())

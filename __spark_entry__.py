
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortry.operators import churn, dashboard, funnel, rfm, sales  # noqa: E402
from cohortry.plans import publishing  # noqa: E402
from cohortry.plans.distinct_sets import SalesSets  # noqa: E402
from cohortry.plans.durable import scratch_path  # noqa: E402
from cohortry.plans.order_index import OrderIndex  # noqa: E402
from cohortry.plans.sql_functions import register_functions  # noqa: E402
from cohortry.plans.user_state import UserState  # noqa: E402
from cohortry.plans.views import (  # noqa: E402
    CHURN_VIEWS,
    FUNNEL_VIEWS,
    SALES_VIEWS,
    preview_view,
    publish_view,
    publish_views,
    register_views,
)
from cohortry.sources import checks, generate, load, testbed  # noqa: E402
from cohortry.sources.schemas import (  # noqa: E402
    BUYER_SEGMENTS,
    EVENT_DOMAINS,
    SALES_FLAT,
    SUBSCRIBER_DOMAINS,
    SUBSCRIBERS,
    USER_DOMAINS,
)
from cohortry.sources.star_schema import split_star_schema, stage_flat  # noqa: E402
from oracles import ORACLES  # noqa: E402

try:  # the corpus operators may be left out of an installation
    import corpus_pipeline
    from cohortry.llm import queries as llm
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "cohortry.llm"):
        raise
    llm = corpus_pipeline = None

SEED = 7
# Most lines of a compressed text file.
FILE_LINES = 500_000
Query = Callable[[SparkSession, str], DataFrame]


def portable(frame: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and dates as text, for comparing with another engine."""
    columns = []
    for field in frame.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, DateType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def over_subscribers(build) -> Query:
    return lambda spark, folder: portable(build(testbed.subscribers(spark, folder)))


def over_sales(build, with_profit: bool = True) -> Query:
    return lambda spark, folder: portable(build(testbed.sales(spark, folder, with_profit)))


def over_funnel(build) -> Query:
    return lambda spark, folder: portable(build(testbed.funnel(spark, folder)))


def over_folder(build) -> Query:
    return lambda spark, folder: portable(build(spark, folder))


def load_subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """Write the subscribers as an oddly spelled delimited file, then load that file."""
    path = scratch_path(spark, "subscribers")
    odd = testbed.subscribers(spark, folder).selectExpr(
        "* EXCEPT (contract, churn, payment_method, internet_service)",
        "IF(customer_id % 3 = 0, concat(upper(contract), '  '), contract) AS contract",
        "IF(customer_id % 5 = 0, lower(churn), churn) AS churn",
        "IF(customer_id % 13 = 0, concat(upper(payment_method), ' '), payment_method) AS payment_method",
        "IF(customer_id % 16 = 0, lower(internet_service), internet_service) AS internet_service",
    ).select(*SUBSCRIBERS.fieldNames())
    odd.write.csv(path, header=True, ignoreTrailingWhiteSpace=False)
    return load.load_subscribers(spark, path)


def load_broken_subscribers(spark: SparkSession, folder: str) -> load.Load:
    """Write subscribers with some malformed lines, and load that file."""
    path = scratch_path(spark, "broken")
    wrong = testbed.subscribers(spark, folder).selectExpr(
        "* EXCEPT (tenure, monthly_charges)",
        "CASE WHEN customer_id % 50 IN (9, 10) THEN 'n/a' ELSE CAST(tenure AS STRING) END AS tenure",
        "CASE WHEN customer_id % 50 = 10 THEN 'free' ELSE CAST(monthly_charges AS STRING) END AS monthly_charges",
    ).select(*SUBSCRIBERS.fieldNames())
    lines = wrong.select("customer_id", F.to_csv(F.struct("*")).alias("line")).selectExpr(
        """CASE customer_id % 50 WHEN 7 THEN concat(line, ',') WHEN 8 THEN substring_index(line, ',', 5)
           ELSE line END AS value"""
    )
    lines.write.text(path)
    return load.load_subscribers_with_rejects(spark, path, header=False)


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected lines per reason, and the rows that were loaded, as published."""
    path = scratch_path(spark, "rejected")
    loaded = load_broken_subscribers(spark, folder)
    loaded.publish_rejected(path)
    kept = loaded.rows.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("lines"))
    return publishing.read_published(spark, path, "rejected_reasons").unionByName(kept)


def load_sales_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Write the flat sales file with odd spellings, then load that file.

    The text is gzipped, as every line repeats its buyer and product.  A gzipped file
    is read by one task, so no file gets more than ``FILE_LINES`` lines.
    """
    path = scratch_path(spark, "sales")
    odd = testbed.sales_flat(spark, folder).selectExpr(
        "* EXCEPT (region, category, ship_mode)",
        "IF(order_id % 11 = 0, concat(lower(region), ' '), region) AS region",
        "IF(order_id % 13 = 0, lower(category), category) AS category",
        "IF(order_id % 2 = 0, upper(ship_mode), ship_mode) AS ship_mode",
    ).select(*SALES_FLAT.fieldNames())
    odd.write.option("maxRecordsPerFile", FILE_LINES).csv(
        path, header=True, ignoreTrailingWhiteSpace=False, compression="gzip"
    )
    return load.load_sales_flat(spark, path)


def split_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table of the split flat file, and keys with conflicting names.

    All tables are read, so the flat file is staged, by each call for itself: what
    a call costs does not depend on which ran before.
    """
    star = split_star_schema(
        stage_flat(testbed.sales_flat(spark, folder), scratch_path(spark, "flat"))
    )
    plain = [
        frame.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(None).cast("bigint").alias("conflicting_keys"),
        )
        for name, frame in (("orders", star.orders), ("returns", star.returns))
    ]
    return reduce(DataFrame.unionByName, plain, star.conflicts.withColumnRenamed("keys", "row_count"))


def split_part(name: str) -> Query:
    """One table of the split.  The flat lines are read once, so they are not staged."""
    return over_folder(
        lambda spark, folder: getattr(split_star_schema(testbed.sales_flat(spark, folder)), name)
    )


def continued_event_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the events of the first half year, then of the later ones.

    The first batch is delivered twice.
    """
    events = testbed.funnel(spark, folder).events
    table = checks.event_table(spark, scratch_path(spark, "numbered"))
    early = events.where("event_date < DATE'2024-07-01'")
    table.append(early, "first half")
    table.append(events.where("event_date >= DATE'2024-07-01'"), "second half")
    table.append(early, "first half")
    return table.read()


def merged_journeys(spark: SparkSession, folder: str) -> DataFrame:
    """The journey report over stored users and a state that was merged in three parts.

    The first part is merged again at the end, as a repeated delivery would be.
    """
    data = testbed.funnel(spark, folder)
    state = UserState(spark, scratch_path(spark, "state"), buckets=8)
    state.set_users(data.users)
    parts = ("event_date < DATE'2024-04-01'", "event_date >= DATE'2024-09-01'",
             "event_date BETWEEN DATE'2024-04-01' AND DATE'2024-08-31'")
    for part in (*parts, parts[0]):
        state.merge(data.events.where(part))
    return funnel.journey_report(state.users(), state.stages())


def ranks_after_inserts(spark: SparkSession, folder: str) -> DataFrame:
    """The risk ranking from an index of a third of the customers and two inserts."""
    active = testbed.subscribers(spark, folder).where("churn = 'No'").select(
        "customer_id", "contract", "tenure", "monthly_charges", "internet_service"
    )
    index = OrderIndex(
        spark, scratch_path(spark, "order-index"), churn.RISK_ORDER,
        {"risk_rank_within_contract": ["contract"], "overall_risk_rank": []}, ranges=16,
    )
    index.build(active.where("customer_id % 3 = 0"))
    for part in (1, 2):
        index.insert(active.where(f"customer_id % 3 = {part}"))
    return index.rank(active)


def over_sets(build) -> Query:
    """A report over sets that were built from the order lines in three deliveries.

    The first delivery comes twice.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = testbed.sales(spark, folder)
        sets = SalesSets(spark, scratch_path(spark, "sets"))
        parts = ("order_date < DATE'1995-05-17'", "order_date >= DATE'1998-01-01'",
                 "order_date BETWEEN DATE'1995-05-17' AND DATE'1997-12-31'")
        for n in (0, 1, 2, 0):
            sets.append(tables.orders.where(parts[n]), tables.customers, f"delivery {n}")
        return portable(build(sets))

    return run


def report_from_sql(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark, testbed.sales(spark, folder).orders)
    return spark.sql("SELECT * FROM monthly_kpi_report(2000, 11)")


def months_from_sql(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark, testbed.sales(spark, folder).orders)
    return spark.sql("SELECT * FROM kpi_by_month(DATE'1992-01-01', DATE'2002-12-31')")


def published(spark: SparkSession, folder: str) -> DataFrame:
    view = churn.vw_churn_by_contract(testbed.subscribers(spark, folder))
    return publish_view(view, scratch_path(spark, "vw_churn_by_contract"))


def replaced_view(spark: SparkSession, folder: str) -> DataFrame:
    """A reader of version 1, and one of version 2 that was published meanwhile.

    Between the two a publish fails, which leaves no version.
    """
    path, name = scratch_path(spark, "replaced"), "vw_churn_by_contract"
    people = testbed.subscribers(spark, folder)
    publishing.publish({name: churn.vw_churn_by_contract(people)}, path)
    early = publishing.read_published(spark, path, name)
    later = churn.vw_churn_by_contract(people.where("tenure > 12"))
    broken = later.withColumn("contract", F.raise_error("a source went away").cast("string"))
    try:
        publishing.publish({name: broken}, path)
    except Exception as failed:
        if "a source went away" not in str(failed):
            raise
    publishing.publish({name: later}, path)
    late = publishing.read_published(spark, path, name)
    found = publishing.current_version(spark, path).number
    return early.selectExpr("1 AS version", "*").unionByName(late.selectExpr(f"{found} AS version", "*"))


def published_views(views, tables) -> Query:
    """Publish all views of an area and count the rows of what was written."""

    def counts(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_path(spark, "views")
        names = publish_views(views, tables(spark, folder), path)
        written = [
            publishing.read_published(spark, path, name).agg(
                F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("row_count")
            )
            for name in names
        ]
        return reduce(DataFrame.unionByName, written)

    return counts


def previewed(spark: SparkSession, folder: str) -> DataFrame:
    name = "vw_churn_kpi_summary"
    register_views({name: CHURN_VIEWS[name]}, testbed.subscribers(spark, folder))
    return preview_view(spark, name, 5)


def generated_users(spark: SparkSession, folder: str) -> DataFrame:
    ids = testbed.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return generate.users_from_ids(ids, SEED)


def generated_events(spark: SparkSession, folder: str) -> DataFrame:
    return generate.generate_stage_events(generated_users(spark, folder), SEED)


def primary_keys(spark: SparkSession, folder: str) -> DataFrame:
    tables = testbed.sales(spark, folder, with_profit=False)
    lines = testbed.table(spark, folder, "lineitem")
    found = (
        (testbed.subscribers(spark, folder), "subscribers", ["customer_id"]),
        (tables.customers, "sales.customers", ["customer_id"]),
        (tables.products, "sales.products", ["product_id"]),
        (testbed.funnel(spark, folder).users, "funnel.users", ["user_id"]),
        (lines, "order lines", ["l_orderkey", "l_linenumber"]),
    )
    return reduce(DataFrame.unionByName, [checks.check_primary_key(*entry) for entry in found])


def foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, lines, part, events = (
        testbed.table(spark, folder, name)
        for name in ("customer", "orders", "lineitem", "part", "events")
    )
    users = testbed.funnel(spark, folder).users
    found = (
        (orders, "o_custkey", customer, "c_custkey", "orders.customer_id"),
        (lines, "l_partkey", part, "p_partkey", "orders.product_id"),
        (events, "user_id", users, "user_id", "events.user_id"),
    )
    return reduce(DataFrame.unionByName, [checks.check_foreign_key(*entry) for entry in found])


def domains(spark: SparkSession, folder: str) -> DataFrame:
    data = testbed.funnel(spark, folder)
    buyers = testbed.sales_customers(spark, folder)
    found = (
        (testbed.subscribers(spark, folder), "subscribers", SUBSCRIBER_DOMAINS),
        (buyers, "sales.customers", {"segment": BUYER_SEGMENTS}),
        (data.users, "funnel.users", USER_DOMAINS),
        (data.events, "funnel.events", EVENT_DOMAINS),
    )
    return reduce(DataFrame.unionByName, [checks.check_domain(*entry) for entry in found])


SUBSCRIBER_QUERIES = (
    churn.churn_overall, churn.churn_profile, churn.churn_by_contract, churn.churn_by_payment,
    churn.churn_by_internet, churn.high_value_churned, churn.risk_segment, churn.cohort_tenure,
    churn.contract_cohort, churn.running_churn, churn.risk_ranking, churn.charges_percentile,
    churn.churn_month_lag, churn.vw_churn_kpi_summary, churn.vw_churn_by_contract,
    churn.vw_cohort_retention, churn.vw_churn_by_payment, churn.vw_active_customer_risk,
    churn.vw_churn_drivers, churn.top_at_risk, dashboard.kpi_retention_rate,
    dashboard.kpi_highest_risk_segment, dashboard.cohort_risk_badge,
    dashboard.churn_by_6m_tenure, dashboard.driver_matrix,
)

ORDER_QUERIES = (
    sales.monthly_revenue, sales.vw_monthly_revenue_trend, sales.quarterly_yoy,
    sales.discount_impact, sales.vw_discount_impact, sales.sales_kpi_summary,
)

PRODUCT_QUERIES = (
    sales.top_products, sales.loss_products, sales.category_contribution,
    sales.vw_category_performance, sales.category_rollup,
)

RFM_QUERIES = (
    rfm.rfm_base, rfm.vw_rfm_segments, rfm.rfm_segment_summary, rfm.rfm_segment_share,
)

EVENT_QUERIES = (
    funnel.event_type_counts, funnel.funnel_overall, funnel.vw_funnel_summary,
    funnel.funnel_summary_ordered, dashboard.funnel_step_drop, dashboard.biggest_dropoff,
    checks.assign_event_id,
)

USER_QUERIES = (
    funnel.channel_funnel, funnel.device_funnel, funnel.time_to_convert,
    funnel.cohort_retention, funnel.dropoff_users, funnel.journey_report,
    funnel.vw_channel_conversion, funnel.vw_cohort_matrix, funnel.vw_dropoff_by_stage,
    funnel.cohort_matrix_first, dashboard.dropoff_by_device, dashboard.cohort_heat_band,
)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue with growth and a rolling mean."""
    return queries()["monthly_revenue"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator; each callable takes (spark, folder)."""
    found: dict[str, Query] = {}

    def add(functions, wrap) -> None:
        for function in functions:
            found[function.__name__] = wrap(function)

    add(SUBSCRIBER_QUERIES, over_subscribers)
    add(ORDER_QUERIES, lambda f: over_sales(lambda t: f(t.orders)))
    add(PRODUCT_QUERIES, lambda f: over_sales(lambda t: f(t.orders, t.products)))
    add(
        (sales.regional_performance, sales.vw_regional_kpi),
        lambda f: over_sales(lambda t: f(t.orders, t.customers)),
    )
    add((sales.shipping_performance,), lambda f: over_sales(lambda t: f(t.orders), False))
    add(RFM_QUERIES, lambda f: over_sales(lambda t: f(t.orders, testbed.AS_OF), False))
    add(
        (rfm.rfm_customers,),
        lambda f: over_sales(lambda t: f(t.orders, t.customers, testbed.AS_OF), False),
    )
    add(
        (sales.monthly_kpi_report,), lambda f: over_sales(lambda t: f(t.orders, 2000, 11))
    )
    add(EVENT_QUERIES, lambda f: over_funnel(lambda t: f(t.events)))
    add(USER_QUERIES, lambda f: over_funnel(lambda t: f(t.users, t.events)))
    found.update(
        {
            "load_subscribers": over_folder(load_subscribers),
            "load_subscribers_with_rejects": over_folder(
                lambda spark, folder: load_broken_subscribers(spark, folder).rows
            ),
            "merge_user_state": over_folder(merged_journeys),
            "sql_monthly_kpi_report": over_folder(report_from_sql),
            "sql_kpi_by_month": over_folder(months_from_sql),
            "monthly_revenue_from_sets": over_sets(sales.monthly_revenue_from_sets),
            "quarterly_customers": over_sets(sales.quarterly_customers),
            "regional_performance_from_sets": over_sets(sales.regional_performance_from_sets),
            "ranks_after_inserts": over_folder(ranks_after_inserts),
            "continue_event_ids": over_folder(continued_event_ids),
            "rejected_lines": over_folder(rejected_lines),
            "split_star_schema": over_folder(split_report),
            "split_star_customers": split_part("customers"),
            "split_star_products": split_part("products"),
            "split_star_returns": split_part("returns"),
            "split_star_orders": split_part("orders"),
            "load_sales_flat": over_folder(load_sales_flat),
            "publish_churn_views": published_views(CHURN_VIEWS, testbed.subscribers),
            "publish_sales_views": published_views(SALES_VIEWS, testbed.sales),
            "publish_funnel_views": published_views(FUNNEL_VIEWS, testbed.funnel),
            "generate_users": over_folder(generated_users),
            "generate_stage_events": over_folder(generated_events),
            "check_primary_key": over_folder(primary_keys),
            "check_foreign_key": over_folder(foreign_keys),
            "check_domain": over_folder(domains),
            "publish_view": over_folder(published),
            "replace_published_view": over_folder(replaced_view),
            "preview_view": over_folder(previewed),
        }
    )
    if llm is not None:
        found.update(llm.QUERIES)
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """The DuckDB statement for each query that SQL can express."""
    return {**ORACLES, **(llm.ORACLES if llm is not None else {})}

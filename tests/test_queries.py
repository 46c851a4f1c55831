"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest
from checks import jobs, oracle
from checks.compare import database, difference

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: entry.queries()[name] for name in jobs.names()}
SQL = {name: oracle.oracle(name) for name in jobs.names()}


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


# Empty at the smallest scale: all its customers buy, and all its campaigns have a reference row.
MAY_BE_EMPTY = {"non_buyers", "campaigns_without_reference"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(name, spark, connection):
    df = QUERIES[name](spark, FOLDER)
    found = difference(df, connection, SQL[name])
    assert not found or (name in MAY_BE_EMPTY and found == "both sides are empty"), found
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan


FACT_JOBS = [
    "order_items_cube", "authorized_orders", "order_cardinal", "months_since_first", "campaign_items", "packaging_share",
    "fulfilment_share", "payment_fee", "days_since_previous_order", "rfm_score", "delivery_dates", "channel_orders",
]


@pytest.mark.parametrize("name", FACT_JOBS)
def test_fact_jobs_have_no_global_window_or_nested_loop(name, spark):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "Window [" in line:
            assert "windowspecdefinition(" in line and "], []" not in line, line


def test_order_numbers_never_sort_a_whole_customer_or_day(spark):
    plan = QUERIES["order_cardinal"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    over_rows = [line for line in windows if "__in__hit_cardinal" in line]
    assert over_rows and all("__part" in line.split("], [")[1] for line in over_rows)


def test_product_labels_need_few_exchanges(spark):
    """The product table is read twice; the other two scans make the tag and brand tables of the test data."""
    plan = QUERIES["products_dimension"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 6 and plan.count("FileScan") <= 4


def test_costs_join_without_a_shuffle_on_the_order(spark):
    """After the first stage the bucketed tables are joined as they lie, also where nothing can be broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["order_margin"](spark, FOLDER)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(order_id" not in plan and plan.count("Bucketed: true") >= 5, plan


UNIT_JOBS = ["shipping_adjust", "item_cost", "frozen_order_cost", "taxes", "fulfilment_share", "contribution_margin", "real_freight"]


@pytest.mark.parametrize("name", UNIT_JOBS)
def test_unit_sheets_need_no_cross_product(name, spark):
    """Also where nothing can be broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_landed_filter_reaches_the_scan(spark):
    plan = QUERIES["landed_orders"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(state, [captured,delivered])]" in plan
    assert "ReadSchema: struct<id:bigint,user_id:bigint,created_at:timestamp,state:string,cached_total_value:" in plan or (
        "credit_card_operator" not in plan.split("ReadSchema")[1].splitlines()[0])

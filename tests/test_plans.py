"""The physical plans must keep the shape the operators were designed for."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import facts, integrity, quality, retail as ops
from ledgerloom.plans import QUERIES
from ledgerloom.sources import bindings

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture(scope="module")
def shop_files(spark):
    return bindings.retail(spark, FOLDER)


@pytest.fixture
def no_broadcast(spark):
    """Sides beyond the broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scans_are_pruned_and_filtered(shop_files):
    plan = plan_of(ops.kpi_row(facts.sales_fact(shop_files)))
    assert "In(o_orderstatus, [F,O])" in plan
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan


def test_slices_reach_the_scans(shop_files):
    sliced = facts.filter_sales(facts.sales_fact(shop_files), "1996-01-01", "1997-01-01", ["ECONOMY"])
    plan = plan_of(ops.kpi_row(sliced))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "EqualTo(p_type,ECONOMY)" in plan


def test_small_dimensions_are_broadcast_by_size_only(shop_files, spark):
    plan = plan_of(facts.sales_fact(shop_files))
    assert plan.count("BroadcastHashJoin") >= 2


def test_large_dimensions_are_shuffled(shop_files, no_broadcast):
    plan = plan_of(facts.sales_fact(shop_files))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3


def test_orphans_use_anti_joins(shop_files, no_broadcast):
    assert "LeftAnti" in plan_of(integrity.orphan_items(shop_files.items, shop_files.orders))


def test_distinct_orders_need_no_join(shop_files):
    frame = facts.quality_fact(shop_files)
    assert "Join" not in plan_of(frame.agg(F.countDistinct("order_id")))


def test_metrics_read_the_table_once(spark):
    cards = bindings.cards(spark, FOLDER)
    plan = plan_of(quality.measure(cards, F.lit("2024-01-01").cast("timestamp_ntz")))
    assert plan.count("FileScan") == 1


ROWS_IN_PYTHON = {"sales_forecast", "sales_forecast_by_theme", "sales_forecast_by_model"}


@pytest.mark.parametrize(
    "name",
    [
        n
        for n in QUERIES
        if not n.startswith("stream_")
        and n not in ("customer_clusters", "value_by_cluster", "partitioned_against_plain", "clustered_table")
    ],
)
def test_no_cartesian_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name].run(spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert ("Python" in plan or "Pandas" in plan) == (name in ROWS_IN_PYTHON)


def test_windows_without_keys_follow_an_aggregation(spark):
    """A window in one task is allowed only over one row per day or per partition."""
    for name in QUERIES:
        if name in ("customer_clusters", "value_by_cluster") or name.startswith("stream_"):
            continue
        if name in ("partitioned_against_plain", "clustered_table"):
            continue
        plan = plan_of(QUERIES[name].run(spark, FOLDER))
        for spec in re.findall(r"windowspecdefinition\(([^()]*)", plan):
            if spec.split(" ")[0] in ("day", "_part"):
                continue
            assert "ASC" not in spec.split(",")[0] and "DESC" not in spec.split(",")[0], (name, spec)

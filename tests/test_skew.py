"""One key holds a large share of the rows: results stay whole, and the hot key is split."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import facts, integrity, retail as ops, rfm
from ledgerloom.sources import sinks
from ledgerloom.sources.bindings import Retail

ROWS = 200_000


@pytest.fixture(scope="module")
def hot_shop(spark, tmp_path_factory):
    """A third of all items belong to one order of one customer, and to one product."""
    base = tmp_path_factory.mktemp("hot")
    items = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000).alias("order_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("product_id"),
        (F.col("id") % 4 + 1).alias("quantity"),
        (F.col("id") % 100 + 1).cast("decimal(18,2)").alias("price_at_purchase"),
    )
    orders = spark.range(20_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("customer_id"),
        (F.lit("2024-01-01").cast("date") + (F.col("id") % 90).cast("int")).cast("timestamp_ntz").alias("order_date"),
        F.when(F.col("id") % 5 == 4, "cancelled").otherwise("shipped").alias("order_status"),
        F.lit("online").alias("sales_channel"),
    )
    customers = spark.range(1000).select(
        F.col("id").alias("customer_id"),
        F.lit("n").alias("first_name"),
        F.col("id").cast("string").alias("last_name"),
        F.lit("e").alias("email"),
    )
    products = spark.range(500).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("m"), F.col("id") % 20).alias("model_name"),
        F.concat(F.lit("t"), F.col("id") % 4).alias("theme"),
        F.lit("f").alias("finish"),
        F.lit(1).cast("decimal(18,2)").alias("base_price"),
    )
    frames = {}
    for name, df in {"orders": orders, "customers": customers, "items": items, "products": products}.items():
        df.write.parquet(str(base / name))
        frames[name] = spark.read.parquet(str(base / name))
    return Retail(**frames)


@pytest.fixture
def shuffled(spark):
    """Force shuffle joins and let the adaptive planner see the small test partitions as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_in_the_join(hot_shop, shuffled):
    plan = final_plan(ops.kpi_row(facts.sales_fact(hot_shop)))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_order_is_split_in_the_anti_join(hot_shop, shuffled):
    active = hot_shop.orders.filter("order_status = 'shipped'")
    plan = final_plan(integrity.orphan_items(hot_shop.items, active))
    assert "SortMergeJoin(skew=true)" in plan


def test_results_do_not_depend_on_the_join_strategy(spark, hot_shop, shuffled):
    def results():
        sales = facts.sales_fact(hot_shop)
        return [
            sorted(map(tuple, df.collect()), key=repr)
            for df in (
                ops.kpi_row(sales),
                ops.copurchase_edges(sales),
                ops.cohort_retention(sales),
                ops.customer_profiles(sales, hot_shop.customers),
                rfm.rfm_scores(sales),
                integrity.integrity_report(hot_shop, facts.quality_fact(hot_shop)),
            )
        ]

    split = results()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert results() == split
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_hot_order_emits_no_pairs_of_lines(hot_shop):
    """67,000 lines of one order would be two billion pairs; models are paired instead."""
    edges = ops.copurchase_edges(facts.sales_fact(hot_shop))
    assert edges.agg(F.max("weight")).first()[0] > 10**9


def test_hot_day_is_written_by_several_tasks(spark, make_cards, shuffled, tmp_path):
    cards = make_cards({}).crossJoin(spark.range(100_000)).withColumn("transaction_id", F.col("id")).drop("id")
    sinks.write_partitioned(cards, str(tmp_path / "days"))
    assert len(list((tmp_path / "days").glob("*/*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "days")).count() == 100_000


def test_identical_rows_are_clustered_into_several_files(spark, make_cards, shuffled, tmp_path):
    # Copies compress to almost nothing, so the small ranges of this test would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    copies = spark.range(0, 50_000, 1, 8).crossJoin(F.broadcast(make_cards({}))).drop("id")
    sinks.write_clustered(copies, str(tmp_path / "c"), ["transaction_timestamp", "merchant_id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert stored.count() == 50_000
    assert stored.select(F.input_file_name()).distinct().count() > 1

"""Mapping of the benchmark tables onto the retail, card and support-order models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.scalars import choose


@dataclass(frozen=True)
class Retail:
    """The four retail tables."""

    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    products: DataFrame
    # Orders that are not cancelled, when the source can filter them before the status is decoded.
    active: DataFrame | None = None

    def active_orders(self) -> DataFrame:
        if self.active is not None:
            return self.active
        return self.orders.filter(F.col("order_status") != "cancelled")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def retail(spark: SparkSession, folder: str) -> Retail:
    online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    stored_orders = table(spark, folder, "orders")
    order_columns = [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        choose(
            {
                "delivered": F.col("o_orderstatus") == "F",
                "shipped": F.col("o_orderstatus") == "O",
                "cancelled": F.col("o_orderstatus") == "P",
            }
        ).alias("order_status"),
        F.when(online, "online").otherwise("in_person").alias("sales_channel"),
        F.when(~online, F.col("o_orderpriority")).alias("store_id"),
    ]
    orders = stored_orders.select(*order_columns)
    # The stored code is compared, so that the filter reaches the file scan.
    active = stored_orders.filter(F.col("o_orderstatus").isin("F", "O")).select(*order_columns)
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.col("c_nationkey").alias("nation_id"),
    )
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("price_at_purchase"),
    )
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("model_name"),
        F.col("p_type").alias("theme"),
        F.col("p_name").alias("finish"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("base_price"),
    )
    return Retail(orders, customers, items, products, active)


def card_columns() -> list[Column]:
    return [
        F.col("event_id").alias("element"),
        F.lit("basic-card").alias("object_type"),
        (F.col("event_id") + 1_000_000_000).alias("transaction_id"),
        F.when(F.col("event_type") == "purchase", "PURCHASE")
        .when(F.col("event_type") == "error", "REFUND")
        .otherwise(F.upper("event_type"))
        .alias("transaction_type"),
        (F.col("value").cast("decimal(10,2)") * 20).cast("decimal(10,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("ts").alias("transaction_timestamp"),
        (F.col("event_type") != "error").alias("approved"),
        (F.lit(4_000_000_000_000_000) + F.col("user_id")).alias("card_number"),
        F.get_json_object("props", "$.k").cast("bigint").alias("merchant_id"),
    ]


def cards(spark: SparkSession, folder: str) -> DataFrame:
    """The refined card-transaction table."""
    return table(spark, folder, "events").select(*card_columns())


def card_document() -> Column:
    """A refined card row as the nested JSON text of the staging area."""
    return F.to_json(
        F.struct(
            F.col("element"),
            F.col("object_type").alias("object"),
            F.struct(
                F.col("transaction_id").alias("id"),
                F.col("transaction_type").alias("type"),
                F.col("amount"),
                F.col("currency"),
                F.col("transaction_timestamp").cast("string").alias("timestamp"),
                F.col("approved"),
            ).alias("transaction"),
            F.struct(F.col("card_number").alias("number")).alias("card"),
            F.struct(F.col("merchant_id").alias("id")).alias("merchant"),
        )
    )


def card_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Raw staging table: one variant column."""
    return cards(spark, folder).select(F.parse_json(card_document()).alias("json_data"))


def support_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Wide support-order table with a semi-structured address."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    buyers = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(
            table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .join(
            table(spark, folder, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        .select(
            "o_orderkey",
            "o_orderdate",
            "c_name",
            F.parse_json(F.to_json(F.struct(F.col("n_name").alias("state")))).alias("address"),
        )
    )
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("txid"),
            F.col("p_name").alias("item"),
            F.col("o_orderdate").alias("purchase_time"),
            F.col("c_name").alias("name"),
            "address",
        )
    )


def usage(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly usage rows per service, aggregated from the event log."""
    value = F.col("value").cast("decimal(10,2)")
    return (
        table(spark, folder, "events")
        .groupBy(
            F.concat(F.lit("WH_"), F.upper("event_type")).alias("warehouse_name"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start_time"),
        )
        .agg(
            (F.sum(value) / 1000).cast("decimal(10,6)").alias("credits_used"),
            F.sum(F.when(value > 50, 1).otherwise(0)).alias("query_count"),
            F.floor(F.max(value) * 300).alias("avg_execution_time"),
            F.floor(F.sum(value) * 4_000_000).cast("bigint").alias("total_bytes_scanned"),
        )
    )


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    """One job run per event; the value is the run time in seconds."""
    millis = (F.col("value").cast("decimal(10,2)") * 1000).cast("bigint")
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        F.concat(F.upper("event_type"), F.lit("_TASK")).alias("task_name"),
        F.when(F.get_json_object("props", "$.k").cast("bigint") < 10, "FAILED")
        .otherwise("SUCCEEDED")
        .alias("state"),
        F.col("ts").cast("timestamp").alias("scheduled_time"),
        F.timestamp_micros(start + millis * 1000).alias("completed_time"),
    )


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """Per-file load history, one daily file per event type."""
    merchant = F.get_json_object("props", "$.k").cast("bigint")
    return (
        table(spark, folder, "events")
        .groupBy(
            F.concat(F.upper("event_type"), F.lit("_STAGING")).alias("table_name"),
            F.concat(
                F.col("event_type"), F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")
            ).alias("file_name"),
        )
        .agg(
            F.count("*").alias("row_parsed"),
            F.sum(F.when(merchant < 99, 1).otherwise(0)).alias("row_count"),
            F.sum(F.when(merchant >= 99, 1).otherwise(0)).alias("error_count"),
            F.sum(F.length("props").cast("bigint")).alias("bytes_loaded"),
            F.max("ts").alias("last_load_time"),
        )
        .withColumn(
            "status", F.when(F.col("error_count") > 0, "PARTIALLY_LOADED").otherwise("LOADED")
        )
    )


def object_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage edges between business objects found in the data.

    Region to nation to customer segment to order priority. Every level has a fixed vocabulary, so the
    edge table stays small while the aggregation behind it reads all customers and orders.
    """
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority")

    def edges(df: DataFrame, source: Column, target: Column, kind: str, level: int) -> DataFrame:
        return df.select(
            source.alias("source_object"),
            target.alias("target_object"),
            F.lit(kind).alias("transformation_type"),
            F.lit(level).alias("dependency_level"),
        ).distinct()

    nation = F.concat(F.lit("N:"), "n_name")
    segment = F.concat(F.lit("S:"), "c_mktsegment")
    level_1 = edges(
        nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")),
        F.concat(F.lit("R:"), "r_name"),
        nation,
        "REGION",
        1,
    )
    level_2 = edges(
        customers.select("c_nationkey", "c_mktsegment")
        .distinct()
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey")),
        nation,
        segment,
        "MARKET",
        2,
    )
    level_3 = edges(
        orders.distinct().join(customers, F.col("o_custkey") == F.col("c_custkey")),
        segment,
        F.concat(F.lit("P:"), "o_orderpriority"),
        "ORDER",
        3,
    )
    return (
        level_1.unionByName(level_2)
        .unionByName(level_3)
        .withColumn(
            "lineage_id",
            F.concat_ws("|", F.col("dependency_level"), "source_object", "target_object"),
        )
    )

"""Registered queries that run a streaming job over the tables and return what it stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.facts import price, typed_cards
from ledgerloom.operators import changes as table_changes
from ledgerloom.operators.relational import row_counts
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import register
from ledgerloom.schemas import CARD_TRANSACTIONS, ORDER_ITEMS, ORDERS
from ledgerloom.session import fresh_dir
from ledgerloom.sources import bindings
from ledgerloom.sources.readers import is_folder
from ledgerloom.streaming import alerts, changes, topics


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a file stream: the folder that it is, or the one file in the parent folder."""
    reader = spark.readStream.schema(bindings.table(spark, folder, "events").schema)
    path = f"{folder}/events.parquet"
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(folder)


def card_stream(spark: SparkSession, folder: str) -> DataFrame:
    return event_stream(spark, folder).select(*bindings.card_columns())


@register(
    "stream_refined_cards",
    sql(
        "cards",
        """SELECT element, transaction_id, transaction_type, cast(amount AS double) AS amount,
        transaction_timestamp, approved, card_number, merchant_id FROM cards""",
    ),
)
def _(spark, folder):
    """Raw documents through the change stream into the refined table, read back."""
    base = fresh_dir(spark, "refined-cards")
    staged = (
        event_stream(spark, folder)
        .select(*bindings.card_columns())
        .select(F.parse_json(bindings.card_document()).alias("json_data"))
        .withColumn("metadata_action", F.lit("INSERT"))
        .withColumn("source_file", F.lit("events"))
    )
    changes.load_once(staged, f"{base}/table", f"{base}/offsets", shape=changes.as_refined).awaitTermination()
    return changes.read_table(spark, f"{base}/table", CARD_TRANSACTIONS).select(
        "element",
        "transaction_id",
        "transaction_type",
        F.col("amount").cast("double").alias("amount"),
        "transaction_timestamp",
        "approved",
        "card_number",
        "merchant_id",
    )


@register(
    "stream_window_alerts",
    sql(
        "cards",
        """SELECT * FROM (SELECT start AS window_start, start + interval 15 minute AS window_end,
    count(*) AS transactions, count(*) FILTER (amount > 5000) AS high_value_count,
    cast(round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) AS bigint) AS approval_rate,
    count(*) FILTER (amount > 5000) > 0 AS high_value_alert,
    round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) < 80 AS approval_alert
    FROM (SELECT *, unnest(generate_series(
        cast(date_trunc('minute', transaction_timestamp) AS timestamp) - interval 14 minute,
        cast(date_trunc('minute', transaction_timestamp) AS timestamp), interval 1 minute)) AS start
      FROM cards) GROUP BY start)
    WHERE window_end <= (SELECT max(transaction_timestamp) - interval 15 minute FROM cards)""",
    ),
)
def _(spark, folder):
    """Windows that the watermark has closed."""
    base = fresh_dir(spark, "window-alerts")
    finished = alerts.alert_stream(card_stream(spark, folder))
    alerts.append_to(finished, f"{base}/table", f"{base}/offsets").awaitTermination()
    return spark.read.parquet(f"{base}/table")


@register(
    "stream_current_alerts",
    sql(
        "cards",
        """SELECT start AS window_start, start + interval 15 minute AS window_end,
    count(*) AS transactions, count(*) FILTER (amount > 5000) AS high_value_count,
    cast(round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) AS bigint) AS approval_rate,
    count(*) FILTER (amount > 5000) > 0 AS high_value_alert,
    round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) < 80 AS approval_alert
    FROM (SELECT *, unnest(generate_series(
        cast(date_trunc('minute', transaction_timestamp) AS timestamp) - interval 14 minute,
        cast(date_trunc('minute', transaction_timestamp) AS timestamp), interval 1 minute)) AS start
      FROM cards) GROUP BY start""",
    ),
)
def _(spark, folder):
    """All windows, also those that later rows may still change."""
    base = fresh_dir(spark, "current-alerts")
    alerts.update_to(alerts.step_updates(card_stream(spark, folder)), f"{base}/steps", f"{base}/offsets").awaitTermination()
    return alerts.current_alerts(spark, f"{base}/steps")


@register(
    "stream_repeated_cards",
    sql(
        "cards",
        """SELECT cast(time_bucket(interval 30 minute, transaction_timestamp) AS timestamp) AS window_start,
      card_number, count(*) AS occurrences, count(*) FILTER (gap <= interval 30 minute) AS repeats
    FROM (SELECT *, transaction_timestamp
            - lag(transaction_timestamp) OVER (PARTITION BY card_number ORDER BY transaction_timestamp) AS gap
          FROM cards)
    GROUP BY ALL HAVING count(*) FILTER (gap <= interval 30 minute) > 0""",
    ),
)
def _(spark, folder):
    """Cards that come again within 30 minutes of their previous row."""
    base = fresh_dir(spark, "repeated-cards")
    watch = alerts.duplicate_watch(card_stream(spark, folder), "card_number")
    alerts.update_to(watch, f"{base}/table", f"{base}/offsets").awaitTermination()
    return alerts.latest(spark, f"{base}/table", alerts.REPEATS, ["window_start", "card_number"])


def order_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The orders, and a later state of them: some deleted, some with another status, some new."""
    orders = bindings.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    changed = F.when(key % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    later = orders.filter(key % 7 != 0).withColumn("o_orderstatus", changed)
    new = orders.filter(key % 11 == 0).withColumn("o_orderkey", -key)
    return orders, later.unionByName(new)


LATER_ORDERS = """later AS (
      SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
      FROM orders WHERE o_orderkey % 7 <> 0
      UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 = 0)"""


@register(
    "table_changes",
    f"""WITH {LATER_ORDERS}
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN side = 'new' THEN a.o_orderstatus ELSE b.o_orderstatus END
      AS o_orderstatus, CASE WHEN side = 'new' THEN 'INSERT' ELSE 'DELETE' END AS metadata_action,
      a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AS metadata_isupdate
    FROM later a FULL JOIN orders b ON a.o_orderkey = b.o_orderkey, (SELECT unnest(['new', 'old']) AS side)
    WHERE (side = 'new' AND a.o_orderkey IS NOT NULL OR side = 'old' AND b.o_orderkey IS NOT NULL)
      AND (a.o_custkey, a.o_orderstatus, a.o_totalprice) IS DISTINCT FROM (b.o_custkey, b.o_orderstatus, b.o_totalprice)""",
)
def _(spark, folder):
    """Inserts, deletes and both halves of updates between two states of the orders."""
    before, after = order_states(spark, folder)
    return table_changes.table_changes(before, after, ["o_orderkey"]).select(
        "o_orderkey", "o_orderstatus", "metadata_action", "metadata_isupdate"
    )


@register("stream_table_changes", f"WITH {LATER_ORDERS} SELECT * FROM later")
def _(spark, folder):
    """Initial rows and changes of the orders through a stream; the consumer's table is the later state."""
    base = fresh_dir(spark, "order-changes")
    before, after = order_states(spark, folder)
    first = table_changes.table_changes(None, before, ["o_orderkey"])
    changes.record_changes(first, f"{base}/log", 0)
    changes.record_changes(table_changes.table_changes(before, after, ["o_orderkey"]), f"{base}/log", 1)
    stream = changes.recorded_changes(spark, f"{base}/log", first.schema)
    changes.load_once(stream.withColumn("source_file", F.lit("log")), f"{base}/table", f"{base}/offsets").awaitTermination()
    consumed = changes.read_table(spark, f"{base}/table", first.schema.add("version", "long"))
    return table_changes.current_rows(consumed, ["o_orderkey"], "version")


def line_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One nested order message per order line."""
    r = bindings.retail(spark, folder)
    text = lambda c: F.col(c).cast("string").alias(c)
    return r.items.join(r.orders, "order_id").select(
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        text("order_id"),
                        text("customer_id"),
                        text("order_date"),
                        F.col("order_status"),
                        F.col("sales_channel"),
                        F.array(
                            F.struct(text("product_id"), F.col("quantity"), price().alias("price_at_purchase"))
                        ).alias("order_items"),
                    )
                ).alias("orders")
            )
        ).alias("data")
    )


@register(
    "fanned_out_items",
    sql(
        "r_orders r_items",
        """SELECT cast(i.order_id AS varchar) AS order_id, cast(i.product_id AS varchar) AS product_id,
    i.quantity, cast(i.price_at_purchase AS double) AS price_at_purchase
    FROM r_items i JOIN r_orders o ON i.order_id = o.order_id""",
    ),
)
def _(spark, folder):
    """Order items of nested messages as a flat table."""
    items = topics.fan_out(line_messages(spark, folder))["order_items"]
    return items.withColumn("price_at_purchase", F.col("price_at_purchase").cast("double")).drop("rfid")


@register(
    "stream_fan_out",
    sql(
        "r_orders r_items",
        """SELECT t AS table_name, count(*) AS record_count FROM r_items i
    JOIN r_orders o ON i.order_id = o.order_id, (SELECT unnest(['orders','order_items']) AS t) GROUP BY t""",
    ),
)
def _(spark, folder):
    """Publish nested messages to a topic, stream them into flat tables, count the tables."""
    base = fresh_dir(spark, "fan-out")
    topics.publish(line_messages(spark, folder), f"{base}/topics", "orders")
    messages = topics.consume(spark, f"{base}/topics", "orders", files_per_batch=topics.BATCH_FILES)
    topics.fan_out_stream(messages, f"{base}/tables", f"{base}/offsets").awaitTermination()
    return row_counts(
        {
            "orders": changes.read_table(spark, f"{base}/tables/orders", ORDERS),
            "order_items": changes.read_table(spark, f"{base}/tables/order_items", ORDER_ITEMS),
        }
    )


@register(
    "topic_payload_counts",
    sql(
        "r_orders r_items",
        """SELECT count(*) AS messages, cast(0 AS bigint) AS products, cast(0 AS bigint) AS customers,
    count(*) AS orders, cast(0 AS bigint) AS unreadable FROM r_items i JOIN r_orders o ON i.order_id = o.order_id""",
    ),
)
def _(spark, folder):
    return topics.payload_counts(line_messages(spark, folder))


@register(
    "lenient_typed_view",
    sql("cards", "SELECT transaction_type, count(*) AS n, count(amount) AS amounts FROM cards GROUP BY 1"),
)
def _(spark, folder):
    """Typed view that turns unreadable values into NULL."""
    return (
        typed_cards(bindings.card_staging(spark, folder), lenient=True)
        .groupBy("transaction_type")
        .agg(F.count("*").alias("n"), F.count("amount").alias("amounts"))
    )

"""Message topics: publish, consume, fan out nested messages, statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.schemas import CUSTOMERS, ENVELOPE, NESTED_MESSAGE, ORDER_ITEMS, ORDERS, PRODUCTS
from ledgerloom.sources.readers import list_stage, match_by_name, move_files, remove
from ledgerloom.sources.sinks import materialise, replace_table
from ledgerloom.streaming.changes import CORRUPT, batch_folder, loaded_files, trigger

FILE_MESSAGES, BATCH_FILES = 50_000, 500  # messages of a topic's file; files of a batch of the registered streams
EMPTY_GZIP = 20  # bytes of a compressed file without content
PARTS = ("products", "customers", "orders")
TABLES = {"products": PRODUCTS, "customers": CUSTOMERS, "orders": ORDERS, "order_items": ORDER_ITEMS}


def envelopes(messages: DataFrame, topic: str, data: str = "data") -> DataFrame:
    """Wrap message texts for a topic."""
    return messages.select(
        F.uuid().alias("id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col(data).alias("data"),
        F.lit(topic).alias("topic"),
    )


def rows_as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("data"))


def publish(messages: DataFrame, folder: str, topic: str) -> None:
    """Append messages to a file topic; readers see whole files only.

    Envelopes repeat themselves, so they are compressed. One task reads a compressed file: it holds FILE_MESSAGES at most.
    Spark writes a file also for an empty first partition; it stays behind, as a consumer could never log it as read.
    """
    aside = f"{folder}/{topic}/_publishing-{uuid.uuid4().hex}"
    (
        envelopes(messages, topic).write
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_MESSAGES)
        .json(aside)
    )
    spark = messages.sparkSession
    if not move_files(spark, aside, f"{folder}/{topic}", EMPTY_GZIP + 1):  # no message at all: a file of no bytes
        spark.createDataFrame([], ENVELOPE).write.mode("append").json(f"{folder}/{topic}")
    remove(spark, aside)


def consume(
    spark: SparkSession,
    folder: str,
    topic: str,
    files_per_batch: int | None = None,
    clean: str | None = None,
) -> DataFrame:
    """Messages of a file topic as a stream, oldest file first; broken files give no message."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if clean:
        reader = reader.option("cleanSource", clean)
    source = reader.json(f"{folder}/{topic}")
    return source.filter(F.col("data").isNotNull()).withColumn(
        "source_file", F.col("_metadata.file_path")
    )


def kafka_messages(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Kafka topics in the same envelope shape. Needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
        .load()
        .select(
            F.concat_ws("-", "topic", "partition", "offset").alias("id"),
            F.col("timestamp").cast("string").alias("timestamp"),
            F.col("value").cast("string").alias("data"),
            "topic",
        )
    )


def publish_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Producer settings of the broker (acks, compression, batch size) pass as ``kafka.*`` options."""
    (
        messages.select(F.col("data").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def topics_to_tables(
    messages: DataFrame,
    table_of: Mapping[str, tuple[str, StructType]],
    checkpoint: str,
    every: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Write every topic's messages to its table: topic -> (path, schema).

    Unreadable messages and those of other topics go to ``quarantine`` with a reason; without that path they
    end the batch. Each message is parsed once, into a stored batch that all tables are written from.
    """
    payloads = {topic: f"m{i}" for i, topic in enumerate(table_of)}

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, checkpoint, batch_id)
        own = [
            F.when(F.col("topic") == topic, payload(schema)).alias(payloads[topic])
            for topic, (_, schema) in table_of.items()
        ]
        reason = F.when(~F.col("topic").isin(*table_of) | F.col("topic").isNull(), "unmapped topic")
        for topic, name in payloads.items():
            reason = reason.when((F.col("topic") == topic) & unreadable(name), "unreadable")
        with stored_batch(with_reason(batch.select("*", *own), reason), checkpoint, batch_id) as kept:
            refuse(kept.filter("reason IS NOT NULL").select("topic", "data", "reason"), quarantine, folder)
            good = kept.filter("reason IS NULL")
            for topic, (path, _) in table_of.items():
                rows = good.filter(F.col("topic") == topic).select(f"{payloads[topic]}.*")
                replace_table(rows.drop(CORRUPT), f"{path}/{folder}")

    # A batch is scanned with all columns of its stream, so the others are left out before it.
    return (
        messages.select("topic", "data").writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def fan_out(messages: DataFrame) -> dict[str, DataFrame]:
    """Nested messages as four flat tables; order items carry the key of their order.

    A missing or empty list gives no rows.
    """
    return flatten(parsed(messages))


def payload(schema: StructType) -> Column:
    """The parsed data, with the broken text where it is not JSON of the schema."""
    with_text = StructType([*schema.fields]).add(CORRUPT, "string")
    return F.from_json("data", with_text, {"columnNameOfCorruptRecord": CORRUPT})


def readable(messages: DataFrame, schema: StructType) -> DataFrame:
    """data and m, the parsed payload."""
    return messages.select("data", payload(schema).alias("m"))


def unreadable(parsed: str = "m") -> Column:
    return F.col(parsed).isNull() | F.col(f"{parsed}.{CORRUPT}").isNotNull()


def with_reason(messages: DataFrame, reason: Column) -> DataFrame:
    """Add why a message is refused (NULL for the others, whose text is no longer needed)."""
    marked = messages.withColumn("reason", reason)
    return marked.withColumn("data", F.when(F.col("reason").isNotNull(), F.col("data")))


@contextmanager
def stored_batch(rows: DataFrame, checkpoint: str, batch_id: int) -> Iterator[DataFrame]:
    """The rows of a batch on disk beside the stream's offsets, until all its tables are written.

    Every table reads only its columns of them. A batch that is repeated replaces what it has left.
    """
    path = f"{checkpoint}/parsed/{batch_id}"
    try:
        yield materialise(rows, path)
    finally:
        remove(rows.sparkSession, path)


def refuse(rows: DataFrame, quarantine: str | None, folder: str) -> None:
    """Keep refused messages in the quarantine table, or fail when there is none and some were refused."""
    if quarantine:
        replace_table(rows, f"{quarantine}/{folder}")
    elif not rows.isEmpty():
        raise ValueError(f"refused messages and no quarantine: {rows.first()}")


def parsed(messages: DataFrame) -> DataFrame:
    """Readable payloads; see :func:`readable` for the others."""
    return readable(messages, NESTED_MESSAGE).filter(~unreadable())


def flatten(nested: DataFrame) -> dict[str, DataFrame]:
    def rows(part: str) -> DataFrame:
        return nested.select(F.inline(F.col(f"m.{part}")))

    orders = rows("orders")
    items = orders.select("order_id", F.inline("order_items"))
    return {
        "products": match_by_name(rows("products"), PRODUCTS),
        "customers": match_by_name(rows("customers"), CUSTOMERS),
        "orders": match_by_name(orders.drop("order_items"), ORDERS),
        "order_items": match_by_name(items, ORDER_ITEMS),
    }


def fan_out_stream(
    messages: DataFrame, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Stream nested messages into the four tables below ``target``; empty parts write nothing.

    Messages that are not JSON go to the table ``quarantine`` beside them.
    """

    filled = {part: F.size(f"m.{part}") > 0 for part in PARTS}
    filled["order_items"] = F.exists("m.orders", lambda order: F.size(order["order_items"]) > 0)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, checkpoint, batch_id)
        # Parsed once for all writes, with marks of the tables that a message has rows for.
        marked = with_reason(readable(batch, NESTED_MESSAGE), F.when(unreadable(), "unreadable"))
        marked = marked.withColumns({f"has_{name}": has for name, has in filled.items()})
        with stored_batch(marked, checkpoint, batch_id) as kept:
            refuse(kept.filter("reason IS NOT NULL").select("data", "reason"), f"{target}/quarantine", folder)
            good = kept.filter("reason IS NULL")
            found = good.agg(*(F.bool_or(f"has_{name}").alias(name) for name in filled)).first()
            for name, rows in flatten(good).items():
                if found[name]:
                    replace_table(rows, f"{target}/{name}/{folder}")

    return (
        messages.select("data").writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def payload_counts(messages: DataFrame) -> DataFrame:
    """Messages and the number of entries of each part in their payload."""
    sizes = [
        F.coalesce(F.sum(F.greatest(F.size(F.col(f"m.{p}")), F.lit(0))), F.lit(0)).alias(p)
        for p in PARTS
    ]
    broken = F.count(F.when(unreadable(), 1)).alias("unreadable")
    return readable(messages, NESTED_MESSAGE).agg(F.count("*").alias("messages"), *sizes, broken)


def count_stream(
    messages: DataFrame, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Per-batch payload counts, written while consuming."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, checkpoint, batch_id)
        replace_table(payload_counts(batch), f"{target}/{folder}")

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def topic_statistics(spark: SparkSession, folder: str, topic: str, log: str | None = None) -> DataFrame:
    """Files and bytes of a topic; with a load log only those not consumed yet."""
    files = list_stage(spark, f"{folder}/{topic}").filter(~F.col("name").endswith("_SUCCESS"))
    loaded = loaded_files(spark, log) if log else None
    if loaded is not None:
        files = files.join(loaded, files["name"] == loaded["file_name"], "left_anti")
    return files.agg(
        F.count("*").alias("queue_size"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    ).select(F.lit(topic).alias("topic"), "*")

"""Registered queries that stage the tables as files, ingest them and return what was stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators import privacy
from ledgerloom.operators.facts import typed_cards
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import register
from ledgerloom.schemas import CARD_TRANSACTIONS, CUSTOMERS, PRODUCTS
from ledgerloom.session import fresh_dir
from ledgerloom.sources import bindings, readers, sinks
from ledgerloom.streaming import changes, runs, topics

ROWS_PER_FILE = 1000
TYPED = """SELECT element, transaction_id, transaction_type, cast(amount AS double) AS amount, approved,
    card_number, merchant_id FROM cards"""
COLUMNS = ["element", "transaction_id", "transaction_type", "amount", "approved", "card_number", "merchant_id"]


def staged_arrays(spark: SparkSession, folder: str, name: str) -> str:
    """The card documents as files that hold one JSON array each."""
    path = f"{fresh_dir(spark, name)}/stage"
    rows = bindings.cards(spark, folder).select(
        F.floor(F.col("element") / ROWS_PER_FILE).alias("file"), bindings.card_document().alias("document")
    )
    arrays = rows.groupBy("file").agg(  # ROWS_PER_FILE documents at most
        F.concat(F.lit("["), F.array_join(F.collect_list("document"), ","), F.lit("]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def plain(cards: DataFrame) -> DataFrame:
    return cards.select(*[F.col(c).cast("double").alias(c) if c == "amount" else F.col(c) for c in COLUMNS])


@register(
    "ingest_json_lines",
    sql("r_customers", "SELECT cast(customer_id AS varchar) AS customer_id, first_name, last_name, email FROM r_customers"),
)
def _(spark, folder):
    """Newline JSON by an explicit schema; the e-mail is absent from the lines."""
    path = f"{fresh_dir(spark, 'json-lines')}/customers"
    bindings.retail(spark, folder).customers.select(
        F.col("customer_id").cast("string").alias("customer_id"), "first_name", "last_name"
    ).write.json(path)
    return readers.read_json_lines(spark, path, CUSTOMERS).select("customer_id", "first_name", "last_name", "email")


@register("ingest_json_arrays", sql("cards", TYPED))
def _(spark, folder):
    """JSON array files, chosen by a pattern on their name, one typed row per element."""
    path = staged_arrays(spark, folder, "json-arrays")
    return plain(typed_cards(readers.read_json_variants(spark, path, r".*/part-[^/]*\.txt")))


@register("ingest_no_matching_file", sql("cards", "SELECT count(*) AS n FROM cards WHERE false"))
def _(spark, folder):
    path = staged_arrays(spark, folder, "json-arrays")
    return readers.read_json_variants(spark, path, r".*/other-.*").agg(F.count("*").alias("n"))


@register(
    "ingest_parquet_by_name",
    sql(
        "r_products",
        """SELECT cast(product_id AS varchar) AS product_id, model_name, cast(NULL AS varchar) AS theme,
        cast(base_price AS double) AS base_price, cast(NULL AS varchar) AS sku FROM r_products""",
    ),
)
def _(spark, folder):
    """Columns by case-sensitive name: one in other case and one extra are ignored, missing ones are NULL."""
    path = f"{fresh_dir(spark, 'by-name')}/products"
    products = bindings.retail(spark, folder).products
    products.select(
        "base_price", "model_name", F.col("product_id").cast("string").alias("product_id"),
        F.col("theme").alias("Theme"), F.col("finish").alias("extra"),
    ).write.parquet(path)
    read = readers.read_parquet_by_name(spark, path, PRODUCTS)
    return read.select("product_id", "model_name", "theme", F.col("base_price").cast("double").alias("base_price"), "sku")


@register(
    "ingest_reloaded_twice",
    sql("cards", "SELECT transaction_type, 2 * count(*) AS n FROM cards GROUP BY transaction_type"),
)
def _(spark, folder):
    """A forced reload stores every file again."""
    path = staged_arrays(spark, folder, "reloaded")
    target = f"{fresh_dir(spark, 'reloaded')}/table"
    for _ in range(2):
        sinks.reload_all(spark, lambda s, p: plain(typed_cards(readers.read_json_variants(s, p))), path, target)
    return spark.read.parquet(target).groupBy("transaction_type").agg(F.count("*").alias("n"))


@register(
    "ingest_capped_files",
    sql("cards", "SELECT count(*) AS n, cast(sum(element) AS bigint) AS elements, true AS within_cap FROM cards"),
)
def _(spark, folder):
    """Parquet files of at most ROWS_PER_FILE rows, read back with their file names."""
    path = f"{fresh_dir(spark, 'capped')}/cards"
    sinks.write_batches(bindings.cards(spark, folder), path, ROWS_PER_FILE)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.sum("element").alias("elements")
    )
    return files.agg(
        F.sum("rows").alias("n"), F.sum("elements").alias("elements"), (F.max("rows") <= ROWS_PER_FILE).alias("within_cap")
    )


@register(
    "ingest_appended_columns",
    sql("cards", "SELECT element, count(*) AS n, true AS stamped FROM (SELECT * FROM cards UNION ALL SELECT * FROM cards) GROUP BY element"),
)
def _(spark, folder):
    path = f"{fresh_dir(spark, 'appended')}/cards"
    for _ in range(2):
        sinks.append_columns(bindings.cards(spark, folder), path, ["element", "amount"], stamp="loaded_at")
    stamped = F.bool_and(F.col("loaded_at").isNotNull()).alias("stamped")
    return spark.read.parquet(path).groupBy("element").agg(F.count("*").alias("n"), stamped)


@register(
    "ingest_json_text",
    sql("cards", "SELECT element, cast(transaction_id AS bigint) AS transaction_id FROM cards"),
)
def _(spark, folder):
    """A JSON text column as a variant."""
    texts = bindings.cards(spark, folder).select("element", bindings.card_document().alias("json_data"))
    parsed = readers.parse_json_columns(texts, "json_data")
    return parsed.select("element", F.variant_get("json_data", "$.transaction.id", "bigint").alias("transaction_id"))


@register(
    "stage_files",
    sql("cards", f"SELECT count(DISTINCT element // {ROWS_PER_FILE}) AS files, true AS all_have_bytes FROM cards"),
)
def _(spark, folder):
    listed = readers.list_stage(spark, staged_arrays(spark, folder, "listed")).filter(F.col("name").endswith(".txt"))
    return listed.filter("size > 0").agg(F.count("*").alias("files"), F.bool_and(F.col("size") > 0).alias("all_have_bytes"))


@register("materialised_base", sql("cards", "SELECT approved, count(*) AS n FROM cards GROUP BY approved"))
def _(spark, folder):
    base = sinks.materialise(bindings.cards(spark, folder), f"{fresh_dir(spark, 'base')}/cards")
    return base.groupBy("approved").agg(F.count("*").alias("n"))


@register("stream_changes_refined", sql("cards", TYPED))
def _(spark, folder):
    """Array files through the change stream into the refined table; a second run finds nothing new."""
    base, stage = fresh_dir(spark, "refined"), staged_arrays(spark, folder, "refined")
    for _ in range(2):
        changes.refine(spark, stage, f"{base}/table", f"{base}/offsets", f"{base}/log").awaitTermination()
    return plain(changes.read_table(spark, f"{base}/table", CARD_TRANSACTIONS))


@register(
    "stream_load_history",
    sql("cards", "SELECT 'LOADED' AS status, count(*) AS row_count, cast(0 AS bigint) AS error_count FROM cards"),
)
def _(spark, folder):
    """The history that the load itself wrote."""
    base, stage = fresh_dir(spark, "history"), staged_arrays(spark, folder, "history")
    changes.refine(spark, stage, f"{base}/table", f"{base}/offsets", f"{base}/log").awaitTermination()
    rows = changes.load_history(spark, f"{base}/log").groupBy("status")
    return rows.agg(F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count"))


@register("stream_load_then_refine", sql("cards", TYPED))
def _(spark, folder):
    base, stage = fresh_dir(spark, "two-steps"), staged_arrays(spark, folder, "two-steps")
    changes.load_then_refine(spark, stage, f"{base}/staging", f"{base}/table", f"{base}/offsets")
    return plain(changes.read_table(spark, f"{base}/table", CARD_TRANSACTIONS))


@register(
    "stream_backlog",
    sql("cards", "SELECT 'before' AS moment, count(*) AS pending FROM cards UNION ALL SELECT 'after', 0"),
)
def _(spark, folder):
    """Pending documents before and after a load."""
    base, stage = fresh_dir(spark, "backlog"), staged_arrays(spark, folder, "backlog")
    before = changes.backlog(spark, stage, f"{base}/log").select(F.lit("before").alias("moment"), "pending")
    before = sinks.materialise(before, f"{base}/before")  # counted now, as the log is about to change
    changes.refine(spark, stage, f"{base}/table", f"{base}/offsets", f"{base}/log").awaitTermination()
    after = changes.backlog(spark, stage, f"{base}/log").select(F.lit("after").alias("moment"), "pending")
    return before.unionByName(after)


@register(
    "stream_payload_counts",
    sql("cards", "SELECT count(*) AS messages, count(*) FILTER (element % 2 = 0) AS orders, count(*) FILTER (element % 2 = 1) AS unreadable FROM cards"),
)
def _(spark, folder):
    """Counts while consuming; every second message is no JSON and is counted as such."""
    base = fresh_dir(spark, "counts")
    message = F.concat(F.lit('{"orders": [{"order_id": "'), F.col("element"), F.lit('"}]}'))
    rows = bindings.cards(spark, folder).select(
        F.when(F.col("element") % 2 == 0, message).otherwise(F.lit("not json")).alias("data")
    )
    topics.publish(rows, f"{base}/topics", "orders")
    topics.count_stream(topics.consume(spark, f"{base}/topics", "orders"), f"{base}/counts", f"{base}/offsets").awaitTermination()
    counts = spark.read.parquet(f"{base}/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in ("messages", "orders", "unreadable")])


@register(
    "stream_refused_messages",
    sql("cards", "SELECT 'orders' AS table_name, count(*) FILTER (element % 2 = 0) AS n FROM cards UNION ALL SELECT 'quarantine', count(*) FILTER (element % 2 = 1) FROM cards"),
)
def _(spark, folder):
    """Good and refused messages add up to all."""
    base = fresh_dir(spark, "refused")
    message = F.concat(F.lit('{"orders": [{"order_id": "'), F.col("element"), F.lit('"}]}'))
    rows = bindings.cards(spark, folder).select(
        F.when(F.col("element") % 2 == 0, message).otherwise(F.concat(F.lit("broken "), "element")).alias("data")
    )
    topics.publish(rows, f"{base}/topics", "orders")
    topics.fan_out_stream(topics.consume(spark, f"{base}/topics", "orders"), f"{base}/tables", f"{base}/offsets").awaitTermination()
    counts = [
        spark.read.parquet(f"{base}/tables/{t}").agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t in ("orders", "quarantine")
    ]
    return counts[0].unionByName(counts[1])


@register(
    "recorded_runs",
    sql("cards", "SELECT 'refine' AS task_name, 'SUCCEEDED' AS state, count(*) > 0 AS ended FROM cards UNION ALL SELECT 'broken', 'FAILED', true"),
)
def _(spark, folder):
    """Run history written by a job that loads the cards and by one that fails."""
    base, stage = fresh_dir(spark, "runs"), staged_arrays(spark, folder, "runs")
    runs.recorded(
        spark, "refine", f"{base}/history",
        lambda: changes.refine(spark, stage, f"{base}/table", f"{base}/offsets").awaitTermination(),
    )
    try:
        runs.recorded(spark, "broken", f"{base}/history", lambda: readers.list_stage(spark, f"{base}/nowhere").count())
    except Exception:  # noqa: BLE001  (the failure is the point; it is in the history)
        pass
    name, state, start, end = runs.run_history(spark, f"{base}/history").columns
    return runs.run_history(spark, f"{base}/history").select(
        F.col(name).alias("task_name"), F.col(state).alias("state"), (F.col(end) >= F.col(start)).alias("ended")
    )


ANONYMISED_AS_OF = "2026-01-16 00:00:00"
LATE_DAYS = "2024-01-08"


@register(
    "anonymised_store",
    sql(
        "cards",
        f"""SELECT transaction_id, cast(amount AS double) AS amount,
        transaction_timestamp < timestamp '{ANONYMISED_AS_OF}' - interval 2 year AS anonymised,
        true AS unchanged_by_second_run FROM cards""",
    ),
)
def _(spark, folder):
    """A stored table anonymised twice, with older days loaded late in between."""
    base = fresh_dir(spark, "anonymised")
    cards = bindings.cards(spark, folder)
    late = F.col("transaction_timestamp") < F.lit(LATE_DAYS).cast("timestamp_ntz")
    path = f"{base}/cards"
    sinks.write_partitioned(cards.filter(~late), path)
    privacy.anonymise_stored(spark, path, f"{base}/first", ANONYMISED_AS_OF)
    declared = F.coalesce("anonymised", F.lit(False))
    first = spark.read.parquet(path).select("transaction_id", F.col("card_number").alias("first_number"))
    first = sinks.materialise(first, f"{base}/numbers")
    sinks.write_partitioned(cards.filter(late), path)
    privacy.anonymise_stored(spark, path, f"{base}/second", ANONYMISED_AS_OF)
    rows = spark.read.option("mergeSchema", True).parquet(path)
    same = F.coalesce(F.col("first_number") == F.col("card_number"), F.lit(True))
    return rows.join(first, "transaction_id", "left").select(
        "transaction_id", F.col("amount").cast("double").alias("amount"), declared.alias("anonymised"),
        same.alias("unchanged_by_second_run"),
    )

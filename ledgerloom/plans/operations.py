"""Registered queries about stored tables, logs, roles and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.scalars import anonymous_number, moment
from ledgerloom.operators import alerts, privacy, quality, relational, sketches
from ledgerloom.plans.card import MASKED_SQL, ROLES, plain_amount
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import register
from ledgerloom.plans.streams import card_stream, line_messages
from ledgerloom.schemas import ALERT_HISTORY, CARD_TRANSACTIONS, LONG, TEXT, struct
from ledgerloom.session import fresh_dir
from ledgerloom.sources import bindings, sinks
from ledgerloom.sources.readers import folders
from ledgerloom.streaming import changes, runs, topics


@register(
    "zordered_table",
    sql(
        "cards",
        """SELECT 'time' AS filter, count(*) FILTER (transaction_timestamp >= timestamp '2024-01-10'
      AND transaction_timestamp < timestamp '2024-01-13') AS n, true AS few_files FROM cards
    UNION ALL SELECT 'merchant', count(*) FILTER (merchant_id <= (SELECT quantile_disc(merchant_id, 0.1) FROM cards)), true FROM cards""",
    ),
)
def _(spark, folder):
    """Rows of a filter on either column of a Z-ordered table, and whether it opens under three quarters of the files."""
    cards = bindings.cards(spark, folder).select("transaction_timestamp", "merchant_id", "amount")
    path = fresh_dir(spark, "cards-zordered")
    sinks.write_zordered(cards, path, ["transaction_timestamp", "merchant_id"], files=16)
    stored = spark.read.parquet(path)
    tenth = F.percentile("merchant_id", F.lit(0.1)).alias("p")
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-13"))
    limit = int(cards.agg(tenth).first()["p"])
    time, merchant = F.col("transaction_timestamp"), F.col("merchant_id")
    ranges = sinks.file_ranges(stored, ["transaction_timestamp", "merchant_id"])
    found = {
        "time": ((time >= low) & (time < high), (F.col("transaction_timestamp_most") >= low) & (F.col("transaction_timestamp_least") < high)),
        "merchant": (merchant <= limit, F.col("merchant_id_least") <= limit),
    }
    rows = stored.agg(*(F.count(F.when(row, 1)).alias(name) for name, (row, _) in found.items()))
    files = ranges.agg(F.count("*").alias("all"), *(F.count(F.when(file, 1)).alias(f"{name}_files") for name, (_, file) in found.items()))
    cells = [
        F.struct(F.lit(n).alias("filter"), F.col(n).alias("n"), (F.col(f"{n}_files") < F.col("all") * 0.75).alias("few_files"))
        for n in found
    ]
    return relational.attach(rows, files).select(F.inline(F.array(*cells)))


@register("compacted_table", sql("cards", "SELECT transaction_type, count(*) AS n, 1 AS folders FROM cards GROUP BY 1"))
def _(spark, folder):
    """Cards that came in eight batches, read from the one folder that they were compacted into."""
    base = fresh_dir(spark, "compacted")
    cards = bindings.cards(spark, folder).withColumn("loaded_at", F.lit(None).cast("timestamp"))
    cards.select(*CARD_TRANSACTIONS.names).repartition(8).write.parquet(f"{base}/stage")
    stream = spark.readStream.schema(CARD_TRANSACTIONS).option("maxFilesPerTrigger", 1).parquet(f"{base}/stage")
    staged = stream.withColumn("source_file", F.lit("stage"))
    changes.load_once(staged, f"{base}/table", f"{base}/offsets").awaitTermination()
    changes.compact(spark, f"{base}/table", CARD_TRANSACTIONS)
    left = sum(len(folders(spark, stream)) for stream in folders(spark, f"{base}/table"))
    rows = changes.read_table(spark, f"{base}/table", CARD_TRANSACTIONS).groupBy("transaction_type")
    return rows.agg(F.count("*").alias("n")).withColumn("folders", F.lit(left))


@register("stream_progress", sql("cards", "SELECT 'refine' AS name, count(*) AS input_rows, true AS finished FROM cards"))
def _(spark, folder):
    """What the listener noted of a load: rows read by all batches, and how it ended."""
    base = fresh_dir(spark, "progress")
    with runs.ProgressLog(spark, f"{base}/history"):
        query = card_stream(spark, folder).writeStream.queryName("refine").format("parquet")
        query.option("checkpointLocation", f"{base}/offsets").trigger(availableNow=True).start(f"{base}/table").awaitTermination()
    rows = runs.progress_history(spark, f"{base}/history").filter("name = 'refine'").groupBy("name")
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.bool_or(F.col("event") == "FINISHED").alias("finished"))


@register(
    "session_role_masks",
    sql("cards", f"SELECT role, transaction_id, cast(amount AS double) AS amount, card_number FROM ({MASKED_SQL})"),
)
def _(spark, folder):
    """One view, read after the session has taken each role in turn."""
    privacy.masked_view(bindings.cards(spark, folder), "masked_cards")
    parts = []
    for role in ROLES:
        privacy.set_role(spark, role)
        parts.append(spark.table("masked_cards").select(F.lit(role).alias("role"), "transaction_id", "amount", "card_number"))
    return plain_amount(relational.union_all(parts))


@register(
    "monthly_card_estimates",
    sql(
        "cards",
        """SELECT strftime(transaction_timestamp, '%Y-%m') AS month, count(DISTINCT card_number) AS exact, true AS within_bound
    FROM cards GROUP BY 1""",
    ),
)
def _(spark, folder):
    """Distinct cards per month from stored daily sketches, beside the exact number; off by three standard errors at most."""
    cards = bindings.cards(spark, folder)
    daily = sinks.materialise(sketches.daily_sketches(cards, "card_number", "transaction_timestamp"), fresh_dir(spark, "sketches"))
    estimated = sketches.distinct_in_span(daily, F.date_format("day", "yyyy-MM").alias("month"))
    month = F.date_format("transaction_timestamp", "yyyy-MM").alias("month")
    exact = cards.groupBy(month).agg(F.countDistinct("card_number").alias("exact"))
    near = F.abs(F.col("distinct_keys") - F.col("exact")) <= 3 * sketches.standard_error() * F.col("exact")
    return exact.join(estimated, "month").select("month", "exact", near.alias("within_bound"))


HISTORY_AS_OF = "2024-01-15 12:00:00"  # with cards on both sides of it


@register(
    "alert_history",
    sql(
        "cards",
        f"""SELECT alert_id, cast(threshold_value AS bigint) AS threshold_value, 2 AS appended, true AS open FROM (
      SELECT 'A001' AS alert_id, 5000 AS threshold_value, (SELECT round(max(amount)) FROM cards
        WHERE transaction_timestamp > timestamp '{HISTORY_AS_OF}' - interval 5 minute
        AND transaction_timestamp <= timestamp '{HISTORY_AS_OF}') > 5000 AS hit
      UNION ALL SELECT 'A004', 1000, (SELECT count(*) FROM cards WHERE transaction_timestamp > timestamp '{HISTORY_AS_OF}') > 1000
    ) WHERE hit""",
    ),
)
def _(spark, folder):
    """Triggered rules of two runs, appended to the history and read back (the rules on amounts and backlog)."""
    cards, path = bindings.cards(spark, folder), fresh_dir(spark, "alert-history")
    past = F.col("transaction_timestamp") <= moment(HISTORY_AS_OF)
    backlog = cards.filter(~past).agg(F.count("*").alias("pending"))
    measured = alerts.measured_alerts(cards.filter(past), quality.measure_daily(cards), backlog, HISTORY_AS_OF)
    rows = alerts.history_rows(alerts.evaluate_rules(alerts.alert_config(spark, HISTORY_AS_OF), measured), HISTORY_AS_OF)
    for _ in range(2):
        rows.write.mode("append").parquet(path)
    stored = spark.read.schema(ALERT_HISTORY).parquet(path).filter("alert_id IN ('A001', 'A004')")
    return stored.groupBy("alert_id", "threshold_value").agg(
        F.count("*").cast("int").alias("appended"), F.bool_and(F.col("resolved_timestamp").isNull()).alias("open")
    )


@register(
    "stream_topic_tables",
    sql(
        "cards r_orders r_items",
        """SELECT 'cards' AS topic, count(*) AS n FROM cards
    UNION ALL SELECT 'lines', count(*) FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
    UNION ALL SELECT 'refused', count(*) FROM cards""",
    ),
)
def _(spark, folder):
    """Two topics through the topic map into their tables; a topic without a table goes to quarantine."""
    base = fresh_dir(spark, "topic-map")
    cards = topics.rows_as_messages(bindings.cards(spark, folder).select("element", "transaction_type"))
    for topic, messages in (("cards", cards), ("other", cards), ("lines", line_messages(spark, folder))):
        topics.publish(messages, f"{base}/topics", topic)
    reader = spark.readStream.schema(topics.ENVELOPE).option("maxFilesPerTrigger", topics.BATCH_FILES)
    envelope = reader.json(f"{base}/topics/*")
    tables = {
        "cards": (f"{base}/cards", struct(element=LONG, transaction_type=TEXT)),
        "lines": (f"{base}/lines", topics.NESTED_MESSAGE),
    }
    topics.topics_to_tables(envelope, tables, f"{base}/offsets", quarantine=f"{base}/refused").awaitTermination()
    counts = [
        changes.read_table(spark, path, schema).agg(F.lit(topic).alias("topic"), F.count("*").alias("n"))
        for topic, (path, schema) in tables.items()
    ]
    refused = changes.read_table(spark, f"{base}/refused", struct(topic=TEXT, data=TEXT, reason=TEXT))
    return relational.union_all([*counts, refused.agg(F.lit("refused").alias("topic"), F.count("*").alias("n"))])


@register(
    "topic_unread",
    sql("cards", "SELECT 'before' AS moment, true AS waiting, count(*) >= 0 AS counted FROM cards UNION ALL SELECT 'after', false, true"),
)
def _(spark, folder):
    """Unread files of a topic before and after its consumer ran."""
    base = fresh_dir(spark, "unread")
    topics.publish(topics.rows_as_messages(bindings.cards(spark, folder).select("element")), f"{base}/topics", "cards")

    def unread(moment: str) -> DataFrame:
        found = topics.topic_statistics(spark, f"{base}/topics", "cards", f"{base}/log")
        waiting = (F.col("queue_size") > 0) & (F.col("bytes") > 0)
        return sinks.materialise(found.select(F.lit(moment).alias("moment"), waiting.alias("waiting"), F.lit(True).alias("counted")), f"{base}/{moment}")

    before = unread("before")
    messages = topics.consume(spark, f"{base}/topics", "cards")
    changes.load_once(messages, f"{base}/table", f"{base}/offsets", f"{base}/log").awaitTermination()
    return before.unionByName(unread("after"))


def _json_files(spark: SparkSession, folder: str, base: str) -> None:
    """Cards as JSON lines in three files: one good, one with broken lines, one of broken lines only."""
    cards = bindings.cards(spark, folder).select("element", F.to_json(F.struct("element", "transaction_type")).alias("line"))
    torn = F.expr("substring(line, 1, length(line) - 3)").alias("value")
    for rest, text in ((0, F.col("line")), (1, F.when(F.col("element") % 2 == 0, torn).otherwise(F.col("line"))), (2, torn)):
        part = cards.filter(F.col("element") % 3 == rest).select(text.alias("value"))
        part.coalesce(1).write.mode("append").text(f"{base}/stage")


@register(
    "load_history_of_broken_files",
    sql(
        "cards",
        """SELECT CASE element % 3 WHEN 0 THEN 'LOADED' WHEN 1 THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
      count(*) AS row_parsed, count(*) FILTER (element % 3 = 0 OR element % 3 = 1 AND element % 2 <> 0) AS row_count,
      count(*) FILTER (element % 3 = 2 OR element % 3 = 1 AND element % 2 = 0) AS error_count, element % 3 > 0 AS has_error
    FROM cards GROUP BY element % 3""",
    ),
)
def _(spark, folder):
    """Status and counts that a load wrote about whole, torn and unreadable files."""
    base = fresh_dir(spark, "broken-files")
    _json_files(spark, folder, base)
    stream = changes.json_stage_stream(spark, f"{base}/stage", struct(element=LONG, transaction_type=TEXT))
    changes.load_once(stream, f"{base}/table", f"{base}/offsets", f"{base}/log").awaitTermination()
    log = changes.load_history(spark, f"{base}/log")
    return log.select("status", "row_parsed", "row_count", "error_count", F.col("first_error_message").isNotNull().alias("has_error"))


@register("stream_stops", sql("cards", "SELECT count(*) AS n, 1 AS stopped, 0 AS left_running FROM cards"))
def _(spark, folder):
    """A scheduled load, stopped with all others after it has caught up."""
    base = fresh_dir(spark, "scheduled")
    staged = card_stream(spark, folder).withColumn("source_file", F.lit("events"))
    query = changes.load_once(staged, f"{base}/table", f"{base}/offsets", every="1 second")
    query.processAllAvailable()
    stopped = runs.stop_all(spark)
    names = [f for f in CARD_TRANSACTIONS.fields if f.name in staged.columns]
    rows = changes.read_table(spark, f"{base}/table", type(CARD_TRANSACTIONS)(names))
    return rows.agg(
        F.count("*").alias("n"), F.lit(sum(s == str(query.id) for s in stopped)).alias("stopped"),
        F.lit(len(spark.streams.active)).alias("left_running"),
    )


@register(
    "card_stand_ins",
    sql("cards", "SELECT card_number, count(*) AS n, true AS stable, true AS in_range FROM cards GROUP BY card_number"),
)
def _(spark, folder):
    """Each card keeps one stand-in, of at most 16 digits, which no other card has."""
    cards = bindings.cards(spark, folder).select("card_number", anonymous_number(F.col("card_number")).alias("stand_in"))
    own = cards.groupBy("card_number", "stand_in").agg(F.count("*").alias("n"))
    holders = own.groupBy("stand_in").agg(F.count("*").alias("holders"))
    in_range = F.col("stand_in").between(0, 9999999999999998)
    return own.join(holders, "stand_in").select("card_number", "n", (F.col("holders") == 1).alias("stable"), in_range.alias("in_range"))


@register("card_sample_ordered", sql("cards", "SELECT element, transaction_id, card_number FROM cards ORDER BY element LIMIT 10"))
def _(spark, folder):
    """The sample with an order: the first ten rows by element."""
    ordered = bindings.cards(spark, folder).orderBy("element")
    return relational.sample_rows(ordered).select("element", "transaction_id", "card_number")

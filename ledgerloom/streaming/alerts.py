"""Alerts and duplicate control on a card stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.alerts import alert_parts, sliding_alerts
from ledgerloom.schemas import LONG, TEXT, TIME, struct
from ledgerloom.sources.sinks import replace_table
from ledgerloom.streaming.changes import batch_folder, trigger


def with_event_time(cards: DataFrame, lateness: str = "15 minutes") -> DataFrame:
    """Event time as an instant with a watermark.

    Rows later than the watermark are left out of alerts; the refined table still stores them.
    """
    return cards.withColumn("event_time", F.col("transaction_timestamp").cast("timestamp")).withWatermark(
        "event_time", lateness
    )


def step_sums(cards: DataFrame, slide: str = "1 minute", lateness: str = "15 minutes") -> DataFrame:
    """Numbers of every slide (window, n, high, yes): one state row per slide, whatever the number of events."""
    parts = alert_parts(with_event_time(cards, lateness))
    return parts.groupBy(F.window("event_time", slide)).agg(*(F.sum(c).alias(c) for c in ("n", "high", "yes")))


def alert_stream(cards: DataFrame, width: str = "15 minutes", slide: str = "1 minute") -> DataFrame:
    """Windows that the watermark has closed, by two stateful steps: slides, then windows of finished slides.

    Only one row per slide is copied into the windows it belongs to, not one per event.
    """
    steps = step_sums(cards, slide, width)
    return sliding_alerts(steps.select(F.window_time("window").alias("event_time"), "n", "high", "yes"), width, slide)


STEP_SUMS = struct(window_start=TIME, n=LONG, high=LONG, yes=LONG)


def step_updates(cards: DataFrame, slide: str = "1 minute", lateness: str = "15 minutes") -> DataFrame:
    """Sums of the slides as they change, for ``update_to``; open ones are included."""
    return step_sums(cards, slide, lateness).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n", "high", "yes"
    )


def current_alerts(
    spark: SparkSession, path: str, width: str = "15 minutes", slide: str = "1 minute"
) -> DataFrame:
    """All windows up to the last event, open ones with what has come so far, from stored ``step_updates``."""
    steps = latest(spark, path, STEP_SUMS, ["window_start"])
    return sliding_alerts(
        steps.select(F.col("window_start").cast("timestamp").alias("event_time"), "n", "high", "yes"), width, slide
    )


def deduplicated(cards: DataFrame, span: str = "30 minutes") -> DataFrame:
    """First row of every transaction id; the state forgets ids after ``span``."""
    return with_event_time(cards, span).dropDuplicatesWithinWatermark(["transaction_id"])


def duplicate_watch(cards: DataFrame, key: str = "transaction_id", minutes: int = 30) -> DataFrame:
    """Keys that come again within ``minutes`` of their previous row, counted per period of that length.

    A row belongs to its own period and, as a look back, to the next one: windows of two periods, one period
    apart. In a period every row but the first has its previous row there; the first one repeats the last row of
    the period before if that is near enough. So a period's state is a count and two times, partial sums are
    built before the shuffle (a hot key sends one row per task), and the watermark ends it. Every change is
    an update, so open periods are reported as well.
    """
    both = with_event_time(cards, f"{minutes} minutes").withColumn(
        "w", F.window("event_time", f"{2 * minutes} minutes", f"{minutes} minutes")
    )
    period = F.col("w.start") + F.expr(f"interval '{int(minutes)}' minute")
    own = F.col("event_time") >= period
    counted = both.groupBy("w", key).agg(
        F.count(F.when(own, 1)).alias("occurrences"),
        F.min(F.when(own, F.col("event_time"))).alias("first"),
        F.max(F.when(~own, F.col("event_time"))).alias("before"),
    )
    near = F.col("first") <= F.col("before") + F.expr(f"interval '{int(minutes)}' minute")
    again = F.col("occurrences") - 1 + F.when(F.coalesce(near, F.lit(False)), 1).otherwise(0)
    return counted.filter("occurrences > 0").select(
        period.cast("timestamp_ntz").alias("window_start"), key, "occurrences", again.alias("repeats")
    ).filter("repeats > 0")


REPEATS = struct(window_start=TIME, card_number=LONG, occurrences=LONG, repeats=LONG)


def update_to(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Stores the changed rows of every batch; a repeated batch replaces its own. ``latest`` reads them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_table(batch, f"{path}/{batch_folder(batch.sparkSession, checkpoint, batch_id)}")

    return (
        df.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def latest(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The last stored update of every key."""
    stored = StructType([*schema.fields, *struct(stream=TEXT, batch_id=LONG).fields])
    rows = spark.read.schema(stored).parquet(path)
    values = F.struct(*[name for name in schema.names if name not in keys])
    last = rows.groupBy(*keys).agg(F.max_by(values, "batch_id").alias("last"))
    return last.select(*keys, "last.*").select(*schema.names)


def append_to(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Exactly-once Parquet output of finished rows."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start(path)
    )

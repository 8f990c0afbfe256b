"""Alert rules, look-back alerts and alert history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalars import literal_rows, moment
from ledgerloom.operators.relational import attach
from ledgerloom.schemas import ALERT_CONFIG, ALERT_HISTORY

# Id, name, type, threshold, comparison, table, column, minutes, channel, active.
ALERT_ROWS = [
    ("A001", "High Value Transaction Alert", "THRESHOLD", 5000, ">", "CC_TRANS_ALL", "AMOUNT", 5, "EMAIL", True),
    ("A002", "Low Approval Rate Alert", "PERCENTAGE", 80, "<", "CC_TRANS_ALL", "APPROVED", 15, "SLACK", True),
    ("A003", "Data Quality Alert", "PERCENTAGE", 90, "<", "DATA_QUALITY_METRICS", "METRIC_VALUE", 10, "EMAIL", True),
    ("A004", "Stream Processing Delay", "COUNT", 1000, ">", "CC_TRANS_STAGING_VIEW_STREAM", "*", 5, "SMS", True),
    ("A005", "Duplicate Transaction Alert", "COUNT", 1, ">", "CC_TRANS_ALL", "TRANSACTION_ID", 30, "EMAIL", True),
]

HIGH_VALUE = 5000
LOW_APPROVAL = 80
BACKLOG = 1000


def alert_config(spark: SparkSession, as_of: str) -> DataFrame:
    rows = literal_rows(spark, ALERT_ROWS, StructType(ALERT_CONFIG.fields[:-1]))
    return rows.withColumn("created_date", moment(as_of))


def within(df: DataFrame, minutes: int, as_of: str, time: str = "transaction_timestamp") -> DataFrame:
    """Rows of the last minutes before ``as_of``; the limit itself is out."""
    return df.filter(
        (F.col(time) > moment(as_of) - F.expr(f"interval '{int(minutes)}' minute"))
    )


def approval_rate() -> Column:
    """Approved share in percent as a whole number; NULL without rows."""
    return F.round(F.avg(F.when(F.col("approved"), 100.0).otherwise(0.0)), 0).cast("decimal(38,0)")


def measured_alerts(cards: DataFrame, metrics: DataFrame, backlog: DataFrame, as_of: str) -> DataFrame:
    """Current value of every rule: (alert_id, alert_value).

    A rule over single rows is measured by its extreme value, a percentage by its rate, a count by its
    size. ``backlog`` is a one-row frame (``pending``).
    """
    whole = "decimal(38,0)"

    def last(minutes: int) -> Column:
        return F.col("transaction_timestamp") > moment(as_of) - F.expr(f"interval '{minutes}' minute")

    # One pass over the last half hour: per transaction for the repeats, then over all.
    near = F.when(last(15), F.when(F.col("approved"), 100.0).otherwise(0.0))
    parts = within(cards, 30, as_of).groupBy("transaction_id").agg(
        F.max(F.when(last(5), F.col("amount"))).alias("high"),
        F.sum(near).alias("rate"),
        F.count(near).alias("rated"),
        F.count("*").alias("n"),
    )
    rules = {
        "A001": F.max("high"),
        "A002": F.round(F.try_divide(F.sum("rate"), F.sum("rated")), 0),
        "A005": F.max("n"),
    }
    values = [F.struct(F.lit(i).alias("alert_id"), v.cast(whole).alias("alert_value")) for i, v in rules.items()]
    measured = parts.agg(F.array(*values).alias("rules")).select(F.inline("rules"))
    worst = within(metrics, 10, as_of, "measurement_timestamp").agg(F.min("metric_value").cast(whole).alias("alert_value"))
    waiting = backlog.select(F.col("pending").cast(whole).alias("alert_value"))
    for alert_id, frame in {"A003": worst, "A004": waiting}.items():
        measured = measured.unionByName(frame.select(F.lit(alert_id).alias("alert_id"), "alert_value"))
    return measured


def triggered(value: Column, operator: Column, threshold: Column) -> Column:
    """Comparison named by a rule row; a NULL value triggers nothing."""
    return F.coalesce(
        F.when(operator == ">", value > threshold)
        .when(operator == "<", value < threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "<=", value <= threshold)
        .when(operator == "=", value == threshold),
        F.lit(False),
    )


def evaluate_rules(config: DataFrame, measured: DataFrame) -> DataFrame:
    """Active rules with their measured value and whether they trigger."""
    # One row per rule on both sides.
    return (
        config.filter("is_active")
        .join(F.broadcast(measured), "alert_id", "left")
        .select(
            "alert_id",
            "alert_name",
            "alert_value",
            "comparison_operator",
            "threshold_value",
            triggered(
                F.col("alert_value"), F.col("comparison_operator"), F.col("threshold_value")
            ).alias("is_triggered"),
        )
    )


def history_rows(evaluated: DataFrame, as_of: str) -> DataFrame:
    """Rows to append to the alert history."""
    text = F.concat_ws(
        " ",
        "alert_name",
        F.lit(":"),
        F.col("alert_value").cast("string"),
        "comparison_operator",
        F.col("threshold_value").cast("string"),
    )
    rows = evaluated.filter("is_triggered").select(
        "alert_id",
        "alert_name",
        "alert_value",
        "threshold_value",
        moment(as_of).alias("alert_timestamp"),
        text.alias("alert_message"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_timestamp"),
        F.lit(None).cast("string").alias("resolved_by"),
    )
    return rows.select(*ALERT_HISTORY.names)


def run_alerts(cards: DataFrame, backlog: DataFrame, as_of: str) -> DataFrame:
    """One row: number of alerts and the message of an alert run.

    Both look-back windows are measured in one pass over the last fifteen minutes.
    """
    last_five = F.col("transaction_timestamp") > moment(as_of) - F.expr("interval '5' minute")
    high = F.count(F.when((F.col("amount") > HIGH_VALUE) & last_five, 1)).alias("high_value_count")
    # Rows below the high-value limit are needed for the rate, so only the time range is pushed down.
    checks = attach(
        within(cards, 15, as_of).agg(high, approval_rate().alias("approval_rate")),
        backlog.select(F.col("pending").alias("stream_count")),
    )
    high_on = F.col("high_value_count") > 0
    rate_on = F.coalesce(F.col("approval_rate") < LOW_APPROVAL, F.lit(False))
    backlog_on = F.col("stream_count") > BACKLOG
    number = high_on.cast("int") + rate_on.cast("int") + backlog_on.cast("int")

    def part(on: Column, head: str, value: str, tail: str) -> Column:
        return F.when(on, F.concat(F.lit(head), F.col(value).cast("string"), F.lit(tail))).otherwise("")

    message = F.concat(
        part(high_on, "HIGH VALUE ALERT: ", "high_value_count", " transactions over $5000 detected. "),
        part(rate_on, "APPROVAL RATE ALERT: Rate dropped to ", "approval_rate", "%. "),
        part(backlog_on, "STREAM BACKLOG ALERT: ", "stream_count", " unprocessed records. "),
    )
    return checks.withColumn("alert_count", number).select(
        "high_value_count",
        F.col("approval_rate").cast("bigint").alias("approval_rate"),
        "stream_count",
        "alert_count",
        F.when(
            F.col("alert_count") > 0,
            F.concat(
                F.lit("ALERTS TRIGGERED ("), F.col("alert_count").cast("string"), F.lit("): "), message
            ),
        )
        .otherwise("No alerts triggered - system operating normally")
        .alias("message"),
    )


def alert_parts(cards: DataFrame) -> DataFrame:
    """Every row as the numbers the windows add up; needs ``event_time timestamp``."""
    return cards.select(
        "event_time",
        F.lit(1).alias("n"),
        F.when(F.col("amount") > HIGH_VALUE, 1).otherwise(0).alias("high"),
        F.when(F.col("approved"), 1).otherwise(0).alias("yes"),
    )


def window_alerts(cards: DataFrame, width: str = "15 minutes", slide: str = "1 minute") -> DataFrame:
    """Sliding-window counts of high amounts and the approval rate of a batch.

    Rows are added up per slide first, because a row belongs to many windows and all rows of one slide
    belong to the same ones.
    """
    step = F.window("event_time", slide).alias("step")
    sums = [F.sum(c).alias(c) for c in ("n", "high", "yes")]
    per_step = alert_parts(cards).groupBy(step).agg(*sums)
    return sliding_alerts(
        per_step.select(F.col("step.start").alias("event_time"), "n", "high", "yes"), width, slide
    )


def sliding_alerts(parts: DataFrame, width: str, slide: str) -> DataFrame:
    """Sum the parts per window; as a stream, the state is one row per open window."""
    return (
        parts.groupBy(F.window("event_time", width, slide))
        .agg(
            F.sum("n").alias("transactions"),
            F.sum("high").alias("high_value_count"),
            F.round(F.sum("yes") * 100.0 / F.sum("n"), 0).cast("bigint").alias("approval_rate"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "transactions",
            "high_value_count",
            "approval_rate",
            (F.col("high_value_count") > 0).alias("high_value_alert"),
            (F.col("approval_rate") < LOW_APPROVAL).alias("approval_alert"),
        )
    )

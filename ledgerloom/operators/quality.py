"""Data quality: card checks, metric table and its views, retail frame checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.quantiles import exact_quantiles
from ledgerloom.functions.scalars import choose, day_label, digits, elapsed_days, moment, share
from ledgerloom.operators.relational import attach, with_share


def tally(condition: Column) -> Column:
    """Rows where the condition holds; NULL on an empty input, as a conditional sum is."""
    return F.sum(F.when(condition, 1).otherwise(0))


# --- card table --------------------------------------------------------------------------------


# Check, its column, lower and upper limit; and the digits a card number has.
RANGES = (
    ("Amount Validation", "amount", 0, 10_000),
    ("Transaction ID Validation", "transaction_id", 1_000_000_000, 9_999_999_999),
)
CARD_DIGITS = (15, 19)


def range_validation(cards: DataFrame) -> DataFrame:
    """Amount and transaction id range checks, from a single pass."""

    def line(label: str, column: str, low: int, high: int) -> Column:
        value = F.col(column)
        return F.struct(
            F.lit(label).alias("check_type"),
            F.count("*").alias("total_records"),
            tally(value < low).alias("negative_amounts"),
            tally(value > high).alias("excessive_amounts"),
            tally(value.isNull()).alias("null_amounts"),
        )

    return cards.agg(F.array(*[line(*check) for check in RANGES]).alias("lines")).select(F.inline("lines"))


CARD_REQUIRED = {
    "transaction_id": "null_transaction_id",
    "amount": "null_amount",
    "currency": "null_currency",
    "card_number": "null_card_number",
    "merchant_id": "null_merchant_id",
    "transaction_timestamp": "null_timestamp",
}


def null_report(cards: DataFrame, columns: Mapping[str, str] = CARD_REQUIRED) -> DataFrame:
    return cards.agg(*[tally(F.col(c).isNull()).alias(name) for c, name in columns.items()])


def card_format(cards: DataFrame) -> DataFrame:
    length = digits(F.col("card_number"))
    return cards.agg(
        F.count("*").alias("total_cards"),
        tally(length < CARD_DIGITS[0]).alias("short_card_numbers"),
        tally(length > CARD_DIGITS[1]).alias("long_card_numbers"),
        tally(F.col("card_number") < 0).alias("negative_card_numbers"),
    )


def distributions(cards: DataFrame) -> DataFrame:
    """Share of every transaction type and of every currency; the names of the first part hold for both."""
    both = cards.groupBy("transaction_type", "currency").agg(F.count("*").alias("n"))

    def part(label: str, column: str) -> DataFrame:
        counts = both.groupBy(F.col(column).alias("transaction_type")).agg(F.sum("n").alias("count"))
        return with_share(counts, "count").select(
            F.lit(label).alias("anomaly_check"), "transaction_type", "count", "percentage"
        )

    return part("Transaction Type Distribution", "transaction_type").unionByName(
        part("Currency Distribution", "currency")
    )


def card_metrics() -> dict[tuple[str, str], Column]:
    """Category and name of every metric with the condition a good row meets."""
    return {
        ("COMPLETENESS", "COMPLETENESS_TRANSACTION_ID"): F.col("transaction_id").isNotNull(),
        ("COMPLETENESS", "COMPLETENESS_AMOUNT"): F.col("amount").isNotNull(),
        ("COMPLETENESS", "COMPLETENESS_CARD_NUMBER"): F.col("card_number").isNotNull(),
        ("VALIDITY", "VALIDITY_AMOUNT_RANGE"): F.col("amount").between(0, 10000),
        ("VALIDITY", "VALIDITY_CARD_NUMBER_FORMAT"): digits(F.col("card_number")).between(15, 19),
        ("CONSISTENCY", "CONSISTENCY_CURRENCY_USD"): F.col("currency") == "USD",
        ("CONSISTENCY", "CONSISTENCY_TRANSACTION_TYPES"): F.col("transaction_type").isin(
            "PURCHASE", "REFUND"
        ),
    }


def measure(
    cards: DataFrame,
    at: Column,
    metrics: Mapping[tuple[str, str], Column] | None = None,
    table_name: str = "CC_TRANS_ALL",
    *keys: str,
) -> DataFrame:
    """Measure all metrics in one pass (per key, if any) as rows of the metric table."""
    metrics = card_metrics() if metrics is None else metrics
    value = lambda ok: F.round(
        tally(ok).cast("decimal(20,0)") * 100 / F.nullif(F.count("*"), F.lit(0)), 4
    ).cast("decimal(10,4)")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric_name"),
                F.lit(category).alias("metric_category"),
                value(ok).alias("metric_value"),
                F.count("*").alias("total_records"),
            )
            for (category, name), ok in metrics.items()
        ]
    )
    return (
        cards.groupBy(*keys)
        .agg(rows.alias("rows"))
        .select(*keys, F.inline("rows"))
        .select(
            "metric_name",
            "metric_category",
            "metric_value",
            "total_records",
            at.alias("measurement_timestamp"),
            F.lit(table_name).alias("table_name"),
        )
    )


def measure_daily(cards: DataFrame) -> DataFrame:
    """Metric history: every day measured at its end."""
    daily = cards.withColumn("day", F.date_trunc("day", "transaction_timestamp"))
    at = (F.col("day") + F.expr("interval '1' day")).cast("timestamp_ntz")
    return measure(daily, at, None, "CC_TRANS_ALL", "day")


# The least metric of each rating, the rating below all, and the limits of the alert levels.
RATINGS = (("EXCELLENT", 95), ("GOOD", 90), ("ACCEPTABLE", 80), ("POOR", 70))
LOWEST_RATING = "CRITICAL"
ALERT_LEVELS = (("CRITICAL", 70), ("WARNING", 80))


def alert_message(limit: int) -> str:
    return f"Metric below {limit}% threshold"


def rating(metric: Column) -> Column:
    return choose({name: metric >= least for name, least in RATINGS}, F.lit(LOWEST_RATING))


def dashboard(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "metric_category",
        "metric_name",
        "metric_value",
        rating(F.col("metric_value")).alias("quality_rating"),
        "total_records",
        "measurement_timestamp",
    )


def quality_alerts(metrics: DataFrame) -> DataFrame:
    """Metrics below the critical limit, and those up to the warning limit (both limits included) as a warning."""
    value = F.col("metric_value")
    critical, warning = (limit for _, limit in ALERT_LEVELS)
    level = F.when(value < critical, "CRITICAL").when(value.between(critical, warning), "WARNING")
    message = F.when(value < critical, alert_message(critical)).otherwise(alert_message(warning))
    return metrics.filter(value <= warning).select(
        "metric_name",
        "metric_value",
        level.alias("alert_level"),
        message.alias("alert_message"),
        "measurement_timestamp",
    )


def quality_trends(metrics: DataFrame) -> DataFrame:
    """Previous value and change of every metric; one row per metric and measurement."""
    in_time = Window.partitionBy("metric_name").orderBy("measurement_timestamp")
    before = F.lag("metric_value").over(in_time)
    return metrics.select(
        "metric_name",
        "metric_category",
        "metric_value",
        before.alias("previous_value"),
        (F.col("metric_value") - before).alias("trend_change"),
        "measurement_timestamp",
    )


def monitor(
    cards: DataFrame, history: DataFrame, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """Drop measurements older than a day, measure completeness of the id, report critical ones.

    Returns the new metric table and a one-row status frame.
    """
    now = moment(as_of)
    key = ("COMPLETENESS", "COMPLETENESS_TRANSACTION_ID")
    fresh = measure(cards, now, {key: card_metrics()[key]})
    kept = history.filter(F.col("measurement_timestamp") >= now - F.expr("interval '1' day"))
    table = kept.unionByName(fresh)
    last_hour = F.col("measurement_timestamp") > now - F.expr("interval '1' hour")
    status = table.agg(
        F.count(F.when((F.col("metric_value") < 70) & last_hour, 1)).alias("critical_count")
    ).select(
        "critical_count",
        F.when(
            F.col("critical_count") > 0,
            F.concat(
                F.lit("ALERT: "),
                F.col("critical_count").cast("string"),
                F.lit(" critical data quality issues detected!"),
            ),
        )
        .otherwise("Data quality monitoring completed successfully")
        .alias("status"),
    )
    return table, status


# --- retail frame ------------------------------------------------------------------------------


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percent, most incomplete first."""
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(tally(F.col(c).isNull()), F.lit(0)).alias("missing"),
            F.count("*").alias("_rows"),
        )
        for c in df.columns
    ]
    return (
        df.agg(F.array(*cells).alias("cells"))
        .select(F.inline("cells"))
        .filter(F.col("missing") > 0)
        .select(
            "column_name",
            "missing",
            F.round(
                F.col("missing").cast("decimal(20,0)") * 100 / F.col("_rows").cast("decimal(20,0)"), 2
            )
            .cast("double")
            .alias("percent"),
        )
        .orderBy(F.desc("missing"), "column_name")
    )


def _rate(condition: Column) -> Column:
    """Success rate in percent with two decimals; NULL does not pass."""
    return F.round(share(tally(condition), F.count("*")), 2)


def consistency_conditions(as_of: str) -> dict[str, Column]:
    product = (F.col("quantity") * F.col("price_at_purchase")).cast("decimal(28,2)")
    return {
        "Prix > 0": F.col("price_at_purchase") > 0,
        "Quantité > 0": F.col("quantity") > 0,
        "Date ≤ Aujourd'hui": F.col("order_date") <= moment(as_of),
        "TOTAL_SALE = QTY × PRICE": product == F.col("total_sale").cast("decimal(28,2)"),
    }


def consistency_checks(df: DataFrame, as_of: str) -> DataFrame:
    """Four checks with status and success rate; the last passes above 99 percent."""
    lines = []
    for label, ok in consistency_conditions(as_of).items():
        passed = tally(ok)
        enough = (
            passed > F.count("*") * 0.99 if label.startswith("TOTAL") else passed == F.count("*")
        )
        lines.append(
            F.struct(
                F.lit(label).alias("check_name"),
                F.when(enough, "Passed").otherwise("Failed").alias("status"),
                _rate(ok).alias("success_rate"),
            )
        )
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def frame_summary(df: DataFrame, as_of: str) -> DataFrame:
    """Record count, distinct keys, completeness and validity of the joined frame, in one pass.

    Distinct orders, customers and products are counted apart, see :func:`distinct_keys`.
    """
    missing = sum((tally(F.col(c).isNull()) for c in df.columns), F.lit(0))
    cells = F.count("*") * len(df.columns)
    rates = [_rate(ok) for ok in consistency_conditions(as_of).values()]
    return df.agg(
        F.count("*").alias("total_records"),
        share(cells - missing, cells).alias("completeness"),
        share(tally(F.col("total_sale") > 0), F.count("*")).alias("validity"),
        (sum(rates, F.lit(0.0)) / len(rates)).alias("mean_rate"),
    )


def completeness(df: DataFrame, as_of: str) -> DataFrame:
    return frame_summary(df, as_of).select(
        "total_records",
        F.round("completeness", 4).alias("completeness"),
        F.round("validity", 4).alias("validity"),
    )


def distinct_keys(df: DataFrame) -> DataFrame:
    """Distinct orders, customers and products, each from its own narrow aggregation."""
    parts = [
        df.agg(F.countDistinct(c).alias(name))
        for c, name in (
            ("order_id", "orders"),
            ("customer_id", "customers"),
            ("product_id", "products"),
        )
    ]
    first, second, third = parts
    return attach(attach(first, second), third)


def cancelled_share(orders: DataFrame) -> DataFrame:
    cancelled = tally(F.col("order_status") == "cancelled")
    return orders.agg(
        F.count("*").alias("total_orders"),
        cancelled.alias("cancelled_orders"),
        F.coalesce(share(cancelled, F.count("*")), F.lit(0.0)).alias("cancelled_percent"),
    )


def outlier_report(df: DataFrame, column: str = "total_sale") -> DataFrame:
    """Rows outside 1.5 interquartile ranges, with limits and share of all rows."""
    edges = exact_quantiles(df, [column], [0.25, 0.75]).select(
        F.col(column)[0].alias("q1"), F.col(column)[1].alias("q3")
    )
    limits = edges.select(
        "q1",
        "q3",
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("low"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("high"),
    )
    x = F.col("x")
    return (
        attach(df.select(F.col(column).cast("double").alias("x")), limits)
        .agg(
            F.round(F.max("q1"), 4).alias("q1"),
            F.round(F.max("q3"), 4).alias("q3"),
            tally((x < F.col("low")) | (x > F.col("high"))).alias("outliers"),
            F.count("*").alias("total_records"),
        )
        .withColumn(
            "outlier_percent", share(F.col("outliers"), F.col("total_records"))
        )
    )


def freshness(df: DataFrame, as_of: str) -> DataFrame:
    return df.agg(F.max("order_date").alias("newest"), F.min("order_date").alias("oldest")).select(
        day_label(F.col("newest")).alias("newest"),
        day_label(F.col("oldest")).alias("oldest"),
        elapsed_days(F.col("newest"), moment(as_of)).alias("days_since"),
    )


def quality_score(df: DataFrame, as_of: str) -> DataFrame:
    """Weighted score of completeness, uniqueness, validity and consistency with its band."""
    conditions = list(consistency_conditions(as_of).values())
    # One pass over the joined frame: counts per order and product, of which all figures are sums.
    counts = {
        "missing": sum((tally(F.col(c).isNull()) for c in df.columns), F.lit(0)),
        "valid": tally(F.col("total_sale") > 0),
        **{f"passed_{i}": tally(c) for i, c in enumerate(conditions)},
    }
    per_key = df.groupBy("order_id", "product_id").agg(
        F.count("*").alias("n"), *[c.alias(name) for name, c in counts.items()]
    )
    total, cells = F.sum("n"), F.sum("n") * len(df.columns)
    rates = [F.round(share(F.sum(f"passed_{i}"), total), 2) for i in range(len(conditions))]
    figures = per_key.agg(
        F.coalesce(total, F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        share(cells - F.sum("missing"), cells).alias("completeness"),
        share(F.sum("valid"), total).alias("validity"),
        (sum(rates, F.lit(0.0)) / len(rates)).alias("mean_rate"),
    )
    score = (
        F.col("completeness") * 0.3
        + (100 - share(F.col("duplicate_rows"), F.col("total_records"))) * 0.2
        + F.col("validity") * 0.2
        + F.col("mean_rate") * 0.3
    )
    band = choose({"EXCELLENT": F.col("s") >= 95, "GOOD": F.col("s") >= 80}, F.lit("INSUFFICIENT"))
    return (
        figures.withColumn("s", score)
        .select(
            "total_records",
            "duplicate_rows",
            F.round("completeness", 4).alias("completeness"),
            F.round("validity", 4).alias("validity"),
            F.round("mean_rate", 4).alias("mean_rate"),
            F.round("s", 4).alias("quality_score"),
            band.alias("band"),
        )
    )

"""Registered card queries: JSON paths, checks, masks, alerts, lineage, history, cost, layouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions import scalars
from ledgerloom.functions.scalars import json_value, second_boundaries
from ledgerloom.operators import alerts, cost, lineage, monitoring, privacy, quality, relational
from ledgerloom.operators.facts import typed_cards
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import CARD_AS_OF, RETENTION_AS_OF, register
from ledgerloom.session import fresh_dir
from ledgerloom.sources import bindings, sinks


def on(source: Callable[[SparkSession, str], DataFrame], needs: str):
    """Registration of operators over one bound table."""

    def named(name: str, text: str | None = None):
        def add(op: Callable[[DataFrame], DataFrame]):
            @register(name, sql(needs, text) if text else None)
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return op(source(spark, folder))

            return op

        return add

    return named


on_cards = on(bindings.cards, "cards")
on_staging = on(bindings.card_staging, "cards")
on_runs = on(bindings.run_history, "runs")
on_loads = on(bindings.load_log, "loads")
on_flows = on(bindings.object_flows, "flows")
on_daily = on(lambda s, d: quality.measure_daily(bindings.cards(s, d)), "daily_metrics")

ALL_COLUMNS = """element, object_type, transaction_id, transaction_type,
    cast(amount AS double) AS amount, currency, transaction_timestamp, approved, card_number, merchant_id"""


def plain_amount(cards: DataFrame) -> DataFrame:
    return cards.withColumn("amount", F.col("amount").cast("double"))


# --- JSON paths --------------------------------------------------------------------------------


@on_staging("json_card_numbers", "SELECT element, card_number FROM cards")
def _(staging):
    get = lambda path: json_value(F.col("json_data"), path, "bigint")
    return staging.select(get("$.element").alias("element"), get("$.card.number").alias("card_number"))


@on_staging("json_typed_view", f"SELECT {ALL_COLUMNS} FROM cards")
def _(staging):
    return plain_amount(typed_cards(staging))


@on_staging(
    "json_small_amounts",
    "SELECT element, cast(amount AS double) AS amount FROM cards WHERE amount < 599.5",
)
def _(staging):
    amount = json_value(F.col("json_data"), "$.transaction.amount", "decimal(10,2)")
    whole = json_value(F.col("json_data"), "$.transaction.amount", "decimal(38,0)")
    return staging.filter(whole < 600).select(
        json_value(F.col("json_data"), "$.element", "bigint").alias("element"),
        amount.cast("double").alias("amount"),
    )


@register(
    "json_properties",
    """SELECT cast(json_extract(props, '$.k') AS bigint) AS k, count(*) AS n FROM events GROUP BY 1""",
)
def _(spark, folder):
    key = json_value(F.parse_json("props"), "$.k", "bigint")
    return bindings.table(spark, folder, "events").groupBy(key.alias("k")).agg(F.count("*").alias("n"))


# --- aggregates --------------------------------------------------------------------------------


@on_cards(
    "recent_cards",
    f"SELECT {ALL_COLUMNS} FROM cards ORDER BY transaction_timestamp DESC, transaction_id LIMIT 10",
)
def _(cards):
    return plain_amount(relational.most_recent(cards, "transaction_timestamp", ["transaction_id"]))


on_cards(
    "approval_statistics",
    """SELECT approved, count(*) AS transaction_count, cast(sum(amount) AS double) / count(*) AS avg_amount,
    cast(min(amount) AS double) AS min_amount, cast(max(amount) AS double) AS max_amount,
    cast(sum(amount) AS double) AS total_amount FROM cards GROUP BY approved""",
)(lambda cards: relational.group_statistics(cards, "approved"))
on_cards(
    "approved_headline",
    """SELECT cast(sum(amount) FILTER (approved) AS double) / count(*) FILTER (approved)
    AS avg_approved_amount, max(transaction_timestamp) AS latest_transaction FROM cards""",
)(relational.approved_headline)
on_cards(
    "hourly_counts",
    "SELECT cast(hour(transaction_timestamp) AS int) AS hour_of_day, count(*) AS orders FROM cards GROUP BY 1",
)(lambda cards: relational.hourly_counts(cards, "transaction_timestamp"))
on_cards(
    "duplicate_transactions",
    """SELECT transaction_id, count(*) AS duplicate_count FROM cards GROUP BY 1 HAVING count(*) > 1""",
)(lambda cards: relational.repeated(cards, "transaction_id"))
on_cards(
    "repeated_cards",
    "SELECT card_number, count(*) AS duplicate_count FROM cards GROUP BY 1 HAVING count(*) > 1",
)(lambda cards: relational.repeated(cards, "card_number"))


@on_cards(
    "routed_events",
    """SELECT transaction_id, transaction_type, cast(amount AS double) AS amount, route FROM (
    SELECT *, 'FULFILLMENT' AS route FROM cards WHERE transaction_type LIKE 'PURCHASE%'
    UNION ALL SELECT *, 'VIP' FROM cards WHERE amount > 100)""",
)
def _(cards):
    return plain_amount(
        relational.route_events(cards, "transaction_type", "amount", "PURCHASE", 100)
    ).select("transaction_id", "transaction_type", "amount", "route")


@on_cards(
    "amounts_in_range",
    """SELECT transaction_type, count(*) AS n FROM cards
    WHERE transaction_type IN ('PURCHASE','REFUND') AND amount BETWEEN 0 AND 10000 GROUP BY 1""",
)
def _(cards):
    return (
        cards.filter(
            F.col("transaction_type").isin("PURCHASE", "REFUND") & F.col("amount").between(0, 10000)
        )
        .groupBy("transaction_type")
        .agg(F.count("*").alias("n"))
    )


@on_cards(
    "last_week",
    f"""SELECT count(*) AS n, cast(sum(amount) AS double) AS total FROM cards
    WHERE transaction_timestamp >= cast(timestamp '{CARD_AS_OF}' AS date) - 7""",
)
def _(cards):
    since = F.date_sub(F.lit(CARD_AS_OF).cast("timestamp_ntz").cast("date"), 7).cast("timestamp_ntz")
    return cards.filter(F.col("transaction_timestamp") >= since).agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("total")
    )


# --- card quality ------------------------------------------------------------------------------

# The twins of the checks state each check's definition over its fixed limits.
on_cards(
    "range_validation",
    """SELECT check_type, count(*) AS total_records, count(*) FILTER (value < low) AS negative_amounts,
    count(*) FILTER (value > high) AS excessive_amounts, count(*) - count(value) AS null_amounts FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{check}' AS check_type, cast({column} AS double) AS value, {low} AS low, {high} AS high FROM cards"
        for check, column, low, high in quality.RANGES
    )
    + ") GROUP BY check_type",
)(quality.range_validation)
on_cards(
    "card_null_report",
    "SELECT " + ", ".join(f"count(*) - count({c}) AS {name}" for c, name in quality.CARD_REQUIRED.items()) + " FROM cards",
)(quality.null_report)
on_cards(
    "card_format",
    f"""SELECT count(*) AS total_cards, count(*) FILTER (n < {quality.CARD_DIGITS[0]}) AS short_card_numbers,
    count(*) FILTER (n > {quality.CARD_DIGITS[1]}) AS long_card_numbers,
    count(*) FILTER (card_number < 0) AS negative_card_numbers
    FROM (SELECT card_number, length(cast(card_number AS varchar)) AS n FROM cards)""",
)(quality.card_format)
on_cards(
    "distribution_anomalies",
    """SELECT CASE grouping(currency) WHEN 1 THEN 'Transaction Type' ELSE 'Currency' END || ' Distribution'
      AS anomaly_check,
    CASE grouping(currency) WHEN 1 THEN transaction_type ELSE currency END AS transaction_type,
    count(*) AS count, count(*)::double * 100 / (SELECT count(*) FROM cards)::double AS percentage
    FROM cards GROUP BY GROUPING SETS ((transaction_type), (currency))""",
)(quality.distributions)


def _plain_metric(df: DataFrame) -> DataFrame:
    return df.withColumn("metric_value", F.col("metric_value").cast("double"))


@on_cards(
    "quality_metrics",
    f"""SELECT metric_name, split_part(metric_name, '_', 1) AS metric_category,
    cast((good * 2000000 + n) // (2 * n) AS double) / 10000 AS metric_value, n AS total_records,
    timestamp '{CARD_AS_OF}' AS measurement_timestamp, 'CC_TRANS_ALL' AS table_name
    FROM (SELECT count(*) AS n, unnest(['COMPLETENESS_TRANSACTION_ID','COMPLETENESS_AMOUNT',
      'COMPLETENESS_CARD_NUMBER','VALIDITY_AMOUNT_RANGE','VALIDITY_CARD_NUMBER_FORMAT',
      'CONSISTENCY_CURRENCY_USD','CONSISTENCY_TRANSACTION_TYPES']) AS metric_name,
      unnest([count(transaction_id), count(amount), count(card_number),
        count(*) FILTER (amount BETWEEN 0 AND 10000),
        count(*) FILTER (length(cast(card_number AS varchar)) BETWEEN 15 AND 19),
        count(*) FILTER (currency = 'USD'),
        count(*) FILTER (transaction_type IN ('PURCHASE','REFUND'))]) AS good FROM cards)""",
)
def _(cards):
    return _plain_metric(quality.measure(cards, F.lit(CARD_AS_OF).cast("timestamp_ntz")))


@on_daily(
    "quality_dashboard",
    f"""SELECT metric_category, metric_name, metric_value,
    CASE {' '.join(f"WHEN metric_value >= {least} THEN '{name}'" for name, least in quality.RATINGS)}
      ELSE '{quality.LOWEST_RATING}' END AS quality_rating, total_records, measurement_timestamp FROM daily_metrics""",
)
def _(metrics):
    return _plain_metric(quality.dashboard(metrics))


@on_daily(
    "quality_alerts",
    " UNION ALL ".join(
        f"""SELECT metric_name, metric_value, '{level}' AS alert_level, '{quality.alert_message(limit)}' AS alert_message,
        measurement_timestamp FROM daily_metrics WHERE metric_value {condition}"""
        for (level, limit), condition in zip(
            quality.ALERT_LEVELS, (f"< {quality.ALERT_LEVELS[0][1]}", "BETWEEN {} AND {}".format(*(n for _, n in quality.ALERT_LEVELS)))
        )
    ),
)
def _(metrics):
    return _plain_metric(quality.quality_alerts(metrics))


@on_daily(
    "quality_trends",
    """SELECT metric_name, metric_category, metric_value, lag(metric_value) OVER w AS previous_value,
    round(metric_value - lag(metric_value) OVER w, 4) AS trend_change, measurement_timestamp
    FROM daily_metrics WINDOW w AS (PARTITION BY metric_name ORDER BY measurement_timestamp)""",
)
def _(metrics):
    trends = quality.quality_trends(metrics)
    plain = {c: F.col(c).cast("double") for c in ("metric_value", "previous_value", "trend_change")}
    return trends.withColumns(plain)


@on_cards(
    "quality_monitor",
    f"""SELECT count(*) FILTER (metric_value < 70 AND measured > timestamp '{CARD_AS_OF}' - interval 1 hour)
      AS critical_count,
    CASE WHEN count(*) FILTER (metric_value < 70 AND measured > timestamp '{CARD_AS_OF}' - interval 1 hour) > 0
      THEN 'ALERT: ' || count(*) FILTER (metric_value < 70 AND measured > timestamp '{CARD_AS_OF}' - interval 1 hour)
        || ' critical data quality issues detected!'
      ELSE 'Data quality monitoring completed successfully' END AS status
    FROM (SELECT metric_value, measurement_timestamp AS measured FROM (
      SELECT cast(date_trunc('day', transaction_timestamp) AS timestamp) + interval 1 day
        AS measurement_timestamp, count(*) FILTER (transaction_type IN ('PURCHASE','REFUND')) * 100.0
        / count(*) AS metric_value FROM cards GROUP BY 1))""",
)
def _(cards):
    return quality.monitor(cards, quality.measure_daily(cards), CARD_AS_OF)[1]


# --- masks -------------------------------------------------------------------------------------


def ladder(column: str, steps, last) -> str:
    """The label of the first bound that a column exceeds."""
    text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {column} > {b} THEN {text(v)}" for b, v in steps) + f" ELSE {text(last)} END"


def _loaded(cards: DataFrame) -> DataFrame:
    """The event table knows no load time; five minutes after the transaction stand for it."""
    return cards.withColumn("loaded_at", F.col("transaction_timestamp") + F.expr("interval 5 minute"))


@on_cards(
    "analyst_view",
    """SELECT element, object_type, transaction_id, transaction_type,
    cast(round(amount, -2) AS double) AS amount, currency,
    cast(date_trunc('day', transaction_timestamp) AS timestamp) AS transaction_date, approved,
    '****-****-****-' || right(cast(card_number AS varchar), 4) AS masked_card_number, merchant_id,
    transaction_timestamp + interval 5 minute AS loaded_at FROM cards""",
)
def _(cards):
    return plain_amount(privacy.analyst_view(_loaded(cards)))


on_cards(
    "auditor_view",
    f"""SELECT * EXCLUDE (transaction_id, amount, transaction_timestamp, card_number),
    sha256(transaction_id::varchar) AS hashed_transaction_id,
    {ladder('amount', scalars.AMOUNT_RANGES, scalars.LOWEST_RANGE)} AS amount_range,
    date_trunc('month', transaction_timestamp)::timestamp AS transaction_month, 'MASKED' AS card_number,
    transaction_timestamp + interval 5 minute AS loaded_at FROM cards""",
)(lambda cards: privacy.auditor_view(_loaded(cards)))

ROLES = ["DATA_ADMIN_ROLE", "ANALYST_ROLE", "AUDITOR_ROLE", "PUBLIC"]
# What each role sees: amount and card number, as expressions over the cards.
SEEN = {
    "DATA_ADMIN_ROLE": ("amount", "card_number"),
    "ANALYST_ROLE": ("round(amount, -2)", "right(card_number::varchar, 4)::bigint"),
    "AUDITOR_ROLE": (ladder("amount", privacy.RANGE_VALUES, privacy.LOWEST_VALUE), "0"),
    "PUBLIC": ("0", "0"),
}
MASKED_SQL = " UNION ALL ".join(
    f"SELECT '{role}' AS role, transaction_id, ({amount})::decimal(18,2) AS amount, ({card})::bigint AS card_number FROM cards"
    for role, (amount, card) in SEEN.items()
)


@on_cards(
    "role_masks",
    f"SELECT role, transaction_id, cast(amount AS double) AS amount, card_number FROM ({MASKED_SQL})",
)
def _(cards):
    masked = privacy.for_roles(cards, ROLES).select("role", "transaction_id", "amount", "card_number")
    return plain_amount(masked)


on_cards(
    "accessible_summary",
    f"""SELECT 'Protection Test' AS test_type, role AS current_role, count(*) AS accessible_records,
    cast(sum(cast(amount AS decimal(18,2))) AS double) / count(*) AS avg_visible_amount,
    min(card_number) AS sample_card_number FROM ({MASKED_SQL}) GROUP BY role""",
)(lambda cards: privacy.accessible_summary(cards, ROLES))

# No SQL twin: unordered samples.
on_cards("card_sample")(relational.sample_rows)
on_cards("masking_samples")(lambda cards: privacy.masking_samples(_loaded(cards)))


@on_cards(
    "masked_by_classification",
    """SELECT element, sha256(cast(transaction_id AS varchar)) AS transaction_id, transaction_type,
    cast(round(amount, -2) AS double) AS amount, currency, transaction_timestamp,
    sha256(CASE WHEN approved THEN 'true' ELSE 'false' END) AS approved,
    right(cast(card_number AS varchar), 4) AS card_number, merchant_id FROM cards""",
)
def _(cards):
    return plain_amount(privacy.mask_by_classification(cards)).drop("object_type")


on_cards(
    "field_inventory",
    """SELECT v.field_name, v.pii_description, v.sensitivity_level, v.regulation, e.exposed_values FROM (VALUES
    ('CARD_NUMBER','Personal payment information','HIGH','Payment Card Industry (PCI) regulated'),
    ('TRANSACTION_ID','Transaction identifier','MEDIUM','Business sensitive'),
    ('MERCHANT_ID','Merchant identifier','LOW','Business identifier'),
    ('AMOUNT','Transaction amount','MEDIUM','Financial information'),
    ('TRANSACTION_TIMESTAMP','Transaction timing','LOW','Behavioral data'))
    AS v(field_name, pii_description, sensitivity_level, regulation)
    JOIN (SELECT 'CARD_NUMBER' AS field_name, count(card_number) AS exposed_values FROM cards
      UNION ALL SELECT 'TRANSACTION_ID', count(transaction_id) FROM cards
      UNION ALL SELECT 'MERCHANT_ID', count(merchant_id) FROM cards
      UNION ALL SELECT 'AMOUNT', count(amount) FROM cards
      UNION ALL SELECT 'TRANSACTION_TIMESTAMP', count(transaction_timestamp) FROM cards) e
    ON v.field_name = e.field_name""",
)(privacy.field_inventory)


@on_cards(
    "masking_strategy",
    """SELECT v.*, n.rows_to_mask FROM (VALUES
    ('CARD_NUMBER','HIGH','PAYMENT_INSTRUMENT','FULL_MASKING','Show only last 4 digits'),
    ('TRANSACTION_ID','MEDIUM','TRANSACTION_DATA','PARTIAL_MASKING','Hash or tokenize'),
    ('AMOUNT','MEDIUM','FINANCIAL_DATA','PARTIAL_MASKING','Round to nearest 100'),
    ('MERCHANT_ID','LOW','BUSINESS_DATA','NO_MASKING','No masking required'),
    ('TRANSACTION_TIMESTAMP','LOW','BEHAVIORAL_DATA','NO_MASKING','No masking required'),
    ('APPROVED','MEDIUM','TRANSACTION_DATA','PARTIAL_MASKING','Hash or tokenize'),
    ('TRANSACTION_TYPE','LOW','TRANSACTION_DATA','NO_MASKING','Hash or tokenize'),
    ('CURRENCY','LOW','REFERENCE_DATA','NO_MASKING','No masking required'))
    AS v(field_name, sensitivity_level, pii_category, masking_strategy, masking_method),
    (SELECT count(*) AS rows_to_mask FROM cards) n""",
)
def _(cards):
    rows = cards.agg(F.count("*").alias("rows_to_mask"))
    strategy = privacy.masking_strategy(privacy.classification(cards.sparkSession))
    return relational.attach(strategy, rows)


@on_cards(
    "anonymised_cards",
    """SELECT transaction_id, cast(amount AS double) AS amount,
    transaction_timestamp < timestamp '2026-01-16 00:00:00' - interval 2 year AS anonymised,
    CASE WHEN transaction_timestamp < timestamp '2026-01-16 00:00:00' - interval 2 year THEN NULL
      ELSE card_number END AS kept_card_number FROM cards""",
)
def _(cards):
    """As of two years after the middle of the data; hashed numbers differ between engines."""
    done = privacy.anonymise(cards, "2026-01-16 00:00:00")
    return done.select(
        "transaction_id",
        F.col("amount").cast("double").alias("amount"),
        "anonymised",
        F.when(~F.col("anonymised"), F.col("card_number")).alias("kept_card_number"),
    )


@register(
    "retention_report",
    sql(
        "cards daily_metrics",
        f"""SELECT 'CC_TRANS_ALL' AS table_name, cast(2555 AS bigint) AS retention_period_days,
    count(*) FILTER (transaction_timestamp >= timestamp '{RETENTION_AS_OF}' - interval 2555 day)
      AS retained_rows,
    count(*) FILTER (transaction_timestamp < timestamp '{RETENTION_AS_OF}' - interval 2555 day)
      AS expired_rows FROM cards
    UNION ALL SELECT 'CC_TRANS_STAGING', 30,
    count(*) FILTER (transaction_timestamp >= timestamp '{RETENTION_AS_OF}' - interval 30 day),
    count(*) FILTER (transaction_timestamp < timestamp '{RETENTION_AS_OF}' - interval 30 day) FROM cards
    UNION ALL SELECT 'DATA_QUALITY_METRICS', 365,
    count(*) FILTER (measurement_timestamp >= timestamp '{RETENTION_AS_OF}' - interval 365 day),
    count(*) FILTER (measurement_timestamp < timestamp '{RETENTION_AS_OF}' - interval 365 day)
    FROM daily_metrics""",
    ),
)
def _(spark, folder):
    cards = bindings.cards(spark, folder)
    tables = {
        "CC_TRANS_ALL": (cards, "transaction_timestamp"),
        "CC_TRANS_STAGING": (cards, "transaction_timestamp"),
        "DATA_QUALITY_METRICS": (quality.measure_daily(cards), "measurement_timestamp"),
    }
    return privacy.retention_report(tables, RETENTION_AS_OF)


# --- alerts ------------------------------------------------------------------------------------

# Within the data, so that the look-back windows hold rows; the whole table is scanned for them.
ALERT_AS_OF = "2024-01-30 00:00:00"


def _backlog(cards: DataFrame) -> DataFrame:
    """Rows that arrived after the clock count as not processed yet."""
    late = F.col("transaction_timestamp") > F.lit(ALERT_AS_OF).cast("timestamp_ntz")
    return cards.agg(F.count(F.when(late, 1)).alias("pending"))


def _until(cards: DataFrame) -> DataFrame:
    return cards.filter(
        F.col("transaction_timestamp") <= F.lit(ALERT_AS_OF).cast("timestamp_ntz")
    )


ALERT_SQL = f"""SELECT
    count(*) FILTER (amount > 5000 AND transaction_timestamp > timestamp '{ALERT_AS_OF}' - interval 5 minute)
      AS high_value_count,
    cast(round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) AS bigint) AS approval_rate
    FROM cards WHERE transaction_timestamp > timestamp '{ALERT_AS_OF}' - interval 15 minute
    AND transaction_timestamp <= timestamp '{ALERT_AS_OF}'"""


@on_cards(
    "alert_run",
    f"""SELECT *, CASE WHEN alert_count > 0 THEN 'ALERTS TRIGGERED (' || alert_count || '): '
      || CASE WHEN high_value_count > 0 THEN 'HIGH VALUE ALERT: ' || high_value_count
           || ' transactions over $5000 detected. ' ELSE '' END
      || CASE WHEN approval_rate < 80 THEN 'APPROVAL RATE ALERT: Rate dropped to ' || approval_rate
           || '%. ' ELSE '' END
      || CASE WHEN stream_count > 1000 THEN 'STREAM BACKLOG ALERT: ' || stream_count
           || ' unprocessed records. ' ELSE '' END
      ELSE 'No alerts triggered - system operating normally' END AS message
    FROM (SELECT *, cast((high_value_count > 0)::int + coalesce((approval_rate < 80)::int, 0)
        + (stream_count > 1000)::int AS int) AS alert_count
      FROM ({ALERT_SQL}), (SELECT count(*) AS stream_count FROM cards
        WHERE transaction_timestamp > timestamp '{ALERT_AS_OF}'))""",
)
def _(cards):
    return alerts.run_alerts(_until(cards), _backlog(cards), ALERT_AS_OF)


@register(
    "alert_rules",
    sql(
        "cards daily_metrics",
        f"""SELECT v.alert_id, v.alert_name, cast(m.alert_value AS bigint) AS alert_value,
    v.comparison_operator, cast(v.threshold_value AS bigint) AS threshold_value,
    coalesce(CASE v.comparison_operator WHEN '>' THEN m.alert_value > v.threshold_value
      ELSE m.alert_value < v.threshold_value END, false) AS is_triggered
    FROM (VALUES ('A001','High Value Transaction Alert',5000,'>'), ('A002','Low Approval Rate Alert',80,'<'),
      ('A003','Data Quality Alert',90,'<'), ('A004','Stream Processing Delay',1000,'>'),
      ('A005','Duplicate Transaction Alert',1,'>'))
      AS v(alert_id, alert_name, threshold_value, comparison_operator)
    JOIN (SELECT 'A001' AS alert_id, round(max(amount)) AS alert_value FROM cards
        WHERE transaction_timestamp > timestamp '{ALERT_AS_OF}' - interval 5 minute
        AND transaction_timestamp <= timestamp '{ALERT_AS_OF}'
      UNION ALL SELECT 'A002', approval_rate FROM ({ALERT_SQL})
      UNION ALL SELECT 'A003', round(min(metric_value)) FROM daily_metrics
        WHERE measurement_timestamp > timestamp '{ALERT_AS_OF}' - interval 10 minute
      UNION ALL SELECT 'A004', count(*) FROM cards WHERE transaction_timestamp > timestamp '{ALERT_AS_OF}'
      UNION ALL SELECT 'A005', max(n) FROM (SELECT count(*) AS n FROM cards
        WHERE transaction_timestamp > timestamp '{ALERT_AS_OF}' - interval 30 minute
        AND transaction_timestamp <= timestamp '{ALERT_AS_OF}' GROUP BY transaction_id)) m
    ON v.alert_id = m.alert_id""",
    ),
)
def _(spark, folder):
    cards = bindings.cards(spark, folder)
    measured = alerts.measured_alerts(
        _until(cards), quality.measure_daily(cards), _backlog(cards), ALERT_AS_OF
    )
    rules = alerts.evaluate_rules(alerts.alert_config(spark, ALERT_AS_OF), measured)
    return rules.withColumn("alert_value", F.col("alert_value").cast("bigint"))


@on_cards(
    "window_alerts",
    """SELECT start AS window_start, start + interval 15 minute AS window_end, count(*) AS transactions,
    count(*) FILTER (amount > 5000) AS high_value_count,
    cast(round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) AS bigint) AS approval_rate,
    count(*) FILTER (amount > 5000) > 0 AS high_value_alert,
    round(avg(CASE WHEN approved THEN 100.0::double ELSE 0.0::double END)) < 80 AS approval_alert
    FROM (SELECT *, unnest(generate_series(
        cast(date_trunc('minute', transaction_timestamp) AS timestamp) - interval 14 minute,
        cast(date_trunc('minute', transaction_timestamp) AS timestamp), interval 1 minute)) AS start
      FROM cards) GROUP BY start""",
)
def _(cards):
    return alerts.window_alerts(
        cards.withColumn("event_time", F.col("transaction_timestamp").cast("timestamp"))
    )


# --- lineage -----------------------------------------------------------------------------------

on_flows(
    "lineage_paths",
    " UNION ALL ".join(
            f"""SELECT e{n}.lineage_id, e{n}.source_object, e{n}.target_object, e{n}.transformation_type, e{n}.dependency_level,
            e1.source_object AS root_source, concat_ws(' -> ', e1.source_object, {', '.join(f'e{k}.target_object' for k in range(1, n + 1))}) AS lineage_path
            FROM flows e1 {' '.join(f'JOIN flows e{k} ON e{k}.source_object = e{k - 1}.target_object AND e{k}.dependency_level = {k}' for k in range(2, n + 1))}
            WHERE e1.dependency_level = 1"""
        for n in range(1, 4)  # the object flows have three levels
    ),
)(lineage.lineage_paths)
on_flows(
    "reachable_objects",
    """SELECT root_source, target_object, min(distance) AS distance FROM (WITH RECURSIVE reached AS (
      SELECT DISTINCT source_object AS root_source, target_object, 1 AS distance FROM flows
      UNION SELECT r.root_source, f.target_object, r.distance + 1 FROM reached r
      JOIN flows f ON f.source_object = r.target_object)
    SELECT * FROM reached) GROUP BY ALL""",
)(lineage.reachable_objects)
on_flows(
    "impact_analysis",
    """SELECT source_object, string_agg(target_object, ', ' ORDER BY dependency_level, target_object)
    AS downstream_objects, count(*) AS impact_count, max(dependency_level) AS max_depth
    FROM flows GROUP BY source_object""",
)(lineage.impact_analysis)


# --- histories and cost ------------------------------------------------------------------------

on_runs(
    "run_durations",
    """SELECT task_name, cast(sum(seconds) AS double) / count(*) AS avg_execution_time_seconds,
    max(seconds) AS max_execution_time_seconds, min(seconds) AS min_execution_time_seconds
    FROM runs WHERE state = 'SUCCEEDED' GROUP BY task_name""",
)(monitoring.run_durations)
on_runs(
    "runs_by_state",
    """SELECT task_name, state, count(*) AS execution_count,
    cast(sum(seconds) AS double) / count(*) AS avg_duration FROM runs GROUP BY 1, 2""",
)(monitoring.runs_by_state)


@register(
    "recent_runs",
    """SELECT upper(event_type) || '_TASK' AS task_name,
    CASE WHEN cast(json_extract(props, '$.k') AS bigint) < 10 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
    ts AS scheduled_time FROM events WHERE event_type IN ('click','purchase','signup')
    ORDER BY ts DESC, task_name, state LIMIT 20""",
)
def _(spark, folder):
    wanted = bindings.run_history(spark, folder).filter(
        F.col("task_name").isin("CLICK_TASK", "PURCHASE_TASK", "SIGNUP_TASK")
    )
    recent = relational.most_recent(wanted, "scheduled_time", ["task_name", "state"], 20)
    return recent.select(
        "task_name", "state", F.col("scheduled_time").cast("timestamp_ntz").alias("scheduled_time")
    )


@register(
    "second_boundaries",
    """SELECT date_diff('second', ts, ts + to_microseconds(cast(cast(value AS decimal(10,2)) * 1000000 AS bigint)))
    AS seconds, count(*) AS n FROM events GROUP BY 1""",
)
def _(spark, folder):
    runs = bindings.run_history(spark, folder)
    span = second_boundaries(F.col("scheduled_time"), F.col("completed_time"))
    return runs.groupBy(span.alias("seconds")).agg(F.count("*").alias("n"))


on_loads(
    "load_volume",
    """SELECT table_name, cast(sum(row_count) AS bigint) AS total_rows_loaded,
    cast(sum(bytes_loaded) AS bigint) AS total_bytes_loaded, count(*) AS load_operations
    FROM loads GROUP BY table_name""",
)(relational.load_volume)
on_loads(
    "hourly_files",
    """SELECT cast(date_trunc('hour', last_load_time) AS timestamp) AS hour, count(*) AS files_processed,
    cast(sum(bytes_loaded) AS bigint) AS total_bytes,
    cast(sum(bytes_loaded) AS double) / count(*) AS avg_file_size FROM loads GROUP BY 1""",
)(relational.hourly_files)
on_loads(
    "recent_loads",
    "SELECT * FROM loads ORDER BY last_load_time DESC, file_name LIMIT 10",
)(lambda log: relational.most_recent(log, "last_load_time", ["file_name"]).drop("status"))
on_loads(
    "failed_loads", "SELECT * FROM loads WHERE error_count > 0"
)(lambda log: relational.failed_loads(log).drop("status"))


def _all_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Cost rows of the whole usage table."""
    return cost.cost_rows(bindings.usage(spark, folder), CARD_AS_OF, days=None)


on_costs = on(_all_costs, "costs")


@on_costs(
    "cost_rows",
    """SELECT warehouse_name, cast(credits_micro AS double) / 1000000 AS credits_used, query_count,
    (2 * avg_execution_time + 1000) // 2000 AS avg_execution_time_seconds, total_bytes_scanned,
    cast(cost_micro AS double) / 1000000 AS cost_per_query, optimization_opportunities FROM costs""",
)
def _(rows):
    plain = {c: F.col(c).cast("double") for c in ("credits_used", "cost_per_query")}
    return rows.withColumns(plain).drop("metric_date")


on_costs(
    "cost_dashboard",
    """SELECT warehouse_name, cast(sum(credits_micro) AS double) / 1000000 AS total_credits,
    cast(sum(cost_micro) AS double) / 1000000 / count(cost_micro) AS avg_cost_per_query,
    count(*) AS optimization_checks,
    array_to_string(list_sort(list_distinct(list(optimization_opportunities))), '; ') AS recommendations
    FROM costs GROUP BY warehouse_name""",
)(lambda rows: cost.cost_dashboard(rows, CARD_AS_OF))


# --- layouts -----------------------------------------------------------------------------------


@on_cards(
    "partitioned_against_plain",
    f"""SELECT t AS table_type, count(*) AS record_count,
    cast(sum(amount) AS double) / count(*) AS avg_amount
    FROM cards, (SELECT unnest(['Partitioned Table','Original Table']) AS t)
    WHERE transaction_timestamp >= cast(timestamp '{CARD_AS_OF}' AS date) - 7 GROUP BY 1""",
)
def _(cards):
    """Write by day, read the last week back, and compare with the plain table."""
    spark = cards.sparkSession
    path = fresh_dir(spark, "cards-by-day")
    sinks.write_partitioned(cards, path)
    week = F.date_sub(F.lit(CARD_AS_OF).cast("timestamp_ntz").cast("date"), 7)

    def summary(label: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count("*").alias("record_count"), relational.mean("amount").alias("avg_amount")
        ).select(F.lit(label).alias("table_type"), "*")

    stored = spark.read.parquet(path).filter(F.col("transaction_date") >= week)
    plain = cards.filter(F.to_date("transaction_timestamp") >= week)
    return summary("Partitioned Table", stored).unionByName(summary("Original Table", plain))


@on_cards(
    "clustered_table",
    """SELECT merchant_id, count(*) AS n, cast(sum(amount) AS double) AS total FROM cards
    WHERE transaction_timestamp >= timestamp '2024-01-10' AND transaction_timestamp < timestamp '2024-01-20'
    GROUP BY merchant_id""",
)
def _(cards):
    spark = cards.sparkSession
    path = fresh_dir(spark, "cards-clustered")
    sinks.write_clustered(cards, path, ["transaction_timestamp", "merchant_id"])
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20"))
    time = F.col("transaction_timestamp")
    return (
        spark.read.parquet(path)
        .filter((time >= start) & (time < end))
        .groupBy("merchant_id")
        .agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"))
    )

"""Masking, classification, retention and anonymisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalars import (
    amount_bucket,
    anonymous_number,
    choose,
    last_four,
    literal_rows,
    moment,
    trunc_ntz,
)
from ledgerloom.operators.relational import mean
from ledgerloom.sources.readers import remove
from ledgerloom.schemas import LONG, PII_CLASSIFICATION, RETENTION_POLICY, TEXT, struct

ADMIN_ROLES = ("DATA_ADMIN_ROLE", "ACCOUNTADMIN")
ANALYST_ROLE = "ANALYST_ROLE"
AUDITOR_ROLE = "AUDITOR_ROLE"
OTHER_ROLE = "PUBLIC"

# Field, type, sensitivity, category, masking required, retention days, regulation.
CLASSIFICATION_ROWS = [
    ("CARD_NUMBER", "BIGINT", "HIGH", "PAYMENT_INSTRUMENT", True, 2555, "PCI-DSS"),
    ("TRANSACTION_ID", "BIGINT", "MEDIUM", "TRANSACTION_DATA", False, 2555, "SOX"),
    ("AMOUNT", "NUMBER", "MEDIUM", "FINANCIAL_DATA", False, 2555, "SOX"),
    ("MERCHANT_ID", "BIGINT", "LOW", "BUSINESS_DATA", False, 3650, "NONE"),
    ("TRANSACTION_TIMESTAMP", "TIMESTAMP", "LOW", "BEHAVIORAL_DATA", False, 1095, "GDPR"),
    ("APPROVED", "BOOLEAN", "MEDIUM", "TRANSACTION_DATA", False, 2555, "SOX"),
    ("TRANSACTION_TYPE", "STRING", "LOW", "TRANSACTION_DATA", False, 2555, "NONE"),
    ("CURRENCY", "STRING", "LOW", "REFERENCE_DATA", False, 3650, "NONE"),
]

# Field, description, sensitivity, regulation.
INVENTORY_ROWS = [
    ("CARD_NUMBER", "Personal payment information", "HIGH", "Payment Card Industry (PCI) regulated"),
    ("TRANSACTION_ID", "Transaction identifier", "MEDIUM", "Business sensitive"),
    ("MERCHANT_ID", "Merchant identifier", "LOW", "Business identifier"),
    ("AMOUNT", "Transaction amount", "MEDIUM", "Financial information"),
    ("TRANSACTION_TIMESTAMP", "Transaction timing", "LOW", "Behavioral data"),
]

# Days each table is kept.
RETENTION_DAYS = {"CC_TRANS_ALL": 2555, "CC_TRANS_STAGING": 30, "DATA_QUALITY_METRICS": 365}


def analyst_view(cards: DataFrame) -> DataFrame:
    """Amounts in hundreds, day precision, last four card digits."""
    return cards.select(
        "element",
        "object_type",
        "transaction_id",
        "transaction_type",
        F.round("amount", -2).cast("decimal(10,0)").alias("amount"),
        "currency",
        trunc_ntz("day", F.col("transaction_timestamp")).alias("transaction_date"),
        "approved",
        F.concat(F.lit("****-****-****-"), last_four(F.col("card_number"))).alias(
            "masked_card_number"
        ),
        "merchant_id",
        "loaded_at",
    )


def auditor_view(cards: DataFrame) -> DataFrame:
    """Hashed id, amount range, month precision, no card number."""
    return cards.select(
        "element",
        "object_type",
        F.sha2(F.col("transaction_id").cast("string"), 256).alias("hashed_transaction_id"),
        "transaction_type",
        amount_bucket(F.col("amount")).alias("amount_range"),
        "currency",
        trunc_ntz("month", F.col("transaction_timestamp")).alias("transaction_month"),
        "approved",
        F.lit("MASKED").alias("card_number"),
        "merchant_id",
        "loaded_at",
    )


def mask_card(number: Column, role: Column) -> Column:
    return (
        F.when(role.isin(*ADMIN_ROLES), number)
        .when(role == ANALYST_ROLE, last_four(number).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


# The amount an auditor sees for amounts above each bound, and for the rest.
RANGE_VALUES = ((1000, 1500), (500, 750), (100, 300))
LOWEST_VALUE = 50


def mask_amount(amount: Column, role: Column) -> Column:
    """Whole amounts for admins, hundreds for analysts, one value per range for auditors."""
    coarse = F.coalesce(*[F.when(amount > bound, value) for bound, value in RANGE_VALUES], F.lit(LOWEST_VALUE))
    return (
        F.when(role.isin(*ADMIN_ROLES), amount)
        .when(role == ANALYST_ROLE, F.round(amount, -2).cast("decimal(10,2)"))
        .when(role == AUDITOR_ROLE, coarse.cast("decimal(10,2)"))
        .otherwise(F.lit(0).cast("decimal(10,2)"))
    )


def apply_masks(cards: DataFrame, role: str | Column) -> DataFrame:
    """The table as a role sees it, all other columns unchanged."""
    who = F.lit(role) if isinstance(role, str) else role
    return cards.withColumns(
        {
            "card_number": mask_card(F.col("card_number"), who),
            "amount": mask_amount(F.col("amount"), who),
        }
    )


ROLE_VARIABLE = "ledgerloom_role"


def set_role(spark: SparkSession, role: str) -> None:
    """The session's role: what views with masks show from now on."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT 'NONE'")
    spark.sql(f"SET VAR {ROLE_VARIABLE} = :role", args={"role": role})


def masked_view(cards: DataFrame, name: str) -> None:
    """A view of the table that masks by the session's role; whoever reads it need not name one.

    The masks are SQL functions of the session, so queries may apply them to other tables as well.
    """
    spark = cards.sparkSession
    set_role(spark, "NONE")
    admin = f"{ROLE_VARIABLE} IN ({', '.join(map(repr, ADMIN_ROLES))})"
    ranges = " ".join(f"WHEN val > {bound} THEN {value}" for bound, value in RANGE_VALUES)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION card_number_mask(val BIGINT, who STRING) RETURNS BIGINT RETURN
        CASE WHEN who = 'ADMIN' THEN val WHEN who = '{ANALYST_ROLE}' THEN CAST(right(CAST(val AS STRING), 4) AS BIGINT) ELSE 0 END"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION amount_mask(val DECIMAL(10,2), who STRING) RETURNS DECIMAL(10,2) RETURN
        CASE WHEN who = 'ADMIN' THEN val WHEN who = '{ANALYST_ROLE}' THEN round(val, -2)
          WHEN who = '{AUDITOR_ROLE}' THEN CASE {ranges} ELSE {LOWEST_VALUE} END ELSE 0 END"""
    )
    cards.createOrReplaceTempView(f"{name}_rows")
    who = f"CASE WHEN {admin} THEN 'ADMIN' ELSE {ROLE_VARIABLE} END"
    shown = {"card_number": f"card_number_mask(card_number, {who})", "amount": f"amount_mask(amount, {who})"}
    columns = ", ".join(f"{shown[c]} AS {c}" if c in shown else f"`{c}`" for c in cards.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {name}_rows")


def for_roles(cards: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Every row once per role, with that role's masks; the table is read once."""
    each = cards.withColumn("role", F.explode(F.array(*[F.lit(r) for r in roles])))
    return apply_masks(each, F.col("role"))


def accessible_summary(cards: DataFrame, roles: Sequence[str]) -> DataFrame:
    return (
        for_roles(cards, roles)
        .groupBy(F.col("role").alias("current_role"))
        .agg(
            F.count("*").alias("accessible_records"),
            mean("amount").alias("avg_visible_amount"),
            F.min("card_number").alias("sample_card_number"),
        )
        .select(F.lit("Protection Test").alias("test_type"), "*")
    )


def masking_samples(cards: DataFrame, n: int = 3) -> DataFrame:
    """A few rows of the table and of both views side by side, values as text."""

    def sample(label: str, df: DataFrame, card: str, amount: str, time: str) -> DataFrame:
        return df.limit(n).select(
            F.lit(label).alias("data_type"),
            F.col(card).cast("string").alias("card_number"),
            F.col(amount).cast("string").alias("amount"),
            F.col(time).cast("string").alias("transaction_time"),
        )

    return (
        sample("Original Data Sample", cards, "card_number", "amount", "transaction_timestamp")
        .unionByName(
            sample(
                "Analyst View Sample",
                analyst_view(cards),
                "masked_card_number",
                "amount",
                "transaction_date",
            )
        )
        .unionByName(
            sample(
                "Auditor View Sample",
                auditor_view(cards),
                "card_number",
                "amount_range",
                "transaction_month",
            )
        )
    )


# --- classification ----------------------------------------------------------------------------


def classification(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, CLASSIFICATION_ROWS, PII_CLASSIFICATION)


# The method of each category, for the report and for the masks.
METHODS = {
    "PAYMENT_INSTRUMENT": "Show only last 4 digits",
    "FINANCIAL_DATA": "Round to nearest 100",
    "TRANSACTION_DATA": "Hash or tokenize",
}


def masking_strategy(classified: DataFrame) -> DataFrame:
    level, category = F.col("sensitivity_level"), F.col("pii_category")
    return classified.select(
        "field_name",
        "sensitivity_level",
        "pii_category",
        choose(
            {"FULL_MASKING": level == "HIGH", "PARTIAL_MASKING": level == "MEDIUM"},
            F.lit("NO_MASKING"),
        ).alias("masking_strategy"),
        choose(
            {method: category == name for name, method in METHODS.items()},
            F.lit("No masking required"),
        ).alias("masking_method"),
    ).orderBy(sensitivity_rank(level), "field_name")


def sensitivity_rank(level: Column) -> Column:
    return F.when(level == "HIGH", 1).when(level == "MEDIUM", 2).otherwise(3)


def field_inventory(cards: DataFrame) -> DataFrame:
    """The classified fields with the number of values each exposes, most sensitive first."""
    spark = cards.sparkSession
    fields = literal_rows(
        spark,
        INVENTORY_ROWS,
        struct(field_name=TEXT, pii_description=TEXT, sensitivity_level=TEXT, regulation=TEXT),
    )
    exposed = cards.agg(
        F.array(
            *[
                F.struct(F.lit(f).alias("field_name"), F.count(f.lower()).alias("exposed_values"))
                for f, *_ in INVENTORY_ROWS
            ]
        ).alias("cells")
    ).select(F.inline("cells"))
    return fields.join(F.broadcast(exposed), "field_name").orderBy(
        sensitivity_rank(F.col("sensitivity_level")), "field_name"
    )


def mask_by_classification(
    cards: DataFrame, rows: Sequence[tuple] = CLASSIFICATION_ROWS
) -> DataFrame:
    """Mask every column by the method of its category, unless its sensitivity is low (no masking)."""
    masks = {
        METHODS["PAYMENT_INSTRUMENT"]: last_four,
        METHODS["FINANCIAL_DATA"]: lambda c: F.round(c, -2).cast("decimal(10,0)"),
        METHODS["TRANSACTION_DATA"]: lambda c: F.sha2(c.cast("string"), 256),
    }
    masked = {
        name.lower(): masks[METHODS[category]](F.col(name.lower()))
        for name, _, level, category, *_ in rows
        if level != "LOW" and category in METHODS
    }
    return cards.withColumns(masked)


# --- retention ---------------------------------------------------------------------------------


def retention_policy(spark: SparkSession, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("timestamp_ntz").cast("date")
    rows = literal_rows(
        spark,
        list(RETENTION_DAYS.items()),
        struct(table_name=TEXT, retention_period_days=LONG),
    )
    policy = rows.select(
        "*",
        day.alias("last_cleanup_date"),
        F.date_add(day, F.col("retention_period_days").cast("int")).alias("next_cleanup_date"),
    )
    return policy.select(*RETENTION_POLICY.names)


def retained(df: DataFrame, time: str, days: int, as_of: str) -> DataFrame:
    """Rows still within their retention period."""
    return df.filter(F.col(time) >= moment(as_of) - F.expr(f"interval '{int(days)}' day"))


def retention_report(tables: dict[str, tuple[DataFrame, str]], as_of: str) -> DataFrame:
    """Rows kept and expired per policy table; ``tables`` maps a name to (frame, time column)."""
    parts = []
    for name, (df, time) in tables.items():
        cut = moment(as_of) - F.expr(f"interval '{RETENTION_DAYS[name]}' day")
        parts.append(
            df.agg(
                F.count(F.when(F.col(time) >= cut, 1)).alias("retained_rows"),
                F.count(F.when(F.col(time) < cut, 1)).alias("expired_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(RETENTION_DAYS[name]).cast("bigint").alias("retention_period_days"),
                "retained_rows",
                "expired_rows",
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def anonymise(cards: DataFrame, as_of: str, drop_years: int = 7, hash_years: int = 2) -> DataFrame:
    """Drop rows older than ``drop_years``; replace card numbers older than ``hash_years``.

    The ``anonymised`` flag marks replaced numbers, so a second run leaves them alone.
    """
    ts = F.col("transaction_timestamp")
    done = F.coalesce("anonymised", F.lit(False)) if "anonymised" in cards.columns else F.lit(False)
    old = F.coalesce(ts < years_before(as_of, hash_years), F.lit(False))
    kept = cards.filter((ts >= years_before(as_of, drop_years)) | ts.isNull())
    return kept.withColumns(
        {
            "card_number": F.when(
                old & ~done, anonymous_number(F.col("card_number"))
            ).otherwise(F.col("card_number")),
            "anonymised": old | done,
        }
    )


def years_before(as_of: str, years: int) -> Column:
    return moment(as_of) - F.expr(f"interval '{int(years)}' year")


def anonymise_stored(
    spark: SparkSession,
    path: str,
    staging: str,
    as_of: str,
    drop_years: int = 7,
    hash_years: int = 2,
) -> None:
    """Apply :func:`anonymise` to a daily-partitioned table, rewriting only the days that change.

    The changed days go to ``staging`` first and replace the table's days from there, because a path
    cannot be overwritten while it is read. A run that died may be repeated.
    """
    # The flag exists only in rewritten days; declared, it is null elsewhere whichever file is read first.
    schema = spark.read.parquet(path).schema
    if "anonymised" not in schema.names:
        schema = StructType([*schema.fields]).add("anonymised", "boolean")
    stored = spark.read.schema(schema).parquet(path)
    ts = F.col("transaction_timestamp")
    flag = F.coalesce("anonymised", F.lit(False))
    gone = ts < years_before(as_of, drop_years)
    pending = gone | ((ts < years_before(as_of, hash_years)) & ~flag)
    # Only days that reach a limit are read at all.
    within = lambda years: F.col("transaction_date") <= years_before(as_of, years).cast("date")
    stored = stored.filter(within(min(drop_years, hash_years)))
    # One value per calendar day.
    days = stored.filter(pending).select("transaction_date").distinct()
    touched = stored.join(F.broadcast(days), "transaction_date")
    replace_days = {"mode": "overwrite", "partitionBy": "transaction_date"}
    anonymise(touched, as_of, drop_years, hash_years).write.option(
        "partitionOverwriteMode", "static"
    ).parquet(staging, **replace_days)
    emptied = [
        row["transaction_date"]
        for row in stored.filter(within(drop_years)).groupBy("transaction_date")
        .agg(F.max(ts).alias("newest"))
        .filter(F.col("newest") < years_before(as_of, drop_years))
        .collect()
    ]
    rewritten = spark.read.schema(touched.withColumn("anonymised", F.lit(False)).schema).parquet(staging)
    rewritten.write.option("partitionOverwriteMode", "dynamic").parquet(path, **replace_days)
    for day in emptied:  # no row is left: the folder goes, without a job
        remove(spark, f"{path}/transaction_date={day}")

"""Recency, frequency, monetary: table, quartile scores, quantile segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.quantiles import exact_quantiles, global_row_number, quantile_bin
from ledgerloom.functions.scalars import elapsed_days, full_name, moment
from ledgerloom.operators.relational import attach, describe_columns, mean
from ledgerloom.session import checkpointed

QUARTERS = [0.0, 0.25, 0.5, 0.75, 1.0]


def rfm_table(sales: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Days since the last order, distinct orders and revenue per customer.

    The snapshot is one day after the last order of all, or ``as_of``. Without ``as_of`` the customer
    rows are checkpointed: the snapshot, quantile limits and scores then read one row per customer
    instead of joining the sales again.
    """
    per_customer = (
        sales.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order"),
            F.countDistinct("order_id").alias("frequency"),
            F.sum("total_sale").alias("monetary"),
        )
    )
    if as_of is None:
        per_customer = checkpointed(per_customer)
        snapshot = per_customer.agg(
            (F.max("last_order") + F.expr("interval '1' day")).alias("_snapshot")
        )
        per_customer = attach(per_customer, snapshot)
    else:
        at = moment(as_of) if isinstance(as_of, str) else as_of
        per_customer = per_customer.withColumn("_snapshot", at)
    return per_customer.select(
        "customer_id",
        elapsed_days(F.col("last_order"), F.col("_snapshot")).alias("recency"),
        "frequency",
        F.col("monetary").cast("double").alias("monetary"),
    )


def rfm_scores(sales: DataFrame) -> DataFrame:
    """Quartile scores by quantile edges and the segment of every customer.

    Edges that coincide give score 1 to everybody, as when labels cannot be assigned. Frequency is
    scored on its position after ordering by frequency and customer, so it never has ties.
    """
    rfm = global_row_number(
        rfm_table(sales), ["frequency", "customer_id"], name="frequency_rank"
    )
    edges = exact_quantiles(rfm, ["recency", "frequency_rank", "monetary"], QUARTERS)
    named = edges.select(
        F.col("recency").alias("r_edges"),
        F.col("frequency_rank").alias("f_edges"),
        F.col("monetary").alias("m_edges"),
    )
    scored = attach(rfm, named).select(
        "customer_id",
        "recency",
        "frequency",
        "monetary",
        F.coalesce(5 - quantile_bin(F.col("recency"), F.col("r_edges"), 4), F.lit(1)).alias("r_score"),
        F.coalesce(quantile_bin(F.col("frequency_rank"), F.col("f_edges"), 4), F.lit(1)).alias(
            "f_score"
        ),
        F.coalesce(quantile_bin(F.col("monetary"), F.col("m_edges"), 4), F.lit(1)).alias("m_score"),
    )
    r, f = F.col("r_score"), F.col("f_score")
    return scored.withColumn(
        "segment",
        F.when((r >= 4) & (f >= 4), "Champions")
        .when(f >= 4, "Clients Loyaux")
        .when((r <= 2) & (f <= 2), "Clients à Risque")
        .otherwise("Standard"),
    )


def segment_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("segment").agg(F.count("*").alias("customers"))


def quantile_segments(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Segments by quantile limits; when several rules hold, risk beats loyalty beats champion.

    Names join last, to one row per customer, so no text is carried through the sales aggregation.
    """
    rfm = rfm_table(sales)
    limits = exact_quantiles(rfm, ["recency", "frequency", "monetary"], [0.25, 0.75]).select(
        F.col("recency").alias("r_limits"),
        F.col("frequency").alias("f_limits"),
        F.col("monetary").alias("m_limits"),
    )
    at_risk = F.col("recency") > F.col("r_limits")[1]
    loyal = F.col("frequency") > F.col("f_limits")[1]
    champion = (F.col("monetary") > F.col("m_limits")[1]) & (
        F.col("recency") < F.col("r_limits")[0]
    )
    names = customers.select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("customer")
    )
    return attach(rfm, limits).join(names, "customer_id", "left").select(
        "customer_id",
        "customer",
        "recency",
        "frequency",
        "monetary",
        F.when(at_risk, "À Risque")
        .when(loyal, "Loyaux")
        .when(champion, "Champions")
        .otherwise("Standard")
        .alias("segment"),
    )


def segment_statistics(segments: DataFrame) -> DataFrame:
    """Named customers and mean revenue per segment."""
    return segments.groupBy("segment").agg(
        F.count("customer").alias("customers"),
        F.round(mean(F.col("monetary").cast("decimal(28,2)")), 2).alias("average_monetary"),
    )


def rfm_description(sales: DataFrame, as_of: str) -> DataFrame:
    return describe_columns(
        checkpointed(rfm_table(sales, as_of)), ["recency", "frequency", "monetary"]
    )

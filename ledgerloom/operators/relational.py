"""General aggregates over the retail, card and support-order tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.quantiles import exact_quantiles
from ledgerloom.functions.scalars import json_value, sql_null


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name and number of rows."""
    return union_all(
        [
            df.agg(F.count("*").alias("record_count")).select(
                F.lit(name).alias("table_name"), "record_count"
            )
            for name, df in tables.items()
        ]
    )


def attach(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate, which is one row by construction, to every row."""
    return df.crossJoin(F.broadcast(scalars))


def mean(column: str | Column) -> Column:
    """Average of a decimal column as double, without the intermediate rounding of a decimal average."""
    return F.sum(column).cast("double") / F.count(column)


def with_share(
    counts: DataFrame, value: str, name: str = "percentage", digits: int | None = None
) -> DataFrame:
    """Add the share of the total in percent; the total is a one-row side."""
    total = counts.agg(F.sum(value).alias("_total"))
    ratio = F.col(value).cast("double") * 100.0 / F.col("_total").cast("double")
    if digits is not None:
        exact = F.col(value).cast("decimal(20,0)") * 100 / F.col("_total").cast("decimal(20,0)")
        ratio = F.round(exact, digits).cast("double")
    return attach(counts, total).select(*counts.columns, ratio.alias(name))


def group_statistics(cards: DataFrame, *keys: str) -> DataFrame:
    """Count, average, minimum, maximum and total of the amount per key."""
    return cards.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"),
        mean("amount").alias("avg_amount"),
        F.min("amount").cast("double").alias("min_amount"),
        F.max("amount").cast("double").alias("max_amount"),
        F.sum("amount").cast("double").alias("total_amount"),
    )


def approved_headline(cards: DataFrame) -> DataFrame:
    """Average approved amount and latest transaction in one pass."""
    return cards.agg(
        mean(F.when(F.col("approved"), F.col("amount"))).alias("avg_approved_amount"),
        F.max("transaction_timestamp").alias("latest_transaction"),
    )


def repeated(df: DataFrame, *keys: str, count: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias(count))
        .filter(F.col(count) > 1)
        .orderBy(F.desc(count), *keys)
    )


def surplus_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Number of rows beyond the first of each key; NULL keys form one group."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def most_recent(df: DataFrame, time: str, tie_break: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(F.desc(time), *tie_break).limit(n)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def largest(df: DataFrame, value: str, keys: Sequence[str], n: int) -> DataFrame:
    """Top n by value, ties in key order."""
    return df.orderBy(F.desc(value), *keys).limit(n)


def hourly_counts(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour_of_day")).agg(F.count("*").alias("orders"))


def hourly_files(log: DataFrame) -> DataFrame:
    """Files and bytes loaded per clock hour."""
    return log.groupBy(F.date_trunc("hour", "last_load_time").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("files_processed"),
        F.sum("bytes_loaded").alias("total_bytes"),
        mean("bytes_loaded").alias("avg_file_size"),
    )


def item_distribution(support: DataFrame) -> DataFrame:
    return support.groupBy("item").agg(F.count("*").alias("order_count"))


def market_share(support: DataFrame) -> DataFrame:
    return with_share(
        support.groupBy("item").agg(F.count("*").alias("total_orders")), "total_orders", "market_share", digits=2
    )


def orders_by_state(support: DataFrame) -> DataFrame:
    """Orders and distinct buyers per state found in the JSON address."""
    return (
        support.withColumn("address", sql_null(F.col("address")))
        .filter(F.col("address").isNotNull())
        .groupBy(json_value(F.col("address"), "$.state", "string").alias("state"))
        .agg(F.count("*").alias("orders"), F.countDistinct("name").alias("unique_customers"))
    )


def load_volume(log: DataFrame) -> DataFrame:
    return log.groupBy("table_name").agg(
        F.sum("row_count").alias("total_rows_loaded"),
        F.sum("bytes_loaded").alias("total_bytes_loaded"),
        F.count("*").alias("load_operations"),
    )


def failed_loads(log: DataFrame) -> DataFrame:
    return log.filter((F.col("status") != "LOADED") | (F.col("error_count") > 0))


def route_events(df: DataFrame, name: str, amount: str, prefix: str, vip_above: float) -> DataFrame:
    """Tag every event with the handlers that want it: name prefix and amount over a limit."""
    routes: list[Column] = [
        F.when(F.col(name).startswith(prefix), F.lit("FULFILLMENT")),
        F.when(F.col(amount) > vip_above, F.lit("VIP")),
    ]
    return df.withColumn("route", F.explode(F.array_compact(F.array(*routes))))


def upper_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long-form summary: one row per column with count, mean, std, min, quartiles, max."""
    def cell(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("row_count"),
            mean(F.col(c).cast("decimal(28,2)")).alias("mean"),
            F.round(F.stddev_samp(x), 4).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )

    basics = df.agg(F.array(*[cell(c) for c in columns]).alias("cells")).select(F.inline("cells"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.round(F.col(c)[0], 4).alias("q25"),
                        F.round(F.col(c)[1], 4).alias("q50"),
                        F.round(F.col(c)[2], 4).alias("q75"),
                    )
                    for c in columns
                ]
            )
        )
    )
    # One row per summarised column on both sides.
    return basics.join(F.broadcast(quartiles), "column_name")

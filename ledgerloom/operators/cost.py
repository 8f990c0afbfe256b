"""Usage cost rows with advice, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.scalars import choose, moment
from ledgerloom.operators.relational import mean
from ledgerloom.schemas import COST_METRICS


def cost_rows(usage: DataFrame, as_of: str, days: int | None = 1) -> DataFrame:
    """Distinct usage rows since ``days`` before the day of ``as_of`` (None: all) with cost and advice."""
    today = moment(as_of).cast("date")
    facts = ["warehouse_name", "credits_used", "query_count", "avg_execution_time", "total_bytes_scanned"]
    cost = F.try_divide(F.col("credits_used"), F.col("query_count"))
    if days is not None:
        usage = usage.filter(F.col("start_time") >= F.date_sub(today, days).cast("timestamp_ntz"))
    rows = (
        usage.select(*facts)
        .distinct()
        .withColumns(
            {
                "metric_date": today,
                "avg_execution_time_seconds": F.round(
                    F.col("avg_execution_time").cast("decimal(20,0)") / 1000, 0
                ).cast("bigint"),
                "cost_per_query": F.round(cost, 6).cast("decimal(10,6)"),
                "optimization_opportunities": choose(
                    {
                        "Consider query optimization": F.col("avg_execution_time") > 60_000,
                        "High cost per query": cost > 0.1,
                        "Consider result caching": F.col("total_bytes_scanned") > 1_000_000_000,
                    },
                    F.lit("Operating efficiently"),
                ),
            }
        )
    )
    return rows.select(*COST_METRICS.names)


def cost_dashboard(metrics: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Credits, cost per query and the distinct advice of the last days per warehouse."""
    today = moment(as_of).cast("date")
    return (
        metrics.filter(F.col("metric_date") >= F.date_sub(today, days))
        .groupBy("warehouse_name")
        .agg(
            F.sum("credits_used").cast("double").alias("total_credits"),
            mean("cost_per_query").alias("avg_cost_per_query"),
            F.count("*").alias("optimization_checks"),
            F.array_join(F.array_sort(F.collect_set("optimization_opportunities")), "; ").alias(
                "recommendations"
            ),
        )
    )

"""Job run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import second_boundaries
from ledgerloom.operators.relational import mean

def duration() -> Column:
    """Run time in seconds; NULL while a run has not ended."""
    return second_boundaries(F.col("scheduled_time"), F.col("completed_time"))


def run_durations(history: DataFrame) -> DataFrame:
    """Average, longest and shortest run of every job that succeeded, in seconds."""
    return (
        history.filter(F.col("state") == "SUCCEEDED")
        .groupBy("task_name")
        .agg(
            mean(duration()).alias("avg_execution_time_seconds"),
            F.max(duration()).alias("max_execution_time_seconds"),
            F.min(duration()).alias("min_execution_time_seconds"),
        )
    )


def runs_by_state(history: DataFrame) -> DataFrame:
    return history.groupBy("task_name", "state").agg(
        F.count("*").alias("execution_count"), mean(duration()).alias("avg_duration")
    )

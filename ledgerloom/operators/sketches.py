"""Distinct counts over any span of days from stored sketches.

A HyperLogLog sketch of 2 ** ``LOG_SIZE`` registers per day (a few kilobytes) is written once; sketches merge without
loss, so the count of a span reads one row per day instead of the sales. The relative standard error is
1.04 / sqrt(2 ** LOG_SIZE), 1.6 % at 12; the exact count stays the choice where a result must not be off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOG_SIZE = 12


def standard_error(log_size: int = LOG_SIZE) -> float:
    return 1.04 / 2 ** (log_size / 2)


def daily_sketches(df: DataFrame, key: str, time: str, log_size: int = LOG_SIZE) -> DataFrame:
    """day, sketch of the keys seen on it; NULL keys do not count."""
    return df.filter(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("day")).agg(
        F.hll_sketch_agg(key, log_size).alias("sketch")
    )


def distinct_in_span(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct keys of all days of ``sketches``, or of the groups ``by`` of days."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"))

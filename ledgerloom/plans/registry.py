"""Registry of named queries: a callable on Spark and, where SQL can express it, an oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import tune

Run = Callable[[SparkSession, str], DataFrame]

# Fixed clocks, so that results do not depend on the day they are computed.
CARD_AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-02-15 00:00:00"
RETAIL_AS_OF = "2001-08-02 00:00:00"


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        QUERIES[name] = Query(name, tuned, sql)
        return run

    return add

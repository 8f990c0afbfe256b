"""Lineage paths and impact analysis over an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalars import literal_rows
from ledgerloom.operators.relational import union_all
from ledgerloom.schemas import LINEAGE
from ledgerloom.session import checkpointed

# Id, source, target, kind, description, level.
LINEAGE_ROWS = [
    ("L001", "@CC_STAGE", "CC_TRANS_STAGING", "COPY", "File copy from stage to table", 1),
    ("L002", "CC_TRANS_STAGING", "CC_TRANS_STAGING_VIEW", "VIEW", "JSON parsing and column mapping", 2),
    ("L003", "CC_TRANS_STAGING_VIEW", "CC_TRANS_STAGING_VIEW_STREAM", "STREAM", "Change data capture", 3),
    ("L004", "CC_TRANS_STAGING_VIEW_STREAM", "CC_TRANS_ALL", "INSERT", "Stream processing to analytical table", 4),
    ("L005", "CC_TRANS_ALL", "CC_TRANS_ANALYST_VIEW", "VIEW", "Data masking for analysts", 5),
    ("L006", "CC_TRANS_ALL", "CC_TRANS_AUDITOR_VIEW", "VIEW", "Data masking for auditors", 5),
    ("L007", "CC_TRANS_ALL", "DATA_QUALITY_METRICS", "PROCEDURE", "Quality metric calculation", 5),
]


def lineage_table(spark: SparkSession, as_of: str) -> DataFrame:
    at = F.lit(as_of).cast("timestamp_ntz")
    return (
        literal_rows(spark, LINEAGE_ROWS, StructType(LINEAGE.fields[:6]))
        .withColumns({"created_timestamp": at, "last_updated": at})
        .select(*LINEAGE.names)
    )


def _fixpoint(first: DataFrame, step: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """Semi-naive iteration: every step sees only the rows the step before has found, and is written once."""
    found, frontier = [], checkpointed(first)
    while not frontier.isEmpty():
        found.append(frontier)
        frontier = checkpointed(step(frontier))
    return found or [frontier]


def lineage_paths(edges: DataFrame) -> DataFrame:
    """Every path from a level-1 source, one level per step: a path goes on with edges of the next level only.

    The edges are stored once; a step joins them with the paths that the step before has found, an equi-join on
    object and level, until there are none. This has no row or depth limit, unlike a recursive query, and levels
    ascend, so cycles end.
    """
    columns = ["lineage_id", "source_object", "target_object", "transformation_type", "dependency_level"]
    edges = checkpointed(edges.select(*columns))

    def longer(paths: DataFrame) -> DataFrame:
        reached = paths.select(
            F.col("target_object").alias("source_object"),
            (F.col("dependency_level") + 1).alias("dependency_level"),
            "root_source",
            "lineage_path",
        )
        return edges.join(reached, ["source_object", "dependency_level"]).select(
            *columns,
            "root_source",
            F.concat_ws(" -> ", "lineage_path", "target_object").alias("lineage_path"),
        )

    first = edges.filter(F.col("dependency_level") == 1).select(
        *columns,
        F.col("source_object").alias("root_source"),
        F.concat_ws(" -> ", "source_object", "target_object").alias("lineage_path"),
    )
    return union_all(_fixpoint(first, longer))


def reachable_objects(edges: DataFrame) -> DataFrame:
    """root_source, target_object, distance: every object that an edge's source feeds, directly or through others,
    with the number of edges on the shortest way. Levels do not matter; what was reached before is not followed
    again, so cycles end and an object on one feeds itself."""
    edges = checkpointed(edges.select("source_object", "target_object").distinct())
    seen = [checkpointed(edges.select(F.col("source_object").alias("root_source"), "target_object", F.lit(1).alias("distance")))]

    def further(frontier: DataFrame) -> DataFrame:
        after = frontier.join(edges.toDF("via", "next"), F.col("target_object") == F.col("via"))
        new = after.select("root_source", F.col("next").alias("target_object"), F.col("distance") + 1).distinct()
        known = union_all(seen).select("root_source", "target_object")
        return new.toDF("root_source", "target_object", "distance").join(known, ["root_source", "target_object"], "left_anti")

    frontier = seen[0]
    while True:
        frontier = checkpointed(further(frontier))
        if frontier.isEmpty():
            return union_all(seen)
        seen.append(frontier)


def impact_analysis(edges: DataFrame) -> DataFrame:
    """Objects fed by each source in level order, their number, and the deepest level.

    The list is the result itself; an edge table is a catalogue of objects, not of rows.
    """
    ordered = F.array_sort(F.collect_list(F.struct("dependency_level", "target_object")))
    return edges.groupBy("source_object").agg(
        F.array_join(F.transform(ordered, lambda s: s["target_object"]), ", ").alias(
            "downstream_objects"
        ),
        F.count("*").alias("impact_count"),
        F.max("dependency_level").alias("max_depth"),
    )

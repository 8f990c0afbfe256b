"""Changes between two states of a table, and tables from changes.

A change row is a row of the table with ``metadata_action`` (INSERT or DELETE), ``metadata_isupdate`` (both halves of
an update have it) and ``metadata_row_id``, which is the same for all rows of a key. Rows that are the same in both
states do not appear. Keys may repeat: equal rows are counted, so the difference is one of multisets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

METADATA = ("metadata_action", "metadata_isupdate", "metadata_row_id")


def _repeated(rows: DataFrame, count: str) -> DataFrame:
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))).drop("_copy", count)


def table_changes(before: DataFrame | None, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns ``before`` (None: the initial rows are wanted) into ``after``.

    Both states meet in one aggregation of signed counts, so equal rows cancel out, repeated ones already before
    the shuffle; only the rows that differ are compared by key.
    """
    columns = after.columns
    signed = after.withColumn("_sign", F.lit(1))
    if before is not None:
        signed = signed.unionByName(before.select(*columns).withColumn("_sign", F.lit(-1)))
    net = signed.groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    of_key = Window.partitionBy(*keys)
    marked = net.withColumns(
        {
            "metadata_action": F.when(F.col("_net") > 0, "INSERT").otherwise("DELETE"),
            "metadata_isupdate": (F.min("_net").over(of_key) < 0) & (F.max("_net").over(of_key) > 0),
            "metadata_row_id": F.sha2(F.to_json(F.struct(*keys)), 256),
            "_n": F.abs("_net"),
        }
    )
    return _repeated(marked.drop("_net"), "_n").select(*columns, *METADATA)


def apply_changes(table: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after all changes; their order does not matter, as every one counts once."""
    columns = table.columns
    sign = F.when(F.col("metadata_action") == "INSERT", 1).otherwise(-1).alias("_sign")
    rows = table.withColumn("_sign", F.lit(1)).unionByName(changes.select(*columns, sign))
    return _repeated(rows.groupBy(*columns).agg(F.sum("_sign").alias("_n")).filter("_n > 0"), "_n").select(*columns)


def current_rows(changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """State of a keyed table from its change log: of each key the last version's row, if that is not deleted.

    Of the two halves of an update the insert counts. A version that is stored twice changes nothing.
    """
    rest = [c for c in changes.columns if c not in (*keys, version, *METADATA)]
    inserted = F.col("metadata_action") == "INSERT"
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(inserted.alias("_in"), *rest), F.struct(version, inserted)).alias("last"))
    return last.filter("last._in").select(*keys, *(F.col(f"last.{c}").alias(c) for c in rest))

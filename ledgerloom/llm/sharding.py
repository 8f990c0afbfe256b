"""Contiguous shards of nearly equal bytes from a global prefix sum.

Slim rows (id, size, checksum) are range-partitioned by doc_id; a partition's rows get a running sum, and the
totals of the partitions before it are added. The sum is cut at equal targets: a row goes to the shard that
the middle of its bytes falls into, so shard sizes differ from the target by less than the largest row.

Defined results: a null text has no bytes and checksum 0; every row costs ``OVERHEAD`` bytes besides; null ids
come first; repeated rows are separate rows in any order; shards no row falls into are empty; an empty table
gives no rows. Rows with equal ids are spread by a fixed pseudo-random key, so no range holds them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, whole_text

OVERHEAD = 16
ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def byte_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to shards - 1), slot (0, 1, ... within the shard)."""
    slim = docs.select(
        "doc_id",
        (F.octet_length(whole_text()) + OVERHEAD).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        F.rand(11).alias("tie"),
    )
    ordered = slim.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # The ranges come from a sample, so partition numbers hold only once they are written down.
    rows = stored(
        ordered.drop("tie").withColumns(
            {"part": F.spark_partition_id(), "row": F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)}
        ),
        "shard-rows",
    )
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # One row per partition: the only window without a key, bounded by the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("total"),
    )
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("upto", F.sum("size").over(within)).join(F.broadcast(totals), "part")
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("rows_before") + F.col("row")).alias("rank"),
        F.expr(f"int((2 * (bytes_before + upto) - size) * {shards} div (2 * total))").alias("shard"),
    )
    placed = stored(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )

"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Texts are equal when they are identical after each run of white space became one space; a null text counts
as empty. Rows with a length of their own, or with a prefix hash of their own among texts of their length,
are unique and their whole text is never hashed. Only slim rows (ids, lengths, hashes) are shuffled, never
texts: survivors are picked on the second scan by a broadcast of hash buckets, at most ``BUCKETS`` rows.
A bucket may let a unique row through; it is then told apart by its whole hash, so the result is exact.

Defined results: an empty table gives no rows; null and empty texts form one group; of equal texts the
smallest doc_id stays (null ids come last; of rows that repeat one doc_id exactly one stays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import one_space, stored, whole_text, without

PREFIX = 256
BUCKETS = 1 << 18


def _bucket(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(BUCKETS))


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    text = one_space(whole_text())
    return docs.select(*more, text.alias("normal")).select(
        "*",
        F.length("normal").alias("length"),
        F.xxhash64(F.substring("normal", 1, PREFIX)).alias("prefix"),
    )


def surviving(docs: DataFrame) -> DataFrame:
    """(length, prefix) of the groups that still have two rows or more after both cheap steps."""
    groups = stored(_measured(docs).groupBy("length", "prefix").agg(F.count("*").alias("n")), "dedup-heads")
    lengths = groups.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    return groups.join(lengths, "length", "left_semi").where("n > 1").select("length", "prefix")


def exact_copies(docs: DataFrame, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept.

    ``digest`` adds text_sha256, the hash of every normalised text, which reports want also for unique rows.
    """
    buckets = surviving(docs).select(_bucket(F.col("length"), F.col("prefix")).alias("bucket")).distinct()
    rows = _measured(docs, F.col("doc_id")).withColumn("bucket", _bucket(F.col("length"), F.col("prefix")))
    rows = rows.join(F.broadcast(buckets.withColumn("hit", F.lit(True))), "bucket", "left")
    whole = F.sha2("normal", 256)
    rows = rows.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        "length",
        "prefix",
        F.when(F.col("hit"), whole).alias("whole"),
        *([whole.alias("text_sha256")] if digest else []),
    )
    rows = stored(rows, "dedup-rows")
    key = ["length", "prefix", "whole"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    groups = (
        rows.where("whole IS NOT NULL").groupBy(*key).agg(first, F.count("*").alias("group_size")).where("group_size > 1")
    )
    groups = stored(groups, "dedup-groups")
    # Slim rows; the adaptive planner splits a partition that holds the rows of a hot group.
    joined = rows.join(groups, key, "left")
    return joined.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        *(["text_sha256"] if digest else []),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns.

    Ids that occur once are decided by id alone. Where one id has rows on both sides (repeated rows), its
    rows are numbered per normalised text and the first of each text that stays is kept.
    """
    rows = stored(exact_copies(docs, digest=True), "dedup-kept")
    sides = rows.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("all"))
    mixed = stored(sides.where(F.col("some") & ~F.col("all")).select("doc_id"), "dedup-mixed")
    plain = without(docs, sides.where(~F.col("all")).select("doc_id"))
    if mixed.isEmpty():
        return plain
    stay = rows.join(
        mixed.select(F.col("doc_id").alias("__mixed")), F.col("doc_id").eqNullSafe(F.col("__mixed")), "left_semi"
    )
    stay = stay.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    again = docs.withColumn("__text", F.sha2(one_space(whole_text()), 256))
    again = again.join(stay, again["doc_id"].eqNullSafe(stay["__id"]) & (again["__text"] == stay["__sha"]))
    order = Window.partitionBy("doc_id", "__text").orderBy(F.xxhash64(*docs.columns))
    again = again.withColumn("__n", F.row_number().over(order)).where("__n = 1")
    return plain.unionByName(again.select(*docs.columns))

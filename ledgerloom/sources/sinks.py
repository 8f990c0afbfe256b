"""Batch writers: append, replace, capped file size, partitioned and clustered layouts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_batches(df: DataFrame, path: str, rows_per_file: int, mode: str = "append") -> None:
    """Snappy Parquet files of at most ``rows_per_file`` rows."""
    (
        df.write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
        .parquet(path)
    )


def append_columns(df: DataFrame, path: str, columns: Sequence[str], stamp: str | None = None) -> None:
    """Append the named columns in order; ``stamp`` adds a load time column."""
    rows = df.select(*columns)
    if stamp:
        rows = rows.withColumn(stamp, F.current_timestamp())
    rows.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Create or replace: static overwrite of the whole path."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def with_transaction_date(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_date", F.to_date("transaction_timestamp"))


def write_partitioned(df: DataFrame, path: str) -> None:
    """Daily partitions; a re-run replaces only the days it contains.

    The rebalance hint groups rows by day, splits a day that is larger than the advisory partition size
    over several tasks, and puts small days together: no day is one task, and no day is many tiny files.
    """
    (
        with_transaction_date(df)
        .hint("rebalance", F.col("transaction_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("transaction_date")
        .parquet(path)
    )


def write_clustered(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Range-partitioned and sorted files, so that min/max statistics skip row groups.

    The source partition is the last range key: rows that agree on all keys, were they a third of the
    table, can then be cut into several ranges. It does not change when a task is repeated.
    """
    (
        df.withColumn("_origin", F.spark_partition_id())
        .repartitionByRange(*keys, "_origin")
        .sortWithinPartitions(*keys)
        .drop("_origin")
        .write.mode("overwrite")
        .parquet(path)
    )


def interleaved(buckets: Sequence[str], bits: int) -> Column:
    """Z-order value: the bits of the bucket numbers in turn, the highest ones first."""
    parts = [
        F.shiftleft(F.shiftright(F.col(c).cast("bigint"), b).bitwiseAND(F.lit(1)), b * len(buckets) + k)
        for b in range(bits)
        for k, c in enumerate(buckets)
    ]
    return reduce(Column.bitwiseOR, parts)


def write_zordered(df: DataFrame, path: str, keys: Sequence[str], files: int, bits: int = 8) -> None:
    """Files along a Z-order curve over the ranks of several columns, so that a filter on any of them skips files.

    Ranks come from a quantile sketch of ``2 ** bits`` parts per column, so skewed values are spread as well; rows of
    one cell are cut by their source partition. NULLs come first. The files are sorted along the curve.
    """
    numbers = [F.col(k).cast("timestamp").cast("double") if t.startswith("timestamp") else F.col(k).cast("double") for k, t in df.dtypes if k in keys]
    names = [f"_n{i}" for i in range(len(keys))]
    wide = df.withColumns(dict(zip(names, (numbers[[k for k in df.columns if k in keys].index(key)] for key in keys), strict=True)))
    edges = wide.approxQuantile(names, [i / 2**bits for i in range(1, 2**bits)], 0.25 / 2**bits)
    for i, found in enumerate(edges):
        splits = [-math.inf, *sorted(set(found)), math.inf]
        cut = Bucketizer(splits=splits, inputCol=f"_n{i}", outputCol=f"_b{i}", handleInvalid="keep")
        wide = cut.transform(wide.withColumn(f"_n{i}", F.coalesce(f"_n{i}", F.lit(-math.inf))))
    z = interleaved([f"_b{i}" for i in range(len(keys))], bits + 1)
    (
        wide.withColumns({"_z": z, "_origin": F.spark_partition_id()})
        .repartitionByRange(files, "_z", "_origin")
        .sortWithinPartitions("_z")
        .select(*df.columns)
        .write.mode("overwrite")
        .parquet(path)
    )


def file_ranges(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column in every file, as the file statistics have them."""
    bounds = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("least", F.min), ("most", F.max))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds)


def since(df: DataFrame, moment) -> DataFrame:
    """Rows at or after ``moment`` of a daily-partitioned table.

    The date condition prunes partitions, the timestamp condition is exact.
    """
    return df.filter(
        (F.col("transaction_date") >= F.to_date(moment)) & (F.col("transaction_timestamp") >= moment)
    )


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Store a shared base once and read it back, for several operators over the same join."""
    replace_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reload_all(spark: SparkSession, reader, source: str, target: str) -> None:
    """Load every file again, whatever was loaded before (rows may repeat)."""
    reader(spark, source).write.mode("append").parquet(target)

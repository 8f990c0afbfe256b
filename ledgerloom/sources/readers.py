"""Batch readers: newline JSON, JSON arrays, Parquet by column name, stage listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, VariantType

from ledgerloom.functions.scalars import sql_null
from ledgerloom.schemas import SUPPORT_ORDERS, SUPPORT_ORDERS_RAW


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None
) -> DataFrame:
    """Newline-delimited JSON with an explicit schema; blank lines are skipped.

    With ``corrupt_column`` a broken line is kept as text in that column instead of a row of NULLs.
    """
    reader = spark.read.schema(schema)
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, "string")
        reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(path)


def read_support_orders(spark: SparkSession, path: str) -> DataFrame:
    """Support orders from newline JSON, nested objects as variants, JSON null as SQL NULL."""
    raw = read_json_lines(spark, path, SUPPORT_ORDERS_RAW)
    return raw.select(
        *[
            F.when(F.col(f.name).isNotNull(), F.parse_json(F.to_json(f.name))).alias(f.name)
            if isinstance(f.dataType, VariantType)
            else F.col(f.name)
            for f in SUPPORT_ORDERS.fields
        ]
    )


def parse_json_columns(df: DataFrame, *columns: str) -> DataFrame:
    """JSON text columns to variants for a whole frame; JSON ``null`` becomes SQL NULL."""
    return df.withColumns({c: sql_null(F.parse_json(c)) for c in columns})


def read_json_variants(
    spark: SparkSession, path: str, pattern: str | None = None, name: str = "json_data"
) -> DataFrame:
    """JSON array (or object) files as one variant row per element.

    A file is parsed by one task, so stage large deliveries as many files.
    """
    documents = (
        spark.read.option("multiLine", True)
        .option("singleVariantColumn", "document")
        .json(path)
        .select("document", F.col("_metadata.file_path").alias("source_file"))
    )
    return explode_documents(matching_files(documents, pattern), name)


def explode_documents(documents: DataFrame, name: str = "json_data") -> DataFrame:
    """One row per element of an array document; an object document is one row."""
    elements = F.when(
        F.schema_of_variant("document").startswith("ARRAY"),
        F.col("document").cast("array<variant>"),
    ).otherwise(F.array("document"))
    return documents.select(F.explode(elements).alias(name), "source_file")


def matching_files(df: DataFrame, pattern: str | None, column: str = "source_file") -> DataFrame:
    """Keep rows of files whose whole path matches a regular expression."""
    return df if pattern is None else df.filter(F.col(column).rlike(f"^(?:{pattern})$"))


def match_by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a target schema by case-sensitive name: missing is NULL, extra is dropped."""
    present = set(df.columns)
    # Columns are taken by position, so a name that differs only in case is never picked up.
    position = {c: i for i, c in enumerate(df.columns)}
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return unique.select(
        *[
            (F.col(f"c{position[f.name]}") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_parquet_by_name(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return match_by_name(spark.read.option("mergeSchema", True).parquet(path), schema)


def list_stage(spark: SparkSession, path: str) -> DataFrame:
    """Files of a landing folder with size and time; the content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("path").alias("name"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("last_modified"),
        )
    )


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at) and system.getFileStatus(at).isDirectory()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders within a folder."""
    system, at = _file_system(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().toString() for s in system.listStatus(at) if s.isDirectory())


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, at = _file_system(spark, path)
    if not system.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} was not renamed to {to}")


def move_files(spark: SparkSession, path: str, to: str, least: int = 0) -> int:
    """Move the data files of a finished write that have ``least`` bytes or more into another folder; returns their number."""
    system, at = _file_system(spark, path)
    found = [s.getPath() for s in system.listStatus(at) if s.getLen() >= least and s.getPath().getName().startswith("part-")]
    for file in found:
        rename(spark, file.toString(), f"{to}/{file.getName()}")
    return len(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds."""
    system, at = _file_system(spark, path)
    system.delete(at, True)

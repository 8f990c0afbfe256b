"""Load-once file ingest, change streams over staged cards, and load history.

Every consumer is one streaming query with its own checkpoint, which is its offset. A batch writes to a
folder named by the checkpoint's own id and its number, so a batch that is repeated after a failure replaces
its own output, and a new checkpoint, whose numbers start again, leaves older rows alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.facts import typed_cards
from ledgerloom.schemas import CARD_TRANSACTIONS, JSON, LOAD_LOG, TEXT, struct
from ledgerloom.sources.readers import (
    exists, explode_documents, folders, list_stage, match_by_name, matching_files, remove, rename,
)
from ledgerloom.sources.sinks import replace_table

CORRUPT = "_corrupt_record"
STAGED = struct(json_data=JSON, source_file=TEXT)


def batch_folder(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Folder of one batch; a checkpoint keeps its id in its metadata, written before the first batch."""
    stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return f"stream={stream}/batch_id={batch_id}"


def trigger(every: str | None) -> dict:
    """Scheduled micro-batches, or all present data once. Batches without data do not run."""
    return {"processingTime": every} if every else {"availableNow": True}


def _source_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("source_size"),
    ]


def json_stage_stream(
    spark: SparkSession, path: str, schema: StructType, clean: str | None = None, archive: str | None = None
) -> DataFrame:
    """New newline-JSON files with their name and size; broken lines keep their text.

    ``clean='delete'`` removes a file after a later batch has committed, ``'archive'`` moves it.
    """
    reader = (
        spark.readStream.schema(StructType([*schema.fields]).add(CORRUPT, "string"))
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    return _cleaned(reader, clean, archive).json(path).select("*", *_source_columns())


def _cleaned(reader, clean: str | None, archive: str | None):
    if clean:
        reader = reader.option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader


def parquet_stage_stream(
    spark: SparkSession, path: str, file_schema: StructType, clean: str | None = None
) -> DataFrame:
    reader = _cleaned(spark.readStream.schema(file_schema), clean, None)
    return reader.parquet(path).select("*", *_source_columns())


def change_stream(
    spark: SparkSession, path: str, pattern: str | None = None, since: str | None = None
) -> DataFrame:
    """Documents of JSON array files as they arrive.

    All present files are initial rows; ``since`` (a timestamp text) leaves out files that were there
    before. The source only grows, so every change is an insert.
    """
    files = (
        spark.readStream.option("multiLine", True)
        .option("singleVariantColumn", "document")
        .json(path)
        .select(
            "document",
            *_source_columns(),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )
    if since:
        files = files.filter(F.col("modified") > F.lit(since).cast("timestamp"))
    return explode_documents(matching_files(files, pattern)).withColumn(
        "metadata_action", F.lit("INSERT")
    )


def record_changes(changes: DataFrame, log: str, version: int) -> None:
    """Store the changes of one version of a table; a repeated version replaces itself."""
    replace_table(changes, f"{log}/version={int(version)}")


def recorded_changes(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    """The stored changes of a table as a stream, inserts and deletes, with their version."""
    return spark.readStream.schema(StructType([*schema.fields]).add("version", "long")).parquet(log)


def file_log(batch: DataFrame, table_name: str) -> DataFrame:
    """Load-history rows of a batch: one per source file."""
    broken = F.col(CORRUPT) if CORRUPT in batch.columns else F.lit(None).cast("string")
    size = F.col("source_size") if "source_size" in batch.columns else F.lit(None).cast("bigint")
    return (
        batch.select("source_file", size.alias("size"), broken.alias("broken"))
        .groupBy("source_file")
        .agg(
            F.count("*").alias("row_parsed"),
            F.count(F.when(F.col("broken").isNull(), 1)).alias("row_count"),
            F.count("broken").alias("error_count"),
            F.max("size").alias("bytes_loaded"),
            F.min("broken").alias("first_error_message"),
        )
        .select(
            F.lit(table_name).alias("table_name"),
            F.col("source_file").alias("file_name"),
            F.when(F.col("error_count") == 0, "LOADED")
            .when(F.col("row_count") == 0, "LOAD_FAILED")
            .otherwise("PARTIALLY_LOADED")
            .alias("status"),
            "row_parsed",
            "row_count",
            "error_count",
            "bytes_loaded",
            F.current_timestamp().alias("last_load_time"),
            "first_error_message",
        )
    )


def load_once(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    log: str | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    table_name: str = "",
    every: str | None = None,
) -> StreamingQuery:
    """Load every staged file exactly once into ``table`` and record it in ``log``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the batch when there is a log; a single write streams it through.
        kept = batch.persist() if log else batch
        try:
            good = kept.filter(F.col(CORRUPT).isNull()) if CORRUPT in kept.columns else kept
            rows = good.drop(CORRUPT, "source_size")
            rows = shape(rows) if shape else rows.drop("source_file")
            folder = batch_folder(batch.sparkSession, checkpoint, batch_id)
            replace_table(rows, f"{table}/{folder}")
            if log:
                entries = file_log(kept, table_name or table)
                replace_table(entries.repartition(1), f"{log}/{folder}")  # one row per file of the batch
        finally:
            if log:
                kept.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def load_parquet_once(
    spark: SparkSession,
    stage: str,
    file_schema: StructType,
    target_schema: StructType,
    table: str,
    checkpoint: str,
    log: str | None = None,
    **options,
) -> StreamingQuery:
    """Load-once ingest of staged Parquet, columns matched by case-sensitive name."""
    return load_once(
        parquet_stage_stream(spark, stage, file_schema),
        table,
        checkpoint,
        log,
        shape=lambda rows: match_by_name(rows, target_schema),
        **options,
    )


def read_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Rows of a batch-wise written table."""
    return spark.read.schema(schema).parquet(*live_folders(spark, table)).select(*schema.names)


def _batches(spark: SparkSession, table: str) -> dict[str, dict[str, dict[int, str]]]:
    """Folders of each stream of a table: single batches, and compacted ones by their last batch."""
    found: dict[str, dict[str, dict[int, str]]] = {}
    for stream in folders(spark, table):
        if stream.rsplit("/", 1)[1].startswith("stream="):
            kinds = found[stream] = {"batch_id": {}, "upto": {}}
            for path in folders(spark, stream):
                kind, _, number = path.rsplit("/", 1)[1].partition("=")
                if kind in kinds:
                    kinds[kind][int(number)] = path
    return found


def live_folders(spark: SparkSession, table: str) -> list[str]:
    """What a reader of a table takes: ``upto=N`` stands for all batches of its stream up to N."""
    live = []
    for kinds in _batches(spark, table).values():
        last = max(kinds["upto"], default=-1)
        live += [kinds["upto"][last]] if last >= 0 else []
        live += [path for n, path in sorted(kinds["batch_id"].items()) if n > last]
    return live or [table]


def compact(spark: SparkSession, table: str, schema: StructType, target_bytes: int = 128 << 20) -> None:
    """Puts the finished batches of each stream into one folder with files of about ``target_bytes``.

    Spark packs small files into read partitions of that size, and each is written as one file, without a shuffle.
    The new folder is written aside and renamed at the end, which makes it count and the old ones not: a reader sees
    the old folders or the new one. A run that dies before that is repeated; one that dies after it leaves folders
    that no longer count, which the next run removes.
    """
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(name, None) for name in names]
    for stream, kinds in _batches(spark, table).items():
        last = max(kinds["upto"], default=-1)
        new = {n: path for n, path in kinds["batch_id"].items() if n > last}
        if len(new) > 1:
            aside, upto = f"{stream}/_compacting", max(new)
            try:
                for name, value in zip(names, (target_bytes, 0, 1), strict=True):
                    spark.conf.set(name, str(value))
                parts = ([kinds["upto"][last]] if last >= 0 else []) + [new[n] for n in sorted(new)]
                spark.read.schema(schema).parquet(*parts).write.mode("overwrite").parquet(aside)
            finally:
                for name, value in zip(names, before, strict=True):
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)
            rename(spark, aside, f"{stream}/upto={upto}")
        remove_covered(spark, stream)


def remove_covered(spark: SparkSession, stream: str) -> None:
    """Deletes the folders that a compacted one stands for."""
    table = stream.rsplit("/", 1)[0]
    kinds = _batches(spark, table)[stream]
    last = max(kinds["upto"], default=-1)
    for n, path in [*kinds["batch_id"].items(), *kinds["upto"].items()]:
        if n < last or n == last and path.rsplit("/", 1)[1].startswith("batch_id"):
            remove(spark, path)


def load_history(spark: SparkSession, log: str) -> DataFrame:
    return read_table(spark, log, LOAD_LOG)


# --- staging to refined cards ------------------------------------------------------------------


def as_refined(rows: DataFrame) -> DataFrame:
    inserted = rows.filter(F.col("metadata_action") == "INSERT")
    return (
        typed_cards(inserted)
        .withColumn("loaded_at", F.current_timestamp())
        .select(*CARD_TRANSACTIONS.names)
    )


def refine(
    spark: SparkSession,
    stage: str,
    table: str,
    checkpoint: str,
    log: str | None = None,
    pattern: str | None = None,
    since: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Consume the change stream of a stage into the refined table; the offset moves on commit."""
    return load_once(
        change_stream(spark, stage, pattern, since),
        table,
        checkpoint,
        log,
        shape=as_refined,
        table_name="CC_TRANS_ALL",
        every=every,
    )


def pending_files(spark: SparkSession, stage: str, log: str) -> DataFrame:
    """Staged files the consumer has not loaded; looking does not move its offset."""
    files = list_stage(spark, stage)
    loaded = loaded_files(spark, log)
    return files.join(loaded, files["name"] == loaded["file_name"], "left_anti") if loaded else files


def loaded_files(spark: SparkSession, log: str) -> DataFrame | None:
    """Names of loaded files; nothing before the first load. A log that cannot be read is an error."""
    if not exists(spark, log):
        return None
    return load_history(spark, log).select("file_name").distinct()


def peek(spark: SparkSession, stage: str, log: str) -> DataFrame:
    """Pending documents of a stage, typed, as a batch frame."""
    documents = (
        spark.read.option("multiLine", True)
        .option("singleVariantColumn", "document")
        .json(stage)
        .select("document", F.col("_metadata.file_path").alias("source_file"))
    )
    loaded = loaded_files(spark, log)
    if loaded is not None:
        documents = documents.join(
            loaded, F.col("source_file") == F.col("file_name"), "left_anti"
        )
    return typed_cards(explode_documents(documents))


def backlog(spark: SparkSession, stage: str, log: str) -> DataFrame:
    """Number of pending documents as a one-row frame."""
    return peek(spark, stage, log).agg(F.count("*").alias("pending"))


def load_then_refine(
    spark: SparkSession,
    stage: str,
    staging: str,
    table: str,
    checkpoints: str,
    pattern: str | None = None,
    log: str | None = None,
) -> None:
    """Stage files to the staging table, and only then staging table to refined table."""
    load_once(
        change_stream(spark, stage, pattern).drop("metadata_action"),
        staging,
        f"{checkpoints}/load",
        log,
        shape=lambda rows: rows.select("json_data", "source_file"),
        table_name="CC_TRANS_STAGING",
    ).awaitTermination()
    staged = (
        spark.readStream.schema(STAGED)
        .parquet(staging)
        .withColumn("metadata_action", F.lit("INSERT"))
    )
    load_once(
        staged, table, f"{checkpoints}/refine", shape=as_refined, table_name="CC_TRANS_ALL"
    ).awaitTermination()

"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import fresh_dir

# The white space of the text contracts, and the ASCII letters that are lower-cased.
SPACE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def one_space(text: Column) -> Column:
    """Every run of white space as one space. A lone space is not matched, as it would be put back."""
    return F.regexp_replace(text, rf"{SPACE}{{2,}}|[\x09-\x0D]", " ")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most BATCH_ROWS rows: whole texts go to Python, so ten times as many rows (the
    default) would be some hundred MB in the JVM and again in each worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sole(df: DataFrame) -> list:
    """The values of a frame of one row."""
    return list(df.first())


def without(docs: DataFrame, values: DataFrame, column: Column | None = None) -> DataFrame:
    """Rows of ``docs`` whose doc_id, or ``column``, is not in ``values`` (one column; null matches null)."""
    gone = values.toDF("__gone").distinct()
    own = docs["doc_id"] if column is None else column
    return docs.join(gone, own.eqNullSafe(gone["__gone"]), "left_anti")

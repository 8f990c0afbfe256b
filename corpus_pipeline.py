"""A corpus from raw documents: quality filter, exact and near duplicates, benchmark passages, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontamination, exact_dedup, ngram_join, quality
from ledgerloom.llm.common import stored, table, without
from ledgerloom.llm.queries import vocabulary_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.keep_first(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one with the smallest id; rows without an id are no part of any group."""
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        groups = stored(ngram_join.similar_documents(docs), "pipeline-groups")
        return without(docs, groups.where("doc_id <> component_id").select("doc_id"))
    # Rows that share an id are different documents here: each gets a key of its own.
    rows = docs.where("doc_id IS NOT NULL").withColumn("__row", F.monotonically_increasing_id())
    rows = stored(rows, "pipeline-rows")
    groups = ngram_join.similar_documents(rows.select(F.col("__row").alias("doc_id"), "text"))
    groups = stored(groups.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group")), "pipeline-groups")
    named = groups.join(rows.select("__row", "doc_id"), "__row")
    first = named.groupBy("group").agg(F.min(F.struct("doc_id", "__row"))["__row"].alias("__row"))
    kept = rows.join(first.select("__row"), "__row", "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window similar to a benchmark item; the text alone decides, not the id."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (the text that the ids give back)."""
    coded = bpe.round_trip(docs, vocabulary_path())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", first_copies),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", token_ids),
]

# The classifier and the similarity searches cannot be stated in SQL; tests compare the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents table; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""Toxicity of texts by a factorization machine over hashed terms.

Terms are the distinct words of a text (ASCII case folded, surrounding punctuation removed), hashed into
``BUCKETS`` buckets. Spark's factorization machine learns a weight for each bucket and a vector for pairwise
interactions, so two terms can count together for more than the sum of both (an insult with a group mention).

The model is fitted on at most ``SAMPLE`` labelled rows, taken by a hash of the id, and knows the ``TERMS``
buckets, of those with at least ``LEAST_DOCS`` documents in that sample, that tell the classes apart best; every document is scored over
its whole text. Neither labels nor ids, languages or sources are inputs of a score.

Defined results: null and empty texts get the score of a text without terms; a document with several labels
counts as toxic if one is; null labels are left out; without toxic and non-toxic examples every score is the
share of toxic ones (0.5 without any label); repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, stored, whole_text
from ledgerloom.llm.shingles import words_of

BUCKETS = 1 << 20
SAMPLE = 20_000
TERMS = 1_024
LEAST_DOCS = 8
REGULAR, ITERATIONS = 1e-2, 120
CACHE = 250_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class TermBuckets(dict):
    """Bucket of each word, kept between texts in a bounded cache; -1 for words of punctuation only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        bare = word.strip(PUNCTUATION)
        value = self[word] = xxhash.xxh3_64_intdigest(bare) % BUCKETS if bare else -1
        return value

    def of(self, text: str) -> np.ndarray:
        words = set(words_of(text))
        found = np.unique(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        return found[found >= 0]


@dataclass(frozen=True)
class Machine:
    """A fitted model: sorted known buckets, bias, weights and interaction vectors."""

    known: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def places(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, buckets), len(self.known) - 1)
        return at[self.known[at] == buckets]

    def score(self, buckets: np.ndarray) -> float:
        at = self.places(buckets)
        v = self.factors[at]
        margin = self.bias + self.weights[at].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum()
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))))


def _bucketed(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the distinct buckets of each text."""
    small_batches(docs.sparkSession)
    source = docs.select(*keep, whole_text().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = TermBuckets()
        for batch in batches:
            found = [terms.of(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(found, pa.list_(pa.int32()))], [*keep, "buckets"]
            )

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keep)
    return source.mapInArrow(work, f"{kinds}, buckets array<int>")


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Machine:
    """Fit on ``labels`` (doc_id, toxic); the caller leaves out what is not to be learned from."""
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = SAMPLE / max(1, labels.count())
    if share < 1:  # a little below the bound, so that it holds; the limit below is never reached in practice
        labels = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < int(share * 0.95e6))
    labels = labels.limit(SAMPLE).withColumnRenamed("doc_id", "__id")
    rows = docs.join(F.broadcast(labels), docs["doc_id"] == F.col("__id")).select(
        F.col("text").alias("text"), F.col("toxic").cast("double").alias("label")
    )
    rows = stored(_bucketed(rows, "label"), "toxicity-sample")
    toxic, total = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    counts = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.count("*").alias("c"), F.sum("label").alias("t")).where(F.col("c") >= LEAST_DOCS)
    expected = F.col("c") * (toxic / max(1, total))
    # The terms whose documents' share of toxic ones departs most from the average, in deviations.
    apart = F.abs(F.col("t") - expected) / F.sqrt(expected + 1e-9)
    known = counts.orderBy(F.desc(apart), "bucket").limit(TERMS)
    known = np.array(sorted(r["bucket"] for r in known.collect()), np.int64)
    if not len(known) or toxic in (0, total):
        even = (toxic + 1e-3) / (total + 2e-3)
        return Machine(known[:0], float(np.log(even / (1 - even))), np.empty(0), np.empty((0, 1)))
    empty = Machine(known, 0.0, np.zeros(len(known)), np.zeros((len(known), 1)))

    @F.udf(VectorUDT())
    def features(buckets):
        at = empty.places(np.asarray(buckets, np.int64))
        return Vectors.sparse(len(known), at.tolist(), [1.0] * len(at))

    # A bounded table that every iteration reads: two partitions keep the small jobs short.
    vectors = stored(rows.select("label", features("buckets").alias("features")).coalesce(2), "toxicity-vectors")
    machine = FMClassifier(
        factorSize=4, initStd=0.1, stepSize=0.1, regParam=REGULAR, maxIter=ITERATIONS, solver="adamW", seed=seed
    ).fit(vectors)
    return Machine(known, machine.intercept, machine.linear.toArray(), machine.factors.toArray())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1) of every whole text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", whole_text().alias("text"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most TERMS rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, own = TermBuckets(), shared.value
        for batch in batches:
            scores = [own.score(terms.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return source.mapInArrow(work, f"doc_id {id_type}, score double")

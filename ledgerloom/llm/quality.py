"""Document quality by co-training of two classifiers with separate views.

The text view sees the words (with their case folded and their punctuation kept) and the endings of words;
the page view sees metadata and layout: language, source, recorded length, number and length of lines, share
of symbols and digits, repeated lines. Each view is a logistic regression over hashed features. In every
round each classifier labels a pool of documents without labels; where it is sure (``SURE``), the other one
learns from that label in the next round. At the end both views' margins on labelled rows that neither has
seen calibrate a combination, which scores every document over its whole text.

Fitting uses at most ``SAMPLE`` labelled rows and ``POOL`` pool rows, taken by a hash of the id; scoring covers
all rows. Defined results: null texts are empty, null metadata is a value of its own; of several labels of a
document the lower one counts, null labels are left out; without both classes every score is the share of
good ones (1 without any label); repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, stored, whole_text
from ledgerloom.llm.shingles import words_of

BUCKETS = 1 << 20
SAMPLE, POOL = 16_000, 8_000
TERMS = 1_024
LEAST_DOCS = 5
ROUNDS = 3
FIT_TASKS = 2
SURE = 0.98
REJECT_BELOW = 0.3  # clean documents are dearer than junk
CACHE = 150_000
VIEWS = ("text_view", "page_view")
META = ("lang", "source", "n_chars")


def _bucket(feature: bytes) -> int:
    return xxhash.xxh3_64_intdigest(feature) % BUCKETS


class WordFeatures(dict):
    """Buckets of a word and of its ending (the characters behind its last letter), in a bounded cache."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= CACHE:
            self.clear()
        ending = word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        value = self[word] = (_bucket(b"w" + word), _bucket(b"e" + word[len(ending) :]))
        return value

    def of(self, words: list[bytes]) -> set[int]:
        found: set[int] = set()
        found.update(*map(self.__getitem__, set(words)))
        return found


def _scale(x: float) -> int:
    return int(2 * np.log2(1 + x))


def page_features(text: str, words: list[bytes], lang, source, n_chars) -> set[int]:
    """Buckets of metadata and layout."""
    lines = text.split("\n")
    size = max(1, len(text))
    raw = text.encode()
    symbols = len(raw) - len(raw.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    told = (
        ("lang", lang),
        ("source", source),
        ("recorded", None if n_chars is None else _scale(max(0, n_chars))),
        ("size", _scale(len(text))),
        ("words", _scale(len(words))),
        ("lines", _scale(len(lines))),
        ("line", _scale(size / len(lines))),
        ("word", _scale(size / max(1, len(words)))),
        ("symbols", int(50 * symbols / size)),
        ("digits", int(50 * digits / size)),
        ("repeats", int(10 * (1 - len(set(lines)) / len(lines)))),
    )
    return {_bucket(f"{name}={value}".encode()) for name, value in told}


def _columns(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, the text and the metadata, each null where the table has no such column."""
    small_batches(docs.sparkSession)
    have = set(docs.columns)
    meta = [
        F.expr(f"try_cast(`{c}` AS {'long' if c == 'n_chars' else 'string'})").alias(f"__{c}")
        if c in have
        else F.lit(None).cast("long" if c == "n_chars" else "string").alias(f"__{c}")
        for c in META
    ]
    return docs.select(*keep, whole_text().alias("__text"), *meta)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("__text", *(f"__{c}" for c in META))), strict=True)


def _features(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the buckets of both views."""
    source = _columns(docs, *keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordFeatures()
        for batch in batches:
            text_view, page_view = [], []
            for text, lang, site, n_chars in _rows(batch):
                words = words_of(text)
                text_view.append(list(cache.of(words)))
                page_view.append(list(page_features(text, words, lang, site, n_chars)))
            lists = [pa.array(v, pa.list_(pa.int32())) for v in (text_view, page_view)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *lists], [*keep, *VIEWS])

    kinds = ", ".join(f"{k} {source.schema[k].dataType.simpleString()}" for k in keep)
    return source.mapInArrow(work, f"{kinds}, text_view array<int>, page_view array<int>")


@dataclass(frozen=True)
class View:
    """A linear classifier over known buckets."""

    known: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, buckets: set[int]) -> float:
        found = np.fromiter(buckets, np.int64, len(buckets))
        return float(self.bias + self.weights[places(self.known, found)].sum())


@dataclass(frozen=True)
class Scorer:
    text: View | None
    page: View | None
    mix: tuple[float, float]
    bias: float

    def scores(self, text_buckets: set[int], page_buckets: set[int]) -> tuple[float, float, float]:
        if self.text is None or self.page is None:
            return _logistic(self.bias), _logistic(self.bias), _logistic(self.bias)
        t, p = self.text.margin(text_buckets), self.page.margin(page_buckets)
        return _logistic(self.bias + self.mix[0] * t + self.mix[1] * p), _logistic(t), _logistic(p)


def _logistic(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def places(known: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Where the buckets that are known stand in the sorted list of them."""
    if not len(known):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, buckets), len(known) - 1)
    return np.unique(at[known[at] == buckets])


def _telling(rows: DataFrame, view: str, good: float, total: int) -> np.ndarray:
    """The TERMS buckets whose share of good documents departs most from the average (bounded, collected)."""
    counts = rows.select("label", F.explode(view).alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.count("*").alias("c"), F.sum("label").alias("g")).where(F.col("c") >= LEAST_DOCS)
    expected = F.col("c") * (1 - good / total)
    apart = F.abs(F.col("c") - F.col("g") - expected) / F.sqrt(expected + 1e-9)
    found = counts.orderBy(F.desc(apart), "bucket").limit(TERMS).collect()
    return np.array(sorted(r["bucket"] for r in found), np.int64)


def _sampled(ids: DataFrame, most: int, salt: int) -> DataFrame:
    share = most / max(1, ids.count())
    if share < 1:
        ids = ids.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(share * 0.95e6))
    return ids.limit(most)


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Scorer:
    """Co-train both views on ``labels`` (doc_id, quality) and a pool of other documents."""
    labels = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = _sampled(labels, SAMPLE, 1)
    pool = _sampled(docs.select("doc_id").where("doc_id IS NOT NULL").distinct().join(labels, "doc_id", "left_anti"), POOL, 2)
    wanted = chosen.select("doc_id", F.col("label").cast("double").alias("label"))
    wanted = wanted.unionByName(pool.select("doc_id", F.lit(None).cast("double").alias("label")))
    wanted = wanted.withColumnRenamed("doc_id", "__id").withColumnRenamed("label", "__label")
    sample = docs.join(F.broadcast(wanted), docs["doc_id"] == F.col("__id"))  # SAMPLE + POOL ids at most
    rows = stored(_features(sample, "__id", "__label"), "quality-sample").withColumnsRenamed({"__id": "id", "__label": "label"})
    rows = rows.withColumn("held", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(4)) == 0)
    labelled = rows.where("label IS NOT NULL")
    good, total = labelled.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    seen = labelled.where("NOT held")
    balance = [r["label"] for held in (True, False) for r in labelled.where(F.col("held") == held).select("label").distinct().collect()]
    if len(balance) < 4:
        even = (good + 1e-3) / (total + 2e-3) if total and good < total else 1 - 1e-6
        return Scorer(None, None, (0.0, 0.0), float(np.log(even / (1 - even))))
    known = {view: _telling(seen, view, good, total) for view in VIEWS}

    def vectors(view: str):
        own = known[view]

        @F.udf(VectorUDT())
        def vector(buckets):
            at = places(own, np.asarray(buckets, np.int64))
            return Vectors.sparse(len(own), at.tolist(), [1.0] * len(at))

        return vector(view).alias(view)

    # A bounded table that every iteration of every fit reads: two partitions keep the small jobs short.
    ready = stored(rows.select("label", "held", *(vectors(v) for v in VIEWS)).coalesce(FIT_TASKS), "quality-vectors")
    seen, pool, held = ready.where("label IS NOT NULL AND NOT held"), ready.where("label IS NULL"), ready.where("label IS NOT NULL AND held")
    fitted, taught = {}, {view: seen for view in VIEWS}
    for turn in range(rounds):
        for view in VIEWS:
            regression = LogisticRegression(
                featuresCol=view, labelCol="label", regParam=0.01, maxIter=15,
                predictionCol=f"{view}_label", probabilityCol=f"{view}_p", rawPredictionCol=f"{view}_raw",
            )
            fitted[view] = regression.fit(taught[view].select("label", view))
        if turn + 1 < rounds:
            for view, other in (VIEWS, VIEWS[::-1]):
                p = vector_to_array(f"{other}_p")[1]
                sure = fitted[other].transform(pool).withColumn("label", F.when(p >= SURE, 1.0).when(p <= 1 - SURE, 0.0))
                taught[view] = seen.select("label", view).unionByName(sure.where("label IS NOT NULL").select("label", view))
    both = held
    for view in VIEWS:
        both = fitted[view].transform(both)
    margins = both.select("label", *(vector_to_array(f"{v}_raw")[1].alias(v) for v in VIEWS))
    pair = F.udf(lambda a, b: Vectors.dense(a, b), VectorUDT())
    mix = LogisticRegression(labelCol="label", regParam=0.001, maxIter=20).fit(
        margins.select("label", pair(*VIEWS).alias("features"))
    )
    views = {v: View(known[v], fitted[v].coefficients.toArray(), fitted[v].intercept) for v in VIEWS}
    return Scorer(views["text_view"], views["page_view"], tuple(mix.coefficients.toArray().tolist()), mix.intercept)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score (calibrated, 0 to 1), text_score, page_score of every whole text."""
    source = _columns(docs, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # two lists of TERMS weights

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, own = WordFeatures(), shared.value
        for batch in batches:
            out = []
            for text, lang, site, n_chars in _rows(batch):
                words = words_of(text)
                out.append(own.scores(cache.of(words), page_features(text, words, lang, site, n_chars)))
            columns = [pa.array([x[i] for x in out], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "score", "text_score", "page_score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {id_type}, score double, text_score double, page_score double")


def keep_good(docs: DataFrame, scorer: Scorer, reject_below: float = REJECT_BELOW) -> DataFrame:
    """Rows of ``docs`` that are not rejected, with all their columns; each row is judged by itself."""
    source = _columns(docs, F.struct(*docs.columns).alias("__row"))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    row_type = source.schema["__row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, own = WordFeatures(), shared.value
        for batch in batches:
            kept = []
            for text, lang, site, n_chars in _rows(batch):
                words = words_of(text)
                kept.append(own.scores(cache.of(words), page_features(text, words, lang, site, n_chars))[0] >= reject_below)
            yield batch.select(["__row"]).filter(pa.array(kept, pa.bool_()))

    return source.mapInArrow(work, f"__row {row_type}").select("__row.*")

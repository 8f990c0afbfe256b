"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index of Hamming blocks, exact check.

An item of w words is sought in the windows of w words (a step of one word) of every whole text, and in a text of
fewer words as one window. A window matches by weighted Jaccard similarity of shingles, the sum of smaller weights
over the sum of larger ones, of at least ``SIMILARITY``. A shingle weighs its number of occurrences divided by the
number of items of the whole benchmark that hold it, so stock phrases count less; one that no item holds weighs 1.

1. A window that matches holds a shingle of its item, so only windows around the items' shingles are fingerprinted,
   by 64 running sums. A shingle adds the root of its weight to each bit's sum: the angle between two such vectors
   then depends on the weighted similarity alone (0.8: 27 degrees, 9.7 of 64 bits on average), however unequal the
   weights are.
2. The items' fingerprints are cut into ``BLOCKS`` blocks, each indexed with all its neighbours of up to ``NEAR``
   other bits. Two fingerprints within ``RADIUS`` < BLOCKS * (NEAR + 1) bits agree that closely in one block, so the
   look-up finds every item within the radius.
3. Those are checked exactly, against bounds from running sums first. The radius is 2.5 deviations beyond the
   average distance at a similarity of 0.8; the tests measure recall against an exact search, by similarity.

Words are runs of non-space, lower-cased in ASCII, without surrounding ASCII punctuation. Items travel to the
tasks in slices of at most ``SLICE_ITEMS`` items and ``SLICE_BYTES`` bytes, one pass over the documents each.

Defined results: null or empty texts and items match nothing; an item shorter than a shingle is one shingle;
items with equal text are each reported; repeated documents are each reported; of equally similar windows the
first counts; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, sole, stored, whole_text
from ledgerloom.llm.shingles import WORDS, shingle_hashes, words_of

SIMILARITY = 0.8
BLOCKS, NEAR, RADIUS = 6, 2, 17
SLICE_ITEMS, SLICE_BYTES = 20_000, 32 << 20
CACHE = 250_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BITS = np.arange(64, dtype=np.uint64)


def _bare(word: bytes) -> bytes:
    return word.strip(PUNCTUATION) or word


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) or 1  # 0 marks words that no item holds


def fingerprints(shingles: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """SimHash of each run of ``window`` shingles, from running sums per bit."""
    # A shingle's hash decides each bit's sign; it is mixed once more so that similar shingles differ.
    mixed = shingles * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    signs = ((mixed[:, None] >> _BITS) & np.uint64(1)).astype(np.int8) * 2 - 1
    sums = np.zeros((len(shingles) + 1, 64))
    np.cumsum(signs * weights[:, None], axis=0, out=sums[1:])
    over = (sums[window:] - sums[:-window]) > 1e-9
    return (over.astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def _block(fingerprint: int, b: int) -> int:
    low, high = 64 * b // BLOCKS, 64 * (b + 1) // BLOCKS
    return (fingerprint >> low) & ((1 << (high - low)) - 1)


def _near_masks(bits: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(NEAR + 1) for c in combinations(range(bits), k)]


class Gate(dict):
    """A word's hash if an item holds the word, else 0; kept between texts in a bounded cache."""

    def __init__(self, known: dict[bytes, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.known.get(_bare(word), 0)
        return value


class Items:
    """The items of one slice: their shingles, weights and anchors.

    ``shared`` has the shingles that several items of the whole benchmark hold, in order, and their numbers of
    items; without it the rows are the whole benchmark.
    """

    def __init__(self, rows: tuple[tuple[object, str], ...], shared: tuple[np.ndarray, np.ndarray] | None = None):
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes, parts = [], [], []
        for item_id, text in rows:
            words = [_bare(w) for w in words_of(text)]
            if words:
                self.known.update((w, _hash(w)) for w in words)
                self.ids.append(item_id)
                self.sizes.append(len(words))
                parts.append(shingle_hashes(np.array([self.known[w] for w in words], np.uint64)))
        if shared is None:
            held = Counter(s for p in parts for s in set(p.tolist()))
            many = sorted((s, n) for s, n in held.items() if n > 1)
            shared = (np.array([s for s, _ in many], np.uint64), np.array([n for _, n in many], np.int64))
        self.shared, self.shared_weight = shared[0], 1.0 / shared[1]
        self.parts = parts
        self.bags = [Counter(p.tolist()) for p in parts]
        self.totals = [float(self._weights(p).sum()) for p in parts]
        self.holders: dict[int, set[int]] = {}  # shingle -> sizes of the items that hold it
        for size, bag in zip(self.sizes, self.bags, strict=True):
            for s in bag:
                self.holders.setdefault(s, set()).add(size)
        self.shingles = np.array(sorted(self.holders), np.uint64)
        self.lengths = sorted(set(min(s, WORDS) for s in self.sizes))
        self.gate = Gate(self.known)

    def _weights(self, shingles: np.ndarray) -> np.ndarray:
        out = np.ones(len(shingles))
        if len(self.shared):
            place = np.minimum(np.searchsorted(self.shared, shingles), len(self.shared) - 1)
            hit = self.shared[place] == shingles
            out[hit] = self.shared_weight[place[hit]]
        return out

    @cached_property
    def prints(self) -> list[int]:
        return [int(fingerprints(p, np.sqrt(self._weights(p)), len(p))[0]) for p in self.parts]

    @cached_property
    def index(self) -> list[dict[int, list[int]]]:
        index: list[dict[int, list[int]]] = [{} for _ in range(BLOCKS)]
        for b, found in enumerate(index):
            masks = _near_masks(64 * (b + 1) // BLOCKS - 64 * b // BLOCKS)
            for i, fingerprint in enumerate(self.prints):
                for mask in masks:
                    found.setdefault(_block(fingerprint, b) ^ mask, []).append(i)
        return index

    def within(self, fingerprint: int) -> set[int]:
        """Items whose fingerprint differs in at most RADIUS bits."""
        near = set()
        for b, found in enumerate(self.index):
            near.update(found.get(_block(fingerprint, b), ()))
        return {i for i in near if (self.prints[i] ^ fingerprint).bit_count() <= RADIUS}

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        bag, own = Counter(shingles.tolist()), self.bags[item]
        weight = dict(zip(bag, self._weights(np.array(list(bag), np.uint64)).tolist(), strict=True))
        both = sum(min(n, own[s]) * weight[s] for s, n in bag.items() if s in own)
        total = sum(n * weight[s] for s, n in bag.items()) + self.totals[item]
        return both / (total - both)

    def matches(self, text: str) -> dict[int, tuple[float, int]]:
        """item -> (similarity, first word) of the best window of a text."""
        words = words_of(text)
        gated = np.fromiter(map(self.gate.__getitem__, words), np.uint64, len(words))
        best: dict[int, tuple[float, int]] = {}
        own_hashes = None
        for length in self.lengths:
            if len(words) < length or not gated.any():
                continue
            grams = shingle_hashes(gated, length)
            full = np.ones(len(grams), bool)
            for k in range(length):
                full &= gated[k : k + len(grams)] != 0
            at = np.flatnonzero(full)
            place = np.minimum(np.searchsorted(self.shingles, grams[at]), len(self.shingles) - 1)
            at = at[self.shingles[place] == grams[at]]
            if not len(at):
                continue
            starts: dict[int, list[tuple[int, int]]] = {}  # words of the window -> ranges of its starts
            for p, s in zip(at.tolist(), grams[at].tolist(), strict=True):
                for size in {min(size, len(words)) for size in self.holders[s]}:
                    low, high = max(0, p - size + length), min(p, len(words) - size)
                    if min(size, WORDS) == length and low <= high:
                        ranges = starts.setdefault(size, [])
                        if ranges and low <= ranges[-1][1] + 1:
                            ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
                        else:
                            ranges.append((low, high))
            if not starts:
                continue
            if own_hashes is None:
                own_hashes = gated.copy()
                for j in np.flatnonzero(gated == 0).tolist():
                    own_hashes[j] = _hash(_bare(words[j]))
            shingles = shingle_hashes(own_hashes, length)
            weights = self._weights(shingles)
            for size, ranges in starts.items():
                whole = size == len(words)  # then it stands for the longer items as well
                window = size - length + 1
                for low, high in ranges:
                    part = slice(low, high + window)
                    self._search(size, whole, shingles[part], weights[part], window, low, best)
        return best

    def _search(
        self, size: int, whole: bool, shingles: np.ndarray, weights: np.ndarray, window: int, low: int,
        best: dict[int, tuple[float, int]],
    ) -> None:
        """Windows of one size: items near their fingerprints, and of those the ones that match."""
        near: dict[int, list[int]] = {}
        found: dict[int, set[int]] = {}
        for k, fingerprint in enumerate(fingerprints(shingles, np.sqrt(weights), window).tolist()):
            if fingerprint not in found:
                found[fingerprint] = self.within(fingerprint)
            for item in found[fingerprint]:
                if self.sizes[item] == size or whole and self.sizes[item] > size:
                    near.setdefault(item, []).append(k)
        if not near:
            return
        sums = np.zeros(len(shingles) + 1)
        np.cumsum(weights, out=sums[1:])
        for item, windows in near.items():
            bag, total = self.bags[item], self.totals[item]
            held = np.zeros(len(shingles) + 1)
            np.cumsum(weights * np.fromiter((s in bag for s in shingles.tolist()), bool, len(shingles)), out=held[1:])
            for k in windows:
                own = min(held[k + window] - held[k], total)
                bound = own / (sums[k + window] - sums[k] + total - own) + 1e-9  # not below the similarity
                if bound >= SIMILARITY and bound > best.get(item, (0.0, 0))[0]:
                    similarity = self.similarity(item, shingles[k : k + window])
                    if similarity >= SIMILARITY - 1e-12 and similarity > best.get(item, (0.0, 0))[0]:
                        best[item] = (similarity, low + k)


@lru_cache(maxsize=2)
def _items(rows: tuple[tuple[object, str], ...], shared: bytes, counts: bytes) -> Items:
    return Items(rows, (np.frombuffer(shared, np.uint64), np.frombuffer(counts, np.int64)))


def _shared(items: DataFrame) -> DataFrame:
    """shingle, c, slices: the shingles that more than one item of the whole benchmark holds, their numbers of items,
    and the slices that need them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in zip(batch.column("slice").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = np.array([_hash(_bare(w)) for w in words_of(text)], np.uint64)
                own = np.unique(shingle_hashes(hashes)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([part] * len(own), pa.int64())], ["shingle", "slice"])

    small_batches(items.sparkSession)
    held = items.select("text", "slice").mapInArrow(work, "shingle long, slice long").groupBy("shingle")
    return held.agg(F.count("*").alias("c"), F.collect_set("slice").alias("slices")).where("c > 1")


def _searcher(docs: DataFrame, rows: tuple[tuple[object, str], ...], counts: tuple[bytes, bytes]) -> Callable[[], Items]:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((rows, *counts))
    return lambda: _items(*shared.value)


def _one_slice(docs: DataFrame, items_of: Callable[[], Items], schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = items_of()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for n, text in enumerate(batch.column("text").to_pylist()):
                found = items.matches(text)
                most = len(words_of(text)) if found else 0
                for item, (similarity, start) in found.items():
                    size = min(items.sizes[item], most)
                    for column, value in zip(out, (n, items.ids[item], similarity, start, size), strict=True):
                        column.append(value)
            ids = batch.column("doc_id").take(pa.array(out[0], pa.int64()))
            item_ids = pa.array(out[1], pa.int64() if all(isinstance(x, int) or x is None for x in out[1]) else pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, item_ids, pa.array(out[2], pa.float64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())],
                ["doc_id", "item_id", "similarity", "start_word", "n_words"],
            )

    return docs.mapInArrow(work, schema)


def _clean_rows(docs: DataFrame, items_of: Callable[[], Items]) -> DataFrame:
    source = docs.select(whole_text().alias("text"), F.struct(*docs.columns).alias("__row"))
    row_type = source.schema["__row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = items_of()
        for batch in batches:
            clean = [not items.matches(text) for text in batch.column("text").to_pylist()]
            yield batch.select(["__row"]).filter(pa.array(clean, pa.bool_()))

    return source.mapInArrow(work, f"__row {row_type}").select("__row.*")


def _slices(docs: DataFrame, benchmark: DataFrame) -> Iterator[Callable[[], Items]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    count, size = sole(items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))))
    slices = max(1, math.ceil(count / SLICE_ITEMS * 2) if count > SLICE_ITEMS else 1, math.ceil(size / SLICE_BYTES * 2) if size > SLICE_BYTES else 1)
    items = stored(items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))), "leak-items")
    shared = stored(_shared(items), "leak-shared")
    for k in range(slices):
        rows = tuple((r["item_id"], r["text"]) for r in items.where(F.col("slice") == k).collect())
        found = shared.where(F.array_contains("slices", k)).select("shingle", "c").toArrow()
        shingles = found.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(shingles)
        counts = shingles[order].tobytes(), found.column("c").to_numpy().astype(np.int64)[order].tobytes()
        yield _searcher(docs, rows, counts)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: the best window of each item found in a document
    (n_words: the words of the window).

    item_id must be a whole number. Shingles that several items hold are counted over the whole benchmark; a slice gets
    those of its own items. The slices of the benchmark are collected one by one, within both bounds.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id long, similarity double, start_word long, n_words long"
    source = docs.select("doc_id", whole_text().alias("text"))
    found = None
    for items_of in _slices(docs, benchmark):
        one = _one_slice(source, items_of, schema)
        found = one if found is None else found.unionByName(one)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no window similar to an item, with all their columns; the text alone decides."""
    for items_of in _slices(docs, benchmark):
        docs = _clean_rows(docs, items_of)
    return docs

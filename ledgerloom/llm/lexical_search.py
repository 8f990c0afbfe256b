"""Ranked lexical search of all items against all documents by a dual-tree descent.

The terms are counted in one pass over the texts, which leaves a slim table: of each document its length and the
occurrences of the items' terms. From it come the statistics, and an integer impact of every term in a document. A
document's score for an item is the sum of the item's term weights times the impacts.

Items form one tree, the documents of a batch another; neighbours in a leaf share their weightiest terms. A node holds
the coordinate maxima of what is below it: weights, or impacts. Their product bounds every score between two nodes
from above, so a pair of nodes is left when the bound is below the weakest k-th score of the node's items; whole
batches of documents and items go at once, and none that counts. The k-th scores start with those of every
``SEED``-th document, which the whole table can only raise, and rise as a task goes on. Equal scores are never left.
Sums are whole numbers below 2**53, or computed in 64-bit integers, so they are exact.

Items travel in slices of at most ``SLICE_ITEMS`` items and ``SLICE_BYTES`` bytes (or one item), one pass over the
documents each; a task returns k rows an item at most.

Defined results: null and empty texts have no terms, match nothing and count nowhere; rows with equal ids are items or
documents of their own; of equal scores the smaller doc_id is first, null last; a term that occurs n times in an item
counts n times; fewer than k documents with a score above 0 are all returned; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.quantiles import global_row_number
from ledgerloom.llm.common import UPPER, small_batches, sole, stored, whole_text

# Fixed values of the score: length normalisation in hundredths, the saturation's scales.
B, SCALE, TF_PART, LENGTH_PART = 75, 1_000_000_000, 1000, 8
SEED = 32
SLICE_ITEMS, SLICE_BYTES = 4096, 8 << 20
ITEM_LEAF, DOC_LEAF, FAN = 8, 32, 4
TEXT_BYTES, WORDS = 1 << 20, 200_000  # of what is split and looked up at once
LAST = (1 << 63) - 1  # stands for a null doc_id: behind all others
EXACT = 1 << 53


def _terms_only() -> bytes:
    """Byte map: letters A-Z in lower case, digits, letters and all beyond ASCII as they are, the rest as spaces."""
    keep = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    return bytes(ord(chr(b).lower()) if chr(b) in UPPER else b if b in keep else 0x20 for b in range(256))


_MAP = _terms_only()


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    data = text.encode().translate(_MAP)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + TEXT_BYTES)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


class Tree:
    """A hierarchy over sparse rows in their order: ``levels[0]`` are leaves of ``leaf`` rows, then ``FAN`` nodes in one.

    Each level is (starts, columns, maxima): the sparse coordinate maxima of its nodes.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int):
        self.levels, self.leaf = [], leaf
        owner, nodes = rows // leaf, -(-(int(rows[-1]) + 1) // leaf) if len(rows) else 0
        while nodes:
            key = owner.astype(np.int64) * width + columns
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            values = np.maximum.reduceat(values[order], first)
            owner, columns = key[first] // width, key[first] % width
            self.levels.append((np.searchsorted(owner, np.arange(nodes + 1)), columns, values))
            if nodes == 1:
                break
            owner, nodes = owner // FAN, -(-nodes // FAN)

    def node(self, level: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        starts, columns, values = self.levels[level]
        return columns[starts[i] : starts[i + 1]], values[starts[i] : starts[i + 1]]

    def below(self, level: int, i: int) -> range:
        """Children of a node above the leaves."""
        return range(i * FAN, min((i + 1) * FAN, len(self.levels[level - 1][0]) - 1))

    def rows(self, level: int, i: int) -> slice:
        size = self.leaf * FAN**level
        return slice(i * size, (i + 1) * size)


def _by_heaviest(rows: np.ndarray, columns: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Order of ``n`` rows by their weightiest and second weightiest column."""
    order = np.lexsort((columns, -weights[columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(n))
    keys = []
    for place in (first, first + 1):
        held = np.minimum(place, max(len(rows) - 1, 0))
        keys.append(np.where((place < len(rows)) & (rows[held] == np.arange(n)), columns[held], -1) if len(rows) else np.full(n, -1))
    return np.lexsort((keys[1], keys[0]))


class Items:
    """The items of a slice with their weights, as a tree."""

    def __init__(self, bags: list[tuple[int, dict[int, int]]], weights: np.ndarray, seeds: dict[int, int], k: int):
        self.k, self.width = k, max(len(weights), 1)
        rows = np.array([i for i, (_, bag) in enumerate(bags) for _ in bag], np.int64)
        columns = np.array([t for _, bag in bags for t in bag], np.int64)
        counts = np.array([c for _, bag in bags for c in bag.values()], np.int64)
        order = _by_heaviest(rows, columns, weights, len(bags))
        place = np.empty(len(bags), np.int64)
        place[order] = np.arange(len(bags))
        values = counts * weights[columns] if len(columns) else counts
        largest = np.bincount(rows, values, len(bags)).max() * (SCALE // TF_PART) if len(rows) else 0
        self.kind = np.float64 if largest < EXACT else np.int64
        sort = np.argsort(place[rows], kind="stable")
        rows, columns, values = place[rows][sort], columns[sort], values[sort].astype(self.kind)
        self.numbers = [bags[i][0] for i in order.tolist()]
        self.tree = Tree(rows, columns, values, self.width, ITEM_LEAF)
        self.blocks = []  # of each leaf: items by its own columns
        for i in range(len(self.tree.levels[0][0]) - 1 if self.tree.levels else 0):
            own = self.tree.node(0, i)[0]
            part = slice(*np.searchsorted(rows, (i * ITEM_LEAF, (i + 1) * ITEM_LEAF)))
            block = np.zeros((len(own), min(ITEM_LEAF, len(bags) - i * ITEM_LEAF)), self.kind)
            block[np.searchsorted(own, columns[part]), rows[part] - i * ITEM_LEAF] = values[part]
            self.blocks.append(block)
        self.least = np.array([max(seeds.get(n, 1), 1) for n in self.numbers], np.int64)  # a score that counts

    def start(self) -> None:
        """A new task: no documents found, k-th scores as given."""
        self.found: list[list[tuple[int, int]]] = [[] for _ in self.numbers]
        self.kth = self.least.copy()
        self.dense = np.zeros(self.width, self.kind)
        self.pairs = 0  # leaf pairs that were scored

    def search(self, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, weights: np.ndarray) -> None:
        """Documents ``ids`` with the sparse impacts (rows ascending)."""
        if not len(rows) or not self.tree.levels:
            return
        order = _by_heaviest(rows, columns, weights, len(ids))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        sort = np.argsort(place[rows], kind="stable")
        rows, columns, impacts = place[rows][sort], columns[sort], impacts[sort].astype(self.kind)
        docs = Tree(rows, columns, impacts, self.width, DOC_LEAF)
        ids = ids[order]
        stack = [(len(docs.levels) - 1, 0, len(self.tree.levels) - 1, [0])]
        while stack:
            level, i, at, nodes = stack.pop()
            own, maxima = docs.node(level, i)
            self.dense[own] = maxima
            nodes = self._alive(at, nodes)
            # The items' nodes descend a level with each level of the documents, and all the way at their leaves.
            for _ in range(min(at, 1 if level else at)):
                at, nodes = at - 1, self._alive(at - 1, [c for j in nodes for c in self.tree.below(at, j)])
            self.dense[own] = 0
            if nodes and level:
                stack += [(level - 1, c, at, nodes) for c in docs.below(level, i)]
            elif nodes:
                part = slice(*np.searchsorted(rows, (i * DOC_LEAF, (i + 1) * DOC_LEAF)))
                self._score(ids[i * DOC_LEAF : (i + 1) * DOC_LEAF], rows[part] - i * DOC_LEAF, columns[part], impacts[part], own, nodes)

    def _alive(self, level: int, nodes: list[int]) -> list[int]:
        """Nodes of a level whose bound against the documents' maxima in ``dense`` reaches their weakest k-th score."""
        found = []
        for i in nodes:
            own, weights = self.tree.node(level, i)
            if weights @ self.dense[own] >= self.kth[self.tree.rows(level, i)].min():
                found.append(i)
        return found

    def _score(self, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, own: np.ndarray, leaves: list[int]) -> None:
        """Scores of a leaf's documents for the items of each leaf left."""
        block = np.zeros((len(ids), len(own)), self.kind)
        block[rows, np.searchsorted(own, columns)] = impacts
        for i in leaves:
            self.pairs += 1
            terms = self.tree.node(0, i)[0]
            _, mine, theirs = np.intersect1d(own, terms, assume_unique=True, return_indices=True)
            scores = block[:, mine] @ self.blocks[i][theirs]
            first = i * ITEM_LEAF
            for d, j in np.argwhere(scores >= self.kth[first : first + scores.shape[1]]).tolist():
                entry = int(scores[d, j]), -int(ids[d])
                best = self.found[first + j]
                if len(best) < self.k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == self.k:
                    self.kth[first + j] = max(self.kth[first + j], best[0][0])


def _vectors(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), terms and counts (those of ``known``) of each document that has a term."""
    spark = docs.sparkSession
    small_batches(spark)
    width = max(len(known), 1)
    shared = spark.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            lengths, parts, ids, owners = [], [], [], []

            def flush() -> None:
                key = np.repeat(np.array([d for d, _ in owners], np.int64), [n for _, n in owners]) * width
                found = np.array(ids, np.int64)
                parts.append(np.unique((key + found)[found >= 0], return_counts=True))
                ids.clear()
                owners.clear()

            for d, text in enumerate(batch.column("text").to_pylist()):
                total = 0
                for words in terms_of(text):
                    ids.extend(map(get, words, repeat(-1)))
                    owners.append((d, len(words)))
                    total += len(words)
                    if len(ids) >= WORDS:
                        flush()
                lengths.append(total)
            flush()
            key, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)
            starts = pa.array(np.searchsorted(key, np.arange(len(lengths) + 1) * width), pa.int32())
            columns = {
                "doc_id": batch.column("doc_id"),
                "n": pa.array(lengths, pa.int64()),
                "terms": pa.ListArray.from_arrays(starts, pa.array(key % width, pa.int32())),
                "counts": pa.ListArray.from_arrays(starts, pa.array(counts, pa.int64())),
            }
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array([n > 0 for n in lengths], pa.bool_()))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return stored(source.mapInArrow(work, "doc_id long, n long, terms array<int>, counts array<bigint>"), "term-vectors")


def _searched(vectors: DataFrame, bags: list, weights: np.ndarray, n_docs: int, n_terms: int, k: int, seeds: dict[int, int]) -> DataFrame:
    """item (its number), doc_id, score: of each task the k best documents of each item that may count."""
    small_batches(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast((bags, weights, seeds))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, weights, seeds = shared.value
        items = Items(bags, weights, seeds, k)
        items.start()
        for batch in batches:
            ids = batch.column("doc_id").fill_null(LAST).to_numpy()
            length = 100 - B + (B * batch.column("n").to_numpy() * n_docs) // n_terms
            terms, counts = batch.column("terms"), batch.column("counts").flatten().to_numpy()
            rows = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy())
            impacts = (SCALE * counts) // (TF_PART * counts + LENGTH_PART * length[rows])
            items.search(ids, rows, terms.flatten().to_numpy().astype(np.int64), impacts, weights)
        found = [(n, -key, score) for n, best in zip(items.numbers, items.found, strict=True) for score, key in best]
        number, doc, score = zip(*found, strict=True) if found else ((), (), ())
        doc = pa.array([None if d == LAST else d for d in doc], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), doc, pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    found = vectors.select("doc_id", "n", "terms", "counts").mapInArrow(work, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _slices(items: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """(number, text) of the items, within both bounds at a time: contiguous cuts of a running sum."""
    block = F.expr("number div 1000")
    sized = items.select("number", F.octet_length("text").cast("long").alias("size"), block.alias("block"))
    totals = sized.groupBy("block").agg(F.sum("size").alias("bytes"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per 1,000 items
    totals = totals.select("block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    cut = sized.withColumn("sum", F.coalesce(F.sum("size").over(within), F.lit(0))).join(totals, "block")
    cut = cut.groupBy(F.expr(f"number div {SLICE_ITEMS}").alias("a"), F.expr(f"(base + sum) div {SLICE_BYTES}").alias("b"))
    for low, high in sorted(cut.agg(F.min("number"), F.max("number")).select("min(number)", "max(number)").collect()):
        part = items.where(F.col("number").between(low, high)).select("number", "text")
        yield tuple(sorted((r["number"], r["text"]) for r in part.collect()))


def ranked(docs: DataFrame, benchmark: DataFrame, k: int = 10, seed: int = SEED) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    items = benchmark.select("item_id", whole_text().alias("text"))
    items = stored(global_row_number(items, ["item_id", "text"], "number"), "items")
    out = None
    for rows in _slices(items):
        known: dict[bytes, int] = {}
        bags = []
        for number, text in rows:
            bag = Counter(t for terms in terms_of(text) for t in terms)
            bags.append((number, {known.setdefault(t, len(known)): n for t, n in bag.items()}))
        vectors = _vectors(docs, known)
        n_docs, n_terms = sole(vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))))
        if not n_docs:
            continue
        df = np.zeros(max(len(known), 1), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the slice's terms
            df[term] = n
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        args = (bags, weights, n_docs, n_terms, k)
        first = vectors.where(F.pmod(F.xxhash64("doc_id"), F.lit(seed)) == 0)
        tenth = _searched(first, *args, {}).where(F.col("rank") == k).select("item", "score")
        found = stored(_searched(vectors, *args, {r["item"]: r["score"] for r in tenth.collect()}), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = items.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).limit(0), F.lit(False))
        return empty.select("item_id", F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
    named = out.join(items.select("item_id", "number"), out["item"] == items["number"])
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

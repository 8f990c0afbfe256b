"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a slice of a partition are laid out as one linked list of symbols. An index maps
each pair that has a merge rank to all its positions there; active ranks are applied in ascending order (a
heap), each to all its positions at once, and only the lists of the neighbouring pairs are updated. Ranks
ascend as a merge's parts are always older than its result, so one sweep over the ranks ends the work.

Texts are cut into slices of ``SLICE_CHARS`` characters at most (or one text); known pre-tokens are kept
between slices in a cache of about ``CACHE`` entries; when it is full, those of the current slice stay.
The lowest ranks, which are frequent, are applied to all their positions by array operations.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows are encoded
each; an empty table gives no rows. The vocabulary file is read on the executors from ``path``.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.char_classes import as_ranges, newer_characters
from ledgerloom.llm.common import small_batches, whole_text

SLICE_CHARS = 4_000_000
DENSE = 300  # ranks below are applied by array operations
CACHE = 400_000
WALL, GONE = -1, -2  # between pre-tokens; merged into its left neighbour
SHIFT = 24
MASK = (1 << SHIFT) - 1
# Fixed value: the published split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it prints in Latin-1, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b], spare = chr(spare), spare + 1
    return [symbols[b] for b in range(256)]


class Filled(dict):
    """A dictionary that makes its missing values."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


@contextmanager
def uncollected():
    """Only plain lists are made, no cycles, so the collector need not look at them."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {ord(s): b for b, s in enumerate(symbols)}
        self.first = [vocab[s] for s in symbols]
        self.first_table = np.array(self.first, np.int64)
        self.merges: dict[int, tuple[int, int]] = {}  # pair of ids -> rank, id of the result
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]):
            self.merges.setdefault(vocab[a] << SHIFT | vocab[b], (rank, vocab[a + b]))
        self.bytes = {i: bytes(back[ord(c)] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: token.encode() for token, i in self.special.items()}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.split = regex.compile(PATTERN)
        # Characters that are letters or numbers only in newer Unicode tables than the library's are other signs.
        newer = newer_characters()
        self.beyond = regex.compile(f"[{min(newer)}-\U0010ffff]")  # one range: a quick look first
        newer = as_ranges(newer)
        self.newer = regex.compile(f"[{newer}]")
        classes = PATTERN.replace(r"\p{L}+", rf"[\p{{L}}--[{newer}]]+").replace(r"\p{N}+", rf"[\p{{N}}--[{newer}]]+")
        classes = classes.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])+")
        self.split_newer = regex.compile(classes, regex.V1)
        self.known: dict[str, list[int]] = {}
        self.names = {i: str(i) for i in self.bytes}
        self.both = Filled(self._written)  # a pre-token's ids as text, and the bytes they decode to

    def _written(self, word: str) -> tuple[str, bytes]:
        ids = self.known[word]
        return ",".join(map(self.names.__getitem__, ids)), b"".join(map(self.bytes.__getitem__, ids))

    def learn(self, words: list[str]) -> None:
        """Encode distinct pre-tokens together and put them into the cache."""
        raw = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
        flat = np.full(len(raw) + len(words), WALL, np.int64)
        at = np.arange(len(raw)) + np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        flat[at] = self.first_table[raw]
        right = np.arange(1, len(flat) + 1)
        left = np.arange(-1, len(flat) - 1)
        keys = np.where((flat[:-1] >= 0) & (flat[1:] >= 0), flat[:-1] << SHIFT | flat[1:], -1)
        places: dict[int, list] = {}
        active: list[tuple[tuple[int, int], int]] = []
        self._index(keys, np.arange(len(keys)), places, active)
        heapq.heapify(active)
        while active and active[0][0][0] < DENSE:
            (_, made), key = heapq.heappop(active)
            found = np.unique(np.concatenate(places.pop(key)))
            self._apply_dense(key, made, found, flat, left, right, places, active)
        ids, left, right = flat.tolist(), left.tolist(), right.tolist()
        lists = {key: np.concatenate(parts).tolist() for key, parts in places.items()}
        self._apply(ids, left, right, lists, active)
        flat = np.array(ids, np.int64)
        flat = flat[flat != GONE]
        start, rest = 0, flat.tolist()
        for word, end in zip(words, np.flatnonzero(flat == WALL).tolist(), strict=True):
            self.known[word] = rest[start:end]
            start = end + 1

    def _index(self, keys: np.ndarray, at: np.ndarray, places: dict, active: list) -> None:
        """Enter positions into the lists of their pairs, as far as these have a rank; new pairs go to ``active``."""
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        distinct, starts = np.unique(keys[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)]
        for key, start, end in zip(distinct.tolist(), starts.tolist(), ends, strict=True):
            if key in self.merges:
                if key in places:
                    places[key].append(at[order[start:end]])
                else:
                    places[key] = [at[order[start:end]]]
                    active.append((self.merges[key], key))

    def _apply_dense(self, key: int, made: int, found: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray, places: dict, active: list) -> None:
        """One rank at all its positions by array operations: worth it for the low ranks, which are frequent."""
        a, b = key >> SHIFT, key & MASK
        found = found[(ids[found] == a) & (ids[right[found]] == b)]
        if a == b and len(found) > 1:  # in a run of one symbol every other position counts
            linked = np.r_[False, right[found[:-1]] == found[1:]]
            heads = np.flatnonzero(~linked)
            since = np.arange(len(found)) - np.repeat(heads, np.diff(np.r_[heads, len(found)]))
            found = found[since % 2 == 0]
        if not len(found):
            return
        gone = right[found]
        after = right[gone]
        ids[found], ids[gone] = made, GONE
        right[found], left[after] = after, found
        follow, before = ids[after], left[found]
        ahead = np.where(before >= 0, ids[before], WALL)
        keys = np.concatenate((made << SHIFT | follow, ahead << SHIFT | made))
        at = np.concatenate((found, before))
        whole = np.concatenate((follow >= 0, ahead >= 0))
        fresh: list = []
        self._index(keys[whole], at[whole], places, fresh)
        for entry in fresh:
            heapq.heappush(active, entry)

    def _apply(self, ids: list[int], left: list[int], right: list[int], places: dict[int, list[int]], active: list) -> None:
        """The other ranks, in ascending order, position by position."""
        merges, get = self.merges, places.get
        while active:
            (_, made), key = heapq.heappop(active)
            a, b = key >> SHIFT, key & MASK
            found = places.pop(key)
            if a == b:  # only then can places overlap; the left one goes first
                found.sort()
            for i in found:
                if ids[i] != a or ids[j := right[i]] != b:
                    continue  # an earlier merge took one of the two
                ids[i], ids[j] = made, GONE
                after = right[i] = right[j]
                left[after] = i
                if (other := ids[after]) >= 0:
                    near = made << SHIFT | other
                    if (held := get(near)) is not None:
                        held.append(i)
                    elif near in merges:
                        places[near] = [i]
                        heapq.heappush(active, (merges[near], near))
                before = left[i]  # -1 before the first symbol: the last one, a wall
                if (other := ids[before]) >= 0:
                    near = other << SHIFT | made
                    if (held := get(near)) is not None:
                        held.append(before)
                    elif near in merges:
                        places[near] = [before]
                        heapq.heappush(active, (merges[near], near))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        with uncollected():
            get = self.known.__getitem__
            return [
                list(chain.from_iterable(chain.from_iterable(map(get, p)) if isinstance(p, list) else (p,) for p in piece))
                for piece in self._split(texts)
            ]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the decimal ids with commas, SHA-256 of the text decoded from them.

        A pre-token's ids are written and decoded once, when it is first met; a text joins what its pre-tokens have.
        Each decodes to whole characters, so their bytes in a row are the decoded text's.
        """
        out, get = [], self.both.__getitem__
        with uncollected():
            for piece in self._split(texts):
                pairs: list[tuple[str, bytes]] = []
                for part in piece:
                    pairs += map(get, part) if isinstance(part, list) else [(self.names[part], self.bytes[part])]
                written, decoded = zip(*pairs, strict=True) if pairs else ((), ())
                written, decoded = ",".join(written), b"".join(decoded)
                n = written.count(",") + 1 if written else 0
                out.append((n, hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return out

    def _split(self, texts: list[str]) -> list[list]:
        """Per text: lists of pre-tokens, all of them known, with the ids of special tokens between them."""
        parts = []
        for text in texts:
            if self.cut is None or not (found := list(self.cut.finditer(text))):
                parts.append([self.pre_tokens(text)])
                continue
            pieces, at = [], 0
            for m in found:
                pieces += [self.pre_tokens(text[at : m.start()]), self.special[m.group()]]
                at = m.end()
            parts.append([*pieces, self.pre_tokens(text[at:])])
        words = set().union(*(p for piece in parts for p in piece if isinstance(p, list)))
        if new := [w for w in words if w not in self.known]:
            if len(self.known) + len(new) > CACHE:  # what this slice needs stays
                for held in (self.known, self.both):
                    kept = {w: held[w] for w in words if w in held}
                    held.clear()
                    held.update(kept)
            self.learn(new)
        return parts

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and self.beyond.search(text) and self.newer.search(text):
            return self.split_newer.findall(text)
        return self.split.findall(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def _ids_column(ids: list[list[int]]) -> pa.Array:
    lengths = [0]
    for x in ids:
        lengths.append(lengths[-1] + len(x))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, lengths[-1])
    return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))


DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def _run(docs: DataFrame, path: str, wanted: tuple[str, ...]) -> DataFrame:
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", whole_text().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in _slices(texts):
                columns = {"doc_id": batch.column("doc_id").slice(start, end - start)}
                if "digests" in wanted:
                    found = zip(*own.digests(texts[start:end]), strict=True)
                    for name, kind, values in zip(DIGESTS, (pa.int64(), pa.string(), pa.string()), found, strict=True):
                        columns[name] = pa.array(values, kind)
                    yield pa.RecordBatch.from_pydict(columns)
                    continue
                ids = own.encode(texts[start:end])
                if "ids" in wanted:
                    columns["ids"] = _ids_column(ids)
                if "decoded" in wanted:
                    columns["decoded"] = pa.array(map(own.decode, ids), pa.string(), size=len(ids))
                yield pa.RecordBatch.from_pydict(columns)

    kinds = {"ids": "ids array<int>", "decoded": "decoded string"}
    kinds["digests"] = "{} long, {} string, {} string".format(*DIGESTS)
    return source.mapInArrow(work, ", ".join([f"doc_id {id_type}", *(kinds[w] for w in wanted)]))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the token ids of each whole text."""
    return _run(docs, path, ("ids",))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded: the text of each list of ids (null: empty); ids that do not exist are an error."""
    small_batches(tokens.sparkSession)
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    source = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            decoded = [own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": pa.array(decoded, pa.string())})

    return source.mapInArrow(work, f"doc_id {id_type}, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: both directions in one pass over the texts."""
    return _run(docs, path, ("ids", "decoded"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: both directions, with only their hashes as the result."""
    return _run(docs, path, ("digests",))

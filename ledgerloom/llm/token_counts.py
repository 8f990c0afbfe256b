"""Token counts by a compiled finite-state transducer whose chunk maps compose.

The tokenizer (byte-level BPE behind the published split pattern) is compiled into one deterministic transducer
over characters: each transition carries the number of tokens that the character adds (it may be negative, when
tokens merge). A state is the split pattern's position and, for the open pre-token, its live suffixes: those that
a longer token may start with, each with the last token and the number of tokens before it. This is all that the
rest of the pre-token can depend on: of the tokens that end a prefix exactly one fits the token before it, and two
tokens fit if no merge across their seam comes before the merges that build them. States are compiled when they
are first met; at ``STATES`` states the machine starts anew.

Texts are cut into chunks of ``CHUNK`` bytes. The map of a chunk is (head, count, tail): from every state, the
head is read in that state, then come ``count`` tokens, and the state behind it is the one after ``tail``, read
from the start. Head and tail end and begin at a reset, a place that the pattern cuts in every state (a letter,
number or other sign before a character of another class). States are written as the bytes that lead to them, as
their numbers differ between workers. A chunk without a reset is all head. Maps compose associatively,
(h, m, t) (g, n, u) = (h, m + tokens(t g) + n, u), so prefix scans of ``FAN`` maps at a time, run in parallel over
all texts, end with one count per text.

Defined results: null and empty texts have no bytes and no tokens; special strings in a text are one token each;
repeated rows and ids are counted each; an empty table gives no rows; nothing is cut off for length.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import byte_symbols
from ledgerloom.llm.char_classes import LETTER, NUMBER, OTHER, QUOTE, SPACE, WHITE, class_of
from ledgerloom.llm.common import small_batches, sole, stored, whole_text

CHUNK = 1 << 16
FAN = 64
STATES = 300_000
NEVER = 1 << 30
START, PAIR = "start", "contraction"  # places in the split pattern besides the character classes
# The contractions of the published split pattern.
SHORT, LONG = "stmd", {"r": "e", "v": "e", "l": "l"}

Live = tuple[tuple[bytes, int, int], ...]  # suffix, last token before it (-1: none), tokens since


class State(dict):
    """Character -> (next state, tokens added). Missing transitions are compiled."""

    __slots__ = ("machine", "place", "live", "held")

    def __init__(self, machine: Transducer, place, live: Live, held: str):
        super().__init__()
        self.machine, self.place, self.live, self.held = machine, place, live, held

    def __missing__(self, char: str) -> tuple[State, int]:
        found = self[char] = self.machine.move(self, char)
        return found


class Transducer:
    """Counting transducer of one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        symbol = {s: bytes([b]) for b, s in enumerate(byte_symbols())}
        raw = {token: b"".join(map(symbol.__getitem__, token)) for token in model["vocab"]}
        self.tokens = {raw[token]: i for token, i in model["vocab"].items()}
        self.growing = {b[:k] for b in self.tokens for k in range(len(b))}
        self.ranks: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = self.tokens[raw[a]], self.tokens[raw[b]]
            self.ranks.setdefault(pair, rank)
            parts.setdefault(self.tokens[raw[a] + raw[b]], (*pair, rank))
        self.parts = parts
        self.fitting: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.margin = max((len(s.encode()) for s in self.special), default=0)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        self.states: dict[tuple, State] = {}
        self.start = self.state(START)

    def state(self, place, live: Live = ((b"", -1, 0),), held: str = "") -> State:
        key = (place, live, held)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, place, live, held)
        return found

    # Byte pair encoding

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one edge of a token from its first byte merge on, with the rank that uses each up."""
        known = self.edges[side].get(token)
        if known is None:
            edge, part, rank = [(token, NEVER)], token, NEVER
            while part in self.parts:
                *sides, rank = self.parts[part]
                part = sides[side]
                edge.append((part, rank))
            known = self.edges[side][token] = edge[::-1]
        return known

    def fits(self, first: int, second: int) -> bool:
        """Do the bytes of two tokens in a row encode to just these two?"""
        known = self.fitting.get((first, second))
        if known is not None:
            return known
        if len(self.fitting) > 2 * STATES:
            self.fitting.clear()
        left, right = iter(self._edge(first, 1)), iter(self._edge(second, 0))
        (a, a_rank), (b, b_rank) = next(left), next(right)
        verdict = True
        while True:
            seam = self.ranks.get((a, b), NEVER)
            if seam < a_rank and seam <= b_rank and seam < NEVER:  # at equal ranks the left place goes first
                verdict = False
                break
            if a_rank == b_rank == NEVER:
                break
            if a_rank <= b_rank:
                a, a_rank = next(left)
            else:
                b, b_rank = next(right)
        self.fitting[first, second] = verdict
        return verdict

    def feed(self, live: Live, data: bytes) -> tuple[Live, int]:
        """Live suffixes and tokens added after more bytes of a pre-token."""
        added = 0
        for b in data:
            byte = bytes((b,))
            grown = [(suffix + byte, last, since) for suffix, last, since in live]
            for suffix, last, since in grown:  # longest first
                token = self.tokens.get(suffix)
                if token is not None and (last < 0 or self.fits(last, token)):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            step = 1 - since
            live = (*((s, last, n + step) for s, last, n in grown if s in self.growing), (b"", token, 0))
            added += step
        return live, added

    # The split pattern

    def _into(self, place, live: Live, text: str, held: str = "") -> tuple[State, int]:
        live, added = self.feed(live, text.encode())
        return self.state(place, live, held), added

    def _chain(self, state: State, text: str, added: int = 0) -> tuple[State, int]:
        for char in text:
            state, more = state[char]
            added += more
        return state, added

    def move(self, state: State, char: str) -> tuple[State, int]:
        place, kind = state.place, class_of(char)
        if place == START:
            if kind in (SPACE, WHITE):  # white space is held back: its last character may lead the next pre-token
                return self.state(SPACE, held=char), 0
            return self._into(kind, state.live, char)
        if place == SPACE:
            if kind in (SPACE, WHITE):
                return self._into(SPACE, state.live, state.held, char)
            if state.held == " ":
                return self._into(OTHER if kind == QUOTE else kind, self.start.live, state.held + char)
            return self._chain(self.start, char, self.feed(self.start.live, state.held.encode())[1])
        if place in (LETTER, NUMBER) and kind == place or place in (OTHER, QUOTE) and kind in (OTHER, QUOTE):
            return self._into(OTHER if place == QUOTE else place, state.live, char)
        if place == QUOTE and char in SHORT:
            return self.start, self.feed(state.live, char.encode())[1]
        if place == QUOTE and char in LONG:
            return self.state(PAIR, state.live, char), 0
        if place == PAIR and LONG[state.held] == char:
            return self.start, self.feed(state.live, (state.held + char).encode())[1]
        return self._chain(self.start, state.held + char if place == PAIR else char)

    def end(self, state: State) -> int:
        """Tokens of what is held back when the text ends in ``state``."""
        if state.place == SPACE:
            return self.feed(state.live, state.held.encode())[1]
        return self._chain(self.start, state.held)[1] if state.place == PAIR else 0

    # Texts and chunks

    def _run(self, text: str) -> int:
        state, total = self.start, 0
        for char in text:
            state, added = state[char]
            total += added
        total += self.end(state)
        if len(self.states) > STATES:
            for state in self.states.values():  # they refer to each other
                state.clear()
            self.states.clear()
            self.start = self.state(START)
        return total

    def count(self, text: str) -> int:
        if self.cut is None or not any(s in text for s in self.special):
            return self._run(text)
        pieces = self.cut.split(text)
        return sum(map(self._run, pieces)) + len(pieces) - 1

    def resets(self, text: str) -> np.ndarray:
        """Indexes before which the pattern cuts in every state, none of them within a special string."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, place = np.unique(codes, return_inverse=True)
        kinds = np.array([class_of(chr(c)) for c in distinct.tolist()], np.int8)[place]
        kinds[kinds == WHITE] = SPACE
        kinds[kinds == QUOTE] = OTHER
        found = np.flatnonzero((kinds[1:] != kinds[:-1]) & (kinds[:-1] != SPACE) & (codes[:-1] != ord("'"))) + 1
        for special in self.special:
            for hit in regex.finditer(regex.escape(special), text, overlapped=True):
                found = found[(found <= hit.start()) | (found >= hit.end())]
        return found

    def chunk_map(self, data: bytes, first: bool, last: bool) -> tuple[bytes, int, bytes | None]:
        """(head, count, tail) of a chunk; the tail of a chunk without a reset is None."""
        if first and last:
            return b"", self.count(data.decode()), b""
        begin, stop = 0, len(data)
        while not first and begin < stop and data[begin] & 0xC0 == 0x80:  # the rest of a character cut in two
            begin += 1
        if not last:
            for back in range(1, min(4, stop - begin) + 1):
                if data[stop - back] & 0xC0 != 0x80:
                    lead = data[stop - back]
                    stop -= back if lead >= 0xC0 and back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4) else 0
                    break
        text = data[begin:stop].decode()
        # A special string may be cut by the chunk's ends: resets as near as that to them do not count.
        low, high = (0 if first else self.margin), len(text) - (0 if last else self.margin)
        found = self.resets(text)
        found = found[(found >= low) & (found <= high)].tolist()
        found = ([0] if first else []) + found + ([len(text)] if last else [])
        if not found:
            return data, 0, None
        i, j = found[0], found[-1]
        head = begin + len(text[:i].encode())
        tail = begin + len(text[:j].encode())
        return data[:head], self.count(text[i:j]), data[tail:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        (head, m, tail), (next_head, n, next_tail) = a, b
        if tail is None:
            return head + next_head, n, next_tail
        if next_tail is None:
            return head, m, tail + next_head
        return head, m + self.count((tail + next_head).decode()) + n, next_tail

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix compositions, by doubling."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i]) for i in range(step, len(maps))]
            step *= 2
        return maps


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


@contextmanager
def _uncollected():
    """No cycle search while states are compiled: they refer to each other, live long, and are dropped by the machine."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


_MAP = "row long, doc_id {id}, n_bytes long, chunk long, chunks long, head binary, n_tokens long, tail binary"


def _map_chunks(chunks: DataFrame, path: str, schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(path)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("data", "chunk", "chunks"))
            with _uncollected():
                maps = [own.chunk_map(data, k == 0, k == n - 1) for data, k, n in zip(*columns, strict=True)]
            yield _with_maps(batch, maps, ("row", "doc_id", "n_bytes", "chunk", "chunks"))

    return chunks.mapInArrow(work, schema)


def _compose_groups(groups: DataFrame, path: str, schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(path)
        for batch in batches:
            maps = [
                own.scan([(m["head"], m["n_tokens"], m["tail"]) for m in group])[-1]
                for group in batch.column("maps").to_pylist()
            ]
            yield _with_maps(batch, maps, ("row", "doc_id", "n_bytes", "chunk", "chunks"))

    return groups.mapInArrow(work, schema)


def _with_maps(batch: pa.RecordBatch, maps: list[tuple], keys: tuple[str, ...]) -> pa.RecordBatch:
    heads, counts, tails = zip(*maps, strict=True) if maps else ((), (), ())
    kinds = (pa.binary(), pa.int64(), pa.binary())
    columns = {name: batch.column(name) for name in keys}
    columns |= {n: pa.array(v, t) for n, v, t in zip(("head", "n_tokens", "tail"), (heads, counts, tails), kinds, strict=True)}
    return pa.RecordBatch.from_pydict(columns)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, chunk: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each whole text; ``path`` names a byte-level BPE file (JSON)."""
    chunk = chunk or CHUNK
    small_batches(docs.sparkSession)
    schema = _MAP.format(id=docs.schema["doc_id"].dataType.simpleString())
    data = whole_text().cast("binary")
    texts = docs.select("doc_id", data.alias("data")).withColumns(
        {"row": F.monotonically_increasing_id(), "n_bytes": F.octet_length("data").cast("long")}
    )
    texts = texts.withColumn("chunks", F.greatest(F.ceil(F.col("n_bytes") / chunk), F.lit(1)).cast("long"))
    pieces = texts.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn(
        "data", F.substring("data", (F.col("chunk") * chunk + 1).cast("int"), F.lit(chunk))
    )
    maps = stored(_map_chunks(pieces, path, schema), "chunk-maps")
    done = maps.where("chunks = 1")
    left = sole(maps.agg(F.max("chunks")))[0] or 1
    while left > 1:
        maps = maps.where("chunks > 1")
        together = F.array_sort(F.collect_list(F.struct("chunk", "head", "n_tokens", "tail")))
        groups = maps.groupBy("row", "doc_id", "n_bytes", F.expr(f"chunk div {FAN}").alias("chunk")).agg(
            F.expr(f"(max(chunks) + {FAN - 1}) div {FAN}").alias("chunks"), together.alias("maps")
        )
        maps = stored(_compose_groups(groups, path, schema), "composed-maps")
        done = done.unionByName(maps.where("chunks = 1"))
        left = -(-left // FAN)
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

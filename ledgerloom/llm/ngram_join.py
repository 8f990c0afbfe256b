"""Self-join of documents on the Jaccard similarity of their word shingles, with a prefix tree.

Two documents link when their sets of five-word shingles have a Jaccard similarity of at least ``JACCARD``.
The result is exact and names for every document the smallest id it can reach by links.

1. Sets. Every whole text becomes a set of 64-bit shingle hashes. Equal sets form a class, represented by
   its smallest id, so copies are never paired.
2. Gate. Similar sets share more than 4/5 of the larger one, so of the first (1/5 + ``REGION``) n hashes in
   hash order they must share REGION * n; documents that share fewer with any other text are alone. Hashes
   are counted with map-side combination, so a passage that is in a third of all rows is one counter a task.
3. Order. For the rest, all hashes are ordered by the number of classes that hold them. A set with fewer than
   4/5 of its hashes held elsewhere is alone. Linked sets share one of the rarest n - ceil(4/5 n) + 1 hashes;
   components of that relation are the candidate families.
4. Prefix tree. The sets of a family, in one global order (frequent first, so that near copies share long
   paths), form a tree; each set walks it once, adding up the overlap of shared paths, and leaves a branch as
   soon as the remaining lengths cannot bring the similarity to the bound. Branches that are already in the
   walker's component are not entered: only components are wanted, so no link between two classes is lost.
5. Families beyond ``FAMILY`` sets are cut: all sets are compared to one leader (linear), which settles a hot
   group of near copies, and the sets that do not link to it meet all sets in tiles of bounded size.

Defined results: words are runs of non-space, A-Z in lower case; a text with fewer words is one shingle; null
and empty texts have an empty set and link with nothing; rows that repeat an id are one node; rows with a null
id get a null component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, sole, stored, whole_text
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import WordHashes, shingle_hashes, words_of

JACCARD = Fraction(4, 5)
REGION = Fraction(1, 10)
FAMILY, FAMILY_HASHES = 1500, 2_000_000  # sets and their hashes that one task compares
TILE, TILE_HASHES = 750, 1_000_000  # the same for each side of a tile
BRANCH = 262_144  # hashes of a branch that are compared at once
GROUP_HASHES, MOST_TASKS = 250_000, 10_000  # hashes of families that a task is given on average; tasks of one stage
BROADCAST_IDS = 1_000_000  # 16 MB of ids at most; more are joined by shuffle


def _ceil(x: Fraction, n: int) -> int:
    return -(-x.numerator * n // x.denominator)


def _hash_set(hashes: WordHashes, text: str) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words_of(text))))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sets(docs: DataFrame, whole: bool) -> DataFrame:
    """doc_id, n, h1, h2 (identity of the set), and its first hashes in hash order, or all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [_hash_set(hashes, t) for t in part.column("text").to_pylist()]
                mixed = [s * np.uint64(0xD6E8FEB86659FD93) for s in sets]
                h1 = [int(s.sum(dtype=np.uint64)) for s in sets]
                h2 = [int((m ^ (m >> np.uint64(32))).sum(dtype=np.uint64)) for m in mixed]
                if not whole:
                    sets_out = [s[: len(s) - _ceil(JACCARD, len(s)) + max(1, _ceil(REGION, len(s)))] for s in sets]
                else:
                    sets_out = sets
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(h1, np.uint64).view(np.int64)),
                        pa.array(np.array(h2, np.uint64).view(np.int64)),
                        _lists(sets_out),
                    ],
                    ["doc_id", "n", "h1", "h2", "hashes"],
                )

    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return source.mapInArrow(work, "doc_id long, n long, h1 long, h2 long, hashes array<long>")


def _bound(share: str, fraction: Fraction, column: str = "n") -> F.Column:
    """``share`` reaches ceil(fraction * column), in whole numbers."""
    return F.expr(f"{share} * {fraction.denominator} >= {column} * {fraction.numerator}")


class PrefixTree:
    """Sets of local ranks, ascending, in a path-compressed tree.

    Sets are numbered by their place in sorted order, nodes in preorder, so what is below a node is one range of both.
    """

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        in_order = [sets[i] for i in self.order]
        lengths = np.array([len(s) for s in in_order])
        self.sizes = np.array([sizes[i] for i in self.order], np.int64)
        shared = np.zeros(len(sets), np.int64)  # leading ranks in common with the set before
        for k in range(1, len(sets)):
            most = min(lengths[k - 1], lengths[k])
            differ = in_order[k - 1][:most] != in_order[k][:most]
            shared[k] = differ.argmax() if differ.any() else most
        self.end_node = np.zeros(len(sets), np.int64)  # where a set ends
        # Of each node: first and last set below, own sets, smallest size and greatest length below, its piece of path.
        nodes: list[tuple[int, int, int, int, int]] = []
        pieces: list[np.ndarray] = []
        inner: list[int] = []
        work = [(0, len(sets), 0, 0)]
        while work:
            first, last, depth, level = work.pop()
            end = int(shared[first + 1 : last].min(initial=lengths[first]))
            own = first + int(np.searchsorted(lengths[first:last] > end, True)) if lengths[first] == end else first
            self.end_node[first:own] = len(nodes)
            nodes.append((first, last, own, int(self.sizes[first:last].min()), int(lengths[first:last].max())))
            pieces.append(in_order[first][depth:end])
            inner.append(level)
            if own < last:
                cuts = own + 1 + np.flatnonzero(shared[own + 1 : last] == end)
                bounds = [own, *cuts.tolist(), last]
                work.extend((x, y, end, level + 1) for x, y in reversed(list(zip(bounds, bounds[1:], strict=False))))
        self.nodes, self.pieces = nodes, pieces
        self.after = np.zeros(len(nodes), np.int64)  # the node after the last one below
        path: list[int] = []
        for k, level in enumerate([*inner, 0]):
            while len(path) > level:
                self.after[path.pop()] = k
            path.append(k)
        self.at = np.cumsum([0, *map(len, pieces)])
        self.flat = np.concatenate(pieces)

    def overlaps(self, node: int, held: np.ndarray) -> np.ndarray:
        """For the sets below a node, how many ranks from that node on are marked in ``held``."""
        last, start = int(self.after[node]), self.at[node]
        found = np.add.reduceat(held[self.flat[start : self.at[last]]], self.at[node:last] - start)
        # Along a path: what the nodes so far have found, less what ended before.
        ended = np.bincount(self.after[node:last] - node, found, last - node + 1)[:-1]
        down = np.cumsum(found - ended).astype(np.int64)
        first, end = self.nodes[node][:2]
        return down[self.end_node[first:end] - node]


def linked(sets: list[np.ndarray], sizes: list[int], known: np.ndarray, walkers: list[int]) -> list[tuple[int, int]]:
    """Links that join the components of the sets; ``sizes`` counts also hashes no other set holds.

    Every walker is held against all sets; pairs already in one component, as the ``known`` sets are, are skipped.
    """
    if len(sets) < 2:
        return []
    num, den = JACCARD.numerator, JACCARD.denominator
    tree = PrefixTree(sets, sizes)
    place = np.argsort(tree.order)
    component = np.arange(len(sets))  # by place
    component[place[known]] = place[known].min(initial=len(sets))
    held = np.zeros(int(max((s[-1] for s in sets if len(s)), default=0)) + 1, np.int32)
    links = []

    def meet(first: int, overlaps: np.ndarray) -> None:
        """Link the walker with the sets from ``first`` on that are near enough and elsewhere."""
        until = first + len(overlaps)
        near = (num + den) * overlaps >= num * (size + tree.sizes[first:until])
        for other in (first + np.flatnonzero(near & (component[first:until] != component[own_place]))).tolist():
            old, new = component[other], component[own_place]
            if old != new:
                component[component == old] = new
                links.append((w, tree.order[other]))

    for w in walkers:
        own, size, own_place = sets[w], sizes[w], int(place[w])
        held[own] = 1
        stack = [(0, 0, 0)]  # node, depth before it, overlap before it
        while stack:
            node, depth, overlap = stack.pop()
            first, last, own_end, least_size, longest = tree.nodes[node]
            if (component[first:last] == component[own_place]).all():
                continue
            # At best the rest of the branch, up to what is left of the walker, is shared too.
            best = overlap + min(len(own) - overlap, longest - depth)
            if (num + den) * best < num * (size + max(least_size, best)):
                continue
            below = int(tree.after[node])
            if node and tree.at[below] - tree.at[node] <= BRANCH:
                meet(first, overlap + tree.overlaps(node, held))
                continue
            piece = tree.pieces[node]
            overlap, depth = overlap + int(held[piece].sum()), depth + len(piece)
            if own_end > first:
                meet(first, np.full(own_end - first, overlap))
            child = node + 1
            while child < below:
                stack.append((child, depth, overlap))
                child = int(tree.after[child])
        held[own] = 0
    return links


def _ranked(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of a group as ranks in one global order: held by most sets first."""
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    out, at = [], 0
    for row in rows:
        out.append(np.sort(rank[inverse[at : at + len(row)]]))
        at += len(row)
    return out


def _family_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links within one family or tile. ``side`` 0: walkers; 1: only walked upon; ``known``: linked before."""
    group = group.sort_values("rep", ignore_index=True)
    ids = group["rep"].tolist()
    sets = _ranked([np.asarray(h, np.int64) for h in group["hashes"]])
    walkers = np.flatnonzero((group["side"] == 0).to_numpy()).tolist()
    links = linked(sets, group["n"].tolist(), np.flatnonzero(group["known"].to_numpy(bool)), walkers)
    return pd.DataFrame({"u": [ids[a] for a, _ in links], "v": [ids[b] for _, b in links]}, dtype="int64")


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with an id in ``ids``: by broadcast up to a checked size, else by shuffle."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("rep"), "left_semi")


def _suspects(first: DataFrame, classes: DataFrame) -> DataFrame:
    """rep of the classes whose first hashes are shared often enough with other texts."""
    tokens = first.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", F.explode("hashes").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    # Distinct hashes, the smaller side, are kept in a hash table of each part; the many are not sorted.
    hits = tokens.join(shared.hint("shuffle_hash"), "token", "left_semi").groupBy("doc_id", "n").agg(F.count("*").alias("c"))
    # A linked text is at least 4/5 as long, so it too takes REGION of that length into account.
    hits = hits.where(_bound("c", REGION * JACCARD) & (F.col("c") >= 1))
    return stored(hits.select("doc_id").join(classes, F.col("doc_id") == F.col("rep"), "left_semi").select(F.col("doc_id").alias("rep")), "join-suspects")


def _candidates(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """rep, n, hashes (held by other classes too, rarest first), lead (how many of them are index entries)."""
    sets = _sets(_chosen(docs, suspects), whole=True).dropDuplicates(["doc_id", "h1", "h2"])
    sets = stored(sets.withColumn("row", F.monotonically_increasing_id()), "join-sets")
    # A hash travels with its set's row number alone: 16 bytes, twice.
    tokens = sets.select("row", F.explode("hashes").alias("token"))
    held = tokens.groupBy("token").agg(F.count("*").cast("int").alias("c")).where("c > 1")
    ordered = tokens.join(held.hint("shuffle_hash"), "token").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("c", "token"))).alias("pairs")  # one document's own hashes
    )
    ordered = ordered.join(sets.select("row", F.col("doc_id").alias("rep"), "n"), "row").where(_bound("size(pairs)", JACCARD))
    lead = F.expr(f"n - ceil(n * {JACCARD.numerator} / {JACCARD.denominator}) + 1 - (n - size(pairs))")
    return stored(
        ordered.select("rep", "n", F.col("pairs.token").alias("hashes"), lead.cast("int").alias("lead")), "join-ordered"
    )


def _families(candidates: DataFrame) -> DataFrame:
    """rep, family: candidates connected by shared index entries."""
    entries = candidates.where("lead > 0").select("rep", F.explode(F.slice("hashes", F.lit(1), F.col("lead"))).alias("token"))
    heads = entries.groupBy("token").agg(F.min("rep").alias("head"), F.count("*").alias("c")).where("c > 1")
    edges = entries.join(heads, "token").where("rep <> head").select(F.col("rep").alias("u"), F.col("head").alias("v"))
    return components(edges).select(F.col("node").alias("rep"), F.col("root").alias("family"))


def _large_links(members: DataFrame) -> DataFrame:
    """Links of families beyond FAMILY sets: against a leader, then the rest against all in tiles."""
    leader = members.where("rep = family").select(
        "family", F.col("rep").alias("leader"), F.col("n").alias("leader_n"), F.col("hashes").alias("leader_hashes")
    )
    common = F.size(F.array_intersect("hashes", "leader_hashes"))
    num, den = JACCARD.numerator, JACCARD.denominator
    near = (num + den) * common >= num * (F.col("n") + F.col("leader_n"))
    least = members.groupBy("family").agg(F.min("n").alias("least_n"))
    judged = members.join(leader, "family").join(least, "family")
    judged = judged.withColumn("known", near | (F.col("rep") == F.col("leader")))
    # A set that shares all it can with the shortest of the family, and yet is too far from it, is alone.
    judged = judged.where(F.col("known") | ((num + den) * F.size("hashes") >= num * (F.col("n") + F.col("least_n"))))
    judged = stored(judged.select("family", "rep", "n", "hashes", "leader", "known"), "join-judged")
    stars = judged.where("known AND rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v"))
    # Blocks by a hash of the id: about TILE sets each.
    amount = F.size("hashes") / TILE_HASHES + F.lit(1 / TILE)
    sizes = judged.groupBy("family").agg(
        F.ceil(F.sum(amount)).alias("blocks"),
        F.ceil(F.sum(F.when(F.col("known"), 0.0).otherwise(amount))).alias("rest_blocks"),
    ).where("rest_blocks > 0")
    tasks = int(sole(sizes.agg(F.sum(F.col("blocks") * F.col("rest_blocks"))))[0] or 1)
    judged = judged.join(sizes, "family")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    own_rest = F.pmod(F.xxhash64("rep"), F.col("rest_blocks"))
    walkers = judged.where(~F.col("known")).select(
        "family", "rep", "n", "hashes", "known", F.lit(0).alias("side"),
        own_rest.alias("rest"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    walked = judged.select(
        "family", "rep", "n", "hashes", "known", F.lit(1).alias("side"), own_rest.alias("own_rest"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("rest"), block.alias("block"),
    )
    walked = walked.where(F.col("known") | (F.col("rest") != F.col("own_rest"))).drop("own_rest")  # else it is a walker there
    tiles = walkers.unionByName(walked).repartition(min(tasks, MOST_TASKS), "family", "rest", "block")
    links = tiles.groupBy("family", "rest", "block").applyInPandas(_family_links, "u long, v long")
    return stars.unionByName(links)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, n, rep of its class) and (links u, v between classes that give their components)."""
    first = stored(_sets(docs, whole=False), "join-first")
    classes = first.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "join-classes")
    rows = first.select("doc_id", "n", "h1", "h2").join(classes, ["n", "h1", "h2"], "left").select("doc_id", "n", "rep")
    candidates = _candidates(docs, _suspects(first, classes.select("rep")))
    members = stored(candidates.join(_families(candidates), "rep").drop("lead"), "join-members")
    sizes = members.groupBy("family").agg(F.count("*").alias("c"), F.sum(F.size("hashes")).alias("all_hashes"))
    fits = (F.col("c") <= FAMILY) & (F.col("all_hashes") <= FAMILY_HASHES)
    # Comparing costs more than its bytes tell, so the number of tasks is fixed and not left to be coalesced by size.
    hashes = sole(sizes.where(fits).agg(F.sum("all_hashes")))[0] or 0
    tasks = min(max(1, math.ceil(hashes / GROUP_HASHES)), MOST_TASKS)
    small = members.join(sizes.where(fits), "family", "left_semi").repartition(tasks, "family")
    small = small.select("family", "rep", "n", "hashes", F.lit(False).alias("known"), F.lit(0).alias("side"))
    found = small.groupBy("family").applyInPandas(_family_links, "u long, v long")
    large = stored(members.join(sizes.where(~fits), "family", "left_semi"), "join-large")
    if not large.isEmpty():
        found = found.unionByName(_large_links(large))
    return rows, stored(found, "join-links")


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows, found = links(docs)
    same_id = rows.where("rep IS NOT NULL AND doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    roots = components(found)
    # Copies hang on their class; a repeated id can sit in two classes, which then are one node.
    twice = same_id.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("c"))
    odd = twice.where("lo <> hi").select("u", F.col("lo").alias("v")).unionByName(twice.where("lo <> hi").select("u", F.col("hi").alias("v")))
    as_rep = same_id.join(rows.where("doc_id = rep").select(F.col("doc_id").alias("u")).distinct(), "u", "left_semi")
    more = stored(odd.unionByName(as_rep), "join-repeated")
    if not more.isEmpty():
        roots = components(found.unionByName(more))
    joined = rows.join(roots, F.col("rep") == F.col("node"), "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("root", "rep", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.cast("long").alias("component_id"))

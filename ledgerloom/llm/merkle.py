"""Merkle manifest of a table, with proofs by pointer jumping.

Every row is a leaf. The leaves of one group (a language), in ascending order, form a tree: ``ARITY`` nodes in a row
become their hash until one is left, the subroot. The subroots, in the order of their groups, form the upper tree
in the same way; what is left is the root.

Each node above the leaves holds a segment: the siblings on its way to an ancestor, at first those of its own run,
and a pointer to that ancestor, at first its parent. A self-join of the nodes (pointer to node) appends the
ancestor's segment and takes over its pointer, which doubles every distance, so the segments of a tree of depth d
reach the root after log2(d) joins; nodes that have arrived leave the joins. The leaves, seven of eight nodes, take
one jump: their run's row meets the parent's finished segment.

A leaf's position comes from range partitions and their totals, and nodes are grouped by position, so a language
with most of the rows is spread like any other. Digests travel as 32 bytes; hashes are taken of hexadecimal text.

Defined results: null groups and null ids come first, and null columns have a mark of their own; rows with equal ids
are ordered by their digest (equal rows in any order, they are alike); a group of one row has its leaf as subroot, and
a table of one group its subroot as root; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.quantiles import global_row_number
from ledgerloom.llm.common import sole, stored

ARITY = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = -1  # number of the upper tree; the groups' trees are numbered from 0
NODE = ("tree", "level", "pos")
SEGMENT = "array<struct<before: binary, after: binary>>"


def digest_of(data: Column) -> Column:
    """SHA-256 of the lowercase hexadecimal text of bytes, as bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(data)).cast("binary"), 256))


def leaf_digest(*columns: Column | str) -> Column:
    """SHA-256 of the columns in order: ``-`` for null, else the length in UTF-8, a colon and the value."""

    def part(column: Column | str) -> Column:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, columns)).cast("binary"), 256))


def _joined(digests: Column) -> Column:
    """The bytes of an array of digests in a row."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _siblings(digests: Column, index: Column) -> Column:
    """What stands before and after the node ``index`` (from 0) of a run."""
    after = F.slice(digests, index + 2, F.greatest(F.size(digests) - index - 1, F.lit(0)))
    return F.struct(_joined(F.slice(digests, F.lit(1), index)).alias("before"), _joined(after).alias("after"))


def _runs(nodes: DataFrame, member: Column) -> DataFrame:
    """Parents of the nodes (tree, pos, n) of one level: tree, pos, n (nodes of the tree on that level), members."""
    members = F.array_sort(F.collect_list(F.struct("pos", member.alias("member"))))
    return nodes.groupBy("tree", F.expr(f"pos div {ARITY}").alias("up")).agg(
        F.expr(f"(max(n) + {ARITY - 1}) div {ARITY}").alias("n"),
        F.transform(members, lambda m: m["member"]).alias("members"),
    ).withColumnRenamed("up", "pos")


def _levels(nodes: DataFrame, most: int, level: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, pos, n, digest; ``most`` in a tree), numbered from ``level + 1``, each written down."""
    found = []
    while most > 1:
        level += 1
        runs = _runs(nodes.where("n > 1"), F.col("digest"))
        runs = runs.withColumns({"level": F.lit(level), "digest": digest_of(_joined(F.col("members")))})
        nodes = stored(runs, "merkle-level")
        found.append(nodes)
        most = -(-most // ARITY)
    return found


def _key(tree: Column, level: Column, pos: Column, n: Column) -> list[Column]:
    """Key of a node; the subroot of a group is known as a leaf of the upper tree."""
    lower = (n == 1) & (tree >= 0)
    return [
        F.when(lower, F.lit(UPPER)).otherwise(tree).cast("long"),
        F.when(lower, F.lit(0)).otherwise(level).cast("int"),
        F.when(lower, tree).otherwise(pos).cast("long"),
    ]


def _segments(levels: Sequence[DataFrame], root: tuple[int, int, int]) -> DataFrame:
    """Every member of a run with its first segment (its siblings there) and the run's node as target (null: the root)."""
    found = None
    for runs in levels:
        node = [F.col("tree").cast("long"), (F.col("level") - 1).cast("int"), F.col("pos") * ARITY + F.col("i")]
        target = _key(F.col("tree"), F.col("level"), F.col("pos"), F.col("n"))
        at_root = (target[0] == root[0]) & (target[1] == root[1]) & (target[2] == root[2])
        part = runs.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("members") - 1))).select(
            *(c.alias(name) for c, name in zip(node, NODE, strict=True)),
            F.array(_siblings(F.col("members"), F.col("i"))).alias("segment"),
            *(F.when(~at_root, c).alias(f"to_{name}") for c, name in zip(target, NODE, strict=True)),
        )
        found = part if found is None else found.unionByName(part)
    return found


def _jump(nodes: DataFrame) -> DataFrame:
    """Doubles the distance of every segment that does not end at the root."""
    targets = [f"to_{name}" for name in NODE]
    ahead = nodes.select(
        *(F.col(name).alias(f"to_{name}") for name in NODE),
        F.col("segment").alias("more"),
        *(F.col(target).alias(f"next_{target}") for target in targets),
    )
    moved = nodes.where("to_tree IS NOT NULL").join(ahead, targets)
    moved = moved.select(
        *NODE, F.concat("segment", "more").alias("segment"), *(F.col(f"next_{target}").alias(target) for target in targets)
    )
    return nodes.where("to_tree IS NULL").unionByName(moved)


def _finished(levels: Sequence[DataFrame], root: tuple[int, int, int]) -> DataFrame | None:
    """tree, level, pos and the segment up to the root of every node above the leaves."""
    if not levels:
        return None
    nodes = stored(_segments(levels, root), "merkle-segments")
    distance = 1
    while distance < len(levels):
        nodes = stored(_jump(nodes), "merkle-segments")
        distance *= 2
    return nodes.select(*NODE, "segment")


def manifest(
    docs: DataFrame,
    group: str = "lang",
    order: str = "doc_id",
    columns: Sequence[str] = COLUMNS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """id (``order``), leaf, subroot, root (digests as bytes) and path of each row of ``docs``; the path holds the
    siblings before and after the node of each level, from the leaf to the root. ``carry`` adds columns."""
    carried = {f"c_{name}": column for name, column in (carry or {}).items()}
    own = [F.col(group).cast("string").alias("grp"), F.col(order).alias("id"), leaf_digest(*columns).alias("leaf")]
    leaves = stored(docs.select(*own, *(c.alias(n) for n, c in carried.items())), "merkle-leaves")
    numbered = stored(global_row_number(leaves, ["grp", "id", "leaf"], "number"), "merkle-order")
    groups = numbered.groupBy("grp").agg(F.count("*").alias("n"), F.min("number").alias("start"))
    groups = stored(global_row_number(groups, ["start"], "tree").withColumn("tree", F.col("tree") - 1), "merkle-groups")
    trees, most = sole(groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))))

    groups = groups.withColumnRenamed("grp", "own_grp")
    nodes = numbered.join(groups, numbered["grp"].eqNullSafe(groups["own_grp"])).withColumn("pos", F.expr("number - start"))
    runs = _runs(nodes, F.struct("id", "leaf", *carried)).withColumn("digests", F.transform("members", lambda m: m["leaf"]))
    # A row that is its group's only one is the subroot itself: a run, but none that is hashed.
    alone = (F.col("n") == 1) & (F.size("members") == 1)
    first = runs.withColumn("digest", F.when(alone, F.col("digests")[0]).otherwise(digest_of(_joined(F.col("digests")))))
    first = stored(first.withColumn("alone", alone), "merkle-leaf-runs")

    lower = _levels(first, -(-most // ARITY), 1)
    subroots = None
    for level in [first, *lower]:
        part = level.where("n = 1").select(F.lit(UPPER).alias("tree"), F.col("tree").alias("pos"), F.lit(trees).alias("n"), "digest")
        subroots = part if subroots is None else subroots.unionByName(part)
    subroots = stored(subroots, "merkle-subroots")
    upper = _levels(subroots, trees, 0)
    top = (upper[-1] if upper else subroots).select("digest").first()
    root_key = (UPPER, len(upper), 0)

    path = _finished([*lower, *upper], root_key)
    key = _key(F.col("tree"), F.lit(1), F.col("pos"), F.col("n"))
    rows = first.withColumns({f"n_{name}": c for c, name in zip(key, NODE, strict=True)})
    if path is None:
        rows = rows.withColumn("segment", F.array().cast(SEGMENT))
    else:
        rows = rows.join(path.toDF(*(f"n_{name}" for name in NODE), "segment"), [f"n_{name}" for name in NODE], "left")
        rows = rows.withColumn("segment", F.coalesce("segment", F.array().cast(SEGMENT)))
    rows = rows.join(subroots.select(F.col("pos").alias("tree"), F.col("digest").alias("subroot")), "tree")
    rows = rows.select("subroot", "segment", "digests", "alone", F.posexplode("members").alias("i", "m"))
    siblings = F.when(F.col("alone"), F.array().cast(SEGMENT)).otherwise(F.array(_siblings(F.col("digests"), F.col("i"))))
    return rows.select(
        F.col("m.id").alias(order),
        F.col("m.leaf").alias("leaf"),
        "subroot",
        F.lit(bytes(top["digest"]) if top else None).cast("binary").alias("root"),
        F.concat(siblings, "segment").alias("path"),
        *(F.col(f"m.c_{name}").alias(name) for name in carry or {}),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda digest, s: digest_of(F.concat(s["before"], digest, s["after"])))


def proof_bytes(path: Column) -> Column:
    """All siblings of a path, level by level and from left to right."""
    return F.unhex(F.array_join(F.transform(path, lambda s: F.concat(F.hex(s["before"]), F.hex(s["after"]))), ""))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))

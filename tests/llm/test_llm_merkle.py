import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle
from ledgerloom.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path string, tree long"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return H("".join(map(part, (row[0], row[1], row[2], row[3], text))))


def tree(nodes):
    """All levels of the tree over ``nodes``, and the way of each: runs and places."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def way(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        lower[g] = tree([leaf_of(r, r[4]) for r in groups[g]])
    upper = tree([lower[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = row[4]
            if tampered and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node, proof = leaf_of(row, text), ""
            for before, after in [*way(lower[g], i), *way(upper, k)]:
                node = H("".join(before) + node + "".join(after))
                proof += "".join(before + after)
            root = upper[-1][0]
            out.append((row[0], lower[g][0][i], lower[g][-1][0], root, H(proof), node, node == root))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "own", "own", 1) for r in rows], SCHEMA)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def documents(n, langs, seed=1):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "", "Ab", "x" * 50, "é Ü", "LONG " * 9000 if draw.random() < 0.1 else "Q"])
    return [(i, draw.choice(["s", None, "ü"]), draw.choice(langs), draw.choice([None, i]), text()) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        documents(1, ["en"]),
        documents(8, ["en"]),
        documents(9, ["en"]),
        documents(65, ["en", "de", None]),
        documents(700, ["en"] * 9 + ["de", None, "Z", "é"]),
        documents(60, [f"l{k}" for k in range(40)] + [None]),
    ],
    ids=["one", "run", "run and one", "three groups", "hot group", "many groups"],
)
def test_proofs_match_brute_force(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == brute(rows)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    rows = documents(20, ["en", None])
    rows += rows[:5] + [(None, "s", "en", 1, "A"), (None, "s", "en", 1, "A"), (None, None, None, None, None), (3, "s", "en", 3, "Other")]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_any_change_is_seen(spark):
    rows = documents(30, ["en", "de"])
    proved = merkle.manifest(spark.createDataFrame([(*r, "", "", 1) for r in rows], SCHEMA))
    other = F.unhex(F.sha2(F.col("leaf"), 256))
    state = proved.select(
        (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("same"),
        (merkle.folded(other, F.col("path")) == F.col("root")).alias("changed"),
    )
    assert {tuple(r) for r in state.collect()} == {(True, False)}


def test_jumps_double_the_distance(spark):
    """Nine levels take four self-joins."""
    levels = []
    for level in range(1, 10):
        members = [bytes([level, k]) * 16 for k in range(2)]
        levels.append(spark.createDataFrame([(0, level, 0, 2 if level < 9 else 1, members, members[0])], "tree long, level int, pos long, n long, members array<binary>, digest binary"))
    nodes = merkle._segments(levels, (merkle.UPPER, 0, 0))
    lengths = []
    for _ in range(4):
        nodes = merkle._jump(nodes)
        lengths.append(nodes.where("pos = 0 AND level = 0").select(F.size("segment")).first()[0])
    assert lengths == [2, 4, 8, 9] and nodes.where("to_tree IS NOT NULL").isEmpty()

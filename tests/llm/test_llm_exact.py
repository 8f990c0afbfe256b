import hashlib
import re
import zlib
from collections import defaultdict

from ledgerloom.llm import exact_dedup, sharding

ROWS = [
    (5, "a  b"),
    (3, "a b"),
    (9, "a\tb"),
    (4, "a b "),
    (7, None),
    (8, ""),
    (10, "x" * 5000),
    (11, "x" * 4999 + "y"),
    (12, "x" * 5000),
    (None, "a b"),
    (20, "same row"),
    (20, "same row"),
    (21, "é ü"),
]


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[normal].append(doc_id)
    out = []
    for normal, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        for doc_id in ids:
            out.append((doc_id, first, len(ids), hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_copies_match_brute_force(make_docs):
    rows = exact_dedup.exact_copies(make_docs(ROWS), digest=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == expected(ROWS)
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})  # one row stays, also of repeated rows
    assert all(r.kept is False or r.doc_id == r.keep_id for r in rows)


def test_kept_rows_have_all_columns(make_docs):
    docs = make_docs(ROWS)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 4, 7, 10, 11, 20, 21], key=repr)


def test_one_hot_group(make_docs):
    docs = make_docs([(i, "hot") for i in range(1000)] + [(i, f"t{i}") for i in range(1000, 2000)])
    rows = exact_dedup.exact_copies(docs).collect()
    assert sum(r.kept for r in rows) == 1001
    assert {r.group_size for r in rows if r.doc_id < 1000} == {1000}


def test_empty_tables(make_docs):
    assert exact_dedup.exact_copies(make_docs([]), digest=True).count() == 0
    assert exact_dedup.keep_first(make_docs([])).count() == 0
    assert sharding.byte_shards(make_docs([])).count() == 0


def test_shards_are_contiguous_and_even(make_docs):
    rows = [(i, "é" * (i % 37)) for i in range(500)] + [(None, "n"), (None, None), (7, "again"), (7, "again")]
    placed = sharding.byte_shards(make_docs(rows), 10).collect()
    assert len(placed) == len(rows)
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in placed if r.doc_id is not None) == want
    by_shard = defaultdict(list)
    for r in placed:
        by_shard[r.shard].append(r)
    total, largest = sum(r["size"] for r in placed), max(r["size"] for r in placed)
    for shard, members in by_shard.items():
        assert 0 <= shard < 10
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - total / 10) <= largest
        in_order = [r.doc_id for r in sorted(members, key=lambda r: r.slot) if r.doc_id is not None]
        assert in_order == sorted(in_order)
    tops = [max((r.doc_id for r in by_shard[s] if r.doc_id is not None)) for s in sorted(by_shard)]
    assert tops == sorted(tops)


def test_more_shards_than_rows(make_docs):
    placed = sharding.byte_shards(make_docs([(1, "a"), (2, "b")]), 40).collect()
    assert len({r.shard for r in placed}) == 2 and all(r.slot == 0 for r in placed)

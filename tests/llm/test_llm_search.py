import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import lexical_search
from ledgerloom.llm.queries import op13_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, number string, rank string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag)
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def words(draw, n, size=400):
    return " ".join(f"w{int(draw.paretovariate(0.7)) % size}" for _ in range(n))


def found(spark, make_docs, docs, items, **args):
    frame = make_docs(docs).withColumnRenamed("kept", "score").withColumnRenamed("n_shingles", "terms")
    rows = lexical_search.ranked(frame, spark.createDataFrame([(*i, "own", "own") for i in items], ITEMS), **args)
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_ranking_matches_brute_force(spark, make_docs):
    draw = random.Random(3)
    docs = [(i, words(draw, draw.randrange(60))) for i in range(700)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (7, docs[7][1]), (None, None), (5000, ""), (5001, " .,! ")]
    docs += [(6000, "Ä-É é_ w3-W3 _w5 日本 w3"), (6001, words(draw, 30_000))]
    items = [(i, words(draw, draw.randrange(1, 40))) for i in range(50)]
    items += [(100, docs[7][1]), (100, "w1 w1 w1"), (101, None), (102, ""), (103, "unknown"), (None, "É日本 w3 é"), (104, words(draw, 3000))]
    assert found(spark, make_docs, docs, items, seed=4) == brute(docs, items)
    assert found(spark, make_docs, docs, items, seed=1000, k=3) == brute(docs, items, 3)


def test_slices_give_the_same(spark, make_docs, monkeypatch):
    draw = random.Random(5)
    docs = [(i, words(draw, 20)) for i in range(100)]
    items = [(i, words(draw, 10)) for i in range(25)]
    want = brute(docs, items)
    for name, value in (("SLICE_ITEMS", 10), ("SLICE_BYTES", 200), ("TEXT_BYTES", 16), ("WORDS", 5), ("EXACT", 1)):
        with monkeypatch.context() as patch:
            patch.setattr(lexical_search, name, value)
            assert found(spark, make_docs, docs, items) == want, name


def test_empty_tables(spark, make_docs):
    item = [(1, "a b")]
    for docs, items in (([], item), ([(1, "a")], []), ([(1, None), (2, "")], item), ([], [])):
        assert found(spark, make_docs, docs, items) == []


def test_ties_keep_the_smaller_ids(spark, make_docs):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(100 + i, f"other text {i}") for i in range(60)]
    rows = found(spark, make_docs, docs, [(1, "same words")])
    assert [r[2] for r in sorted(rows, key=lambda r: r[1])] == list(range(1, 11)) and rows == brute(docs, [(1, "same words")])


@pytest.mark.parametrize("seeded", [False, True])
def test_batches_are_pruned_without_loss(seeded):
    """Documents about different things: most pairs of leaves are never scored."""
    draw = random.Random(9)
    topics = [[f"t{t}x{i}" for i in range(30)] for t in range(40)]
    docs = [(i, " ".join(draw.choices(topics[i % 40], k=20) + ["the", "of"])) for i in range(4000)]
    items = [(i, " ".join(draw.choices(topics[i], k=12) + ["the"])) for i in range(40)]
    known: dict[bytes, int] = {}
    bags = [(i, {known.setdefault(w.encode(), len(known)): n for w, n in Counter(t.split()).items()}) for i, t in items]
    vectors = [Counter(known[w.encode()] for w in t.split() if w.encode() in known) for _, t in docs]
    df = Counter(t for v in vectors for t in v)
    n_terms = sum(len(t.split()) for _, t in docs)
    weights = np.array([math.floor(1000 * math.log((2 * 4000 + 2) / (2 * df[t] + 1))) for t in range(len(known))])
    want = brute(docs, items)
    seeds = {i: min(r[3] for r in want if r[0] == i) for i in range(40)} if seeded else {}
    machine = lexical_search.Items(bags, weights, seeds, 10)
    machine.start()
    for low in range(0, 4000, 1000):
        part = vectors[low : low + 1000]
        rows = np.array([d for d, v in enumerate(part) for _ in v])
        columns = np.array([t for v in part for t in v])
        counts = np.array([n for v in part for n in v.values()])
        m = 25 + 75 * 22 * 4000 // n_terms
        machine.search(np.arange(low, low + 1000), rows, columns, 1_000_000_000 * counts // (1000 * counts + 8 * m), weights)
    got = []
    for n, best in zip(machine.numbers, machine.found):
        got += [(n, r, -d, s) for r, (s, d) in enumerate(sorted(best, reverse=True), 1)]
    assert sorted(got, key=repr) == want
    assert machine.pairs < 0.3 * (4000 / lexical_search.DOC_LEAF) * (40 / lexical_search.ITEM_LEAF)


def test_query_on_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted((tuple(r) for r in op13_lexical_search(spark, sf_dir).collect()), key=repr) == brute(docs, items)

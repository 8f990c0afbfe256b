import random
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import components as cc
from ledgerloom.llm import ngram_join
from ledgerloom.llm.queries import op1_ngram_join


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for i, own in sets.items():
        for j, common in Counter(j for s in own for j in holders.get(s, ())).items():
            if 100 * common >= 80 * (len(own) + len(sets[j]) - common):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for s in own:
            holders.setdefault(s, []).append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, bases=25, copies=12, hot=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    rows = []

    def changed(words, share):
        return [draw.choice(vocabulary) if draw.random() < share else w for w in words]

    for b in range(bases):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 5, 8, 40, 150]))]
        if b % 3 == 0:
            base += passage  # shared by unrelated documents
        for _ in range(draw.randrange(copies)):
            rows.append(" ".join(changed(base, draw.choice([0, 0.005, 0.02, 0.03, 0.05]))))
    base = [draw.choice(vocabulary) for _ in range(200)]
    rows += [" ".join(changed(base, draw.choice([0.0, 0.01, 0.02]))) for _ in range(hot)]
    rows += [None, "", " \t", "One two", "one TWO", "É a", "é a"]
    draw.shuffle(rows)
    return list(enumerate(rows, 100))


def found(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(make_docs, seed):
    rows = corpus(seed)
    assert found(make_docs(rows)) == brute(rows)


def test_large_families_give_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "FAMILY", 4)
    monkeypatch.setattr(ngram_join, "TILE", 3)
    rows = corpus(3)
    assert found(make_docs(rows)) == brute(rows)


def test_ids_that_repeat_or_lack(make_docs):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (3, b), (9, a), (None, a), (7, a), (7, a)]
    out = ngram_join.similar_documents(make_docs(rows)).collect()
    assert len(out) == len(rows)
    assert {r.component_id for r in out if r.doc_id is not None} == {3}  # id 5 holds both texts together
    assert [r.component_id for r in out if r.doc_id is None] == [None]


def test_empty_table(make_docs):
    assert ngram_join.similar_documents(make_docs([])).count() == 0
    assert ngram_join.similar_documents(make_docs([(1, None)])).collect()[0].component_id == 1


def test_components_of_chains_and_stars(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1), (300, 301), (301, 300)]
    edges = [e if draw.random() < 0.5 else e[::-1] for e in edges]
    rows = cc.components(spark.createDataFrame(edges, "u long, v long")).collect()
    got = {r.node: r.root for r in rows}
    assert len(rows) == len(got)
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {300: 300, 301: 300}
    assert got == want


def test_query_on_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_ngram_join(spark, sf_dir).collect()}
    assert got == brute(docs)


def test_tree_gives_the_components_of_all_pairs(monkeypatch):
    draw = random.Random(8)
    base = list(range(120))
    sets = [sorted({draw.randrange(300) if draw.random() < draw.choice([0, 0.03, 0.1]) else x for x in base}) for _ in range(60)]
    sets += [[1, 2, 3], [1, 2, 3], [1, 2, 3, 4], list(range(130, 160))]
    sizes = [len(s) + draw.randrange(6) for s in sets]

    def groups(links):
        up = list(range(len(sets)))

        def find(x):
            return x if up[x] == x else find(up[x])

        for a, b in links:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(sets))]

    def near(a, b):
        common = len({*sets[a]} & {*sets[b]})
        return 9 * common >= 4 * (sizes[a] + sizes[b])

    want = groups([(a, b) for a in range(len(sets)) for b in range(a) if near(a, b)])
    for branch in (0, 50, 10**6):
        monkeypatch.setattr(ngram_join, "BRANCH", branch)
        arrays = [np.array(s) for s in sets]
        links = ngram_join.linked(arrays, sizes, np.array([], int), [*range(len(sets))])
        assert groups(links) == want and len(links) == len(sets) - len(set(want))
        known = np.flatnonzero(np.array(want) == want[0])  # not linked again
        links = ngram_join.linked(arrays, sizes, known, [*range(len(sets))])
        assert len(links) == len(sets) - len(set(want)) - len(known) + 1


def test_tiles_of_a_large_family_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 10)
    draw = random.Random(4)
    # All hold half of the leader's hashes, so all but one meet all in tiles.
    rows = [(0, 0, 60, [*range(60)])] + [(0, i, 60, [*range(30), *draw.sample(range(100, 400), 30)]) for i in range(1, 80)]

    def task_of(group):
        import pandas as pd
        from pyspark import TaskContext

        return pd.DataFrame({"u": [0], "v": [TaskContext.get().partitionId()]})

    monkeypatch.setattr(ngram_join, "_family_links", task_of)
    members = spark.createDataFrame(rows, "family long, rep long, n long, hashes array<long>")
    assert len({r.v for r in ngram_join._large_links(members).where("u = 0").collect()}) > 10


def test_hashes_are_not_sorted_to_be_looked_up(spark, make_docs, monkeypatch):
    plans = {}

    def noted(df, label, write=ngram_join.stored):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label)

    monkeypatch.setattr(ngram_join, "stored", noted)
    rows = corpus(6, bases=4, copies=4, hot=5)
    assert found(make_docs(rows)) == brute(rows)
    for label in ("join-suspects", "join-ordered"):
        assert "ShuffledHashJoin [token" in plans[label]

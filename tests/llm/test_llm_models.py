import random
import string

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import decontamination, quality, toxicity
from ledgerloom.llm.queries import op3_toxicity, op4_quality, op5_decontamination


def bare(text):
    return [w.strip(string.punctuation) or w for w in (text or "").lower().split()]


def auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"  # some 3,000 labels to learn from
    scored = op3_toxicity(spark, folder)
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert auc([(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]) > 0.93


def test_pairs_count_together(make_docs, spark):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(1200):
        words = [f"w{draw.randrange(40)}" for _ in range(10)]
        a, b = draw.random() < 0.5, draw.random() < 0.5
        words += ["insult"] * a + ["group"] * b
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a and b)))
    docs, labelled = make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.train(docs, labelled)
    probe = make_docs([(1, "insult"), (2, "group"), (3, "insult group"), (4, None), (5, ""), (5, "")])
    score = {r.doc_id: r.score for r in toxicity.score(probe, machine).collect()}
    assert score[3] > 0.5 > max(score[1], score[2], score[4])
    assert score[4] == score[5]


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, None)], [(1, 0), (1, 0)]])
def test_models_without_both_classes(make_docs, spark, labels):
    docs = make_docs([(1, "a b"), (2, None), (None, "x")])
    toxic = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, toxic)).count() == 3
    good = toxic.withColumnRenamed("toxic", "quality")
    scorer = quality.train(docs, good)
    assert quality.score(docs, scorer).count() == 3
    assert quality.keep_good(make_docs([]), scorer).count() == 0


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    scorer = quality.train(docs, labels.where(~held))
    rows = quality.score(docs, scorer).join(labels.where(held), "doc_id").collect()
    for column in ("score", "text_score", "page_score"):
        assert auc([(r[column], r.quality) for r in rows]) > 0.85
    good = [r for r in rows if r.quality]
    assert sum(r.score >= quality.REJECT_BELOW for r in good) >= 0.97 * len(good)
    kept = quality.keep_good(docs, scorer)
    assert kept.schema == docs.schema and 0 < kept.count() < docs.count()
    assert op4_quality(spark, "/root/testdata/sf0.001").count() == 200


def windows(text, item):
    words, size = bare(text), len(bare(item))
    return [(k, words[k : k + size]) for k in range(len(words) - size + 1)] if size else []


def grams(words):
    return [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))]


def brute_leaks(docs, items):
    from collections import Counter

    bags = {i: Counter(grams(bare(t))) for i, t in items if bare(t)}
    held = Counter(g for b in bags.values() for g in b)
    weight = lambda g: 1.0 / held[g] if g in held else 1.0
    out = {}
    near = {i: set(b) for i, b in bags.items()}
    for d, text in docs:
        held_here = {tuple(w[k : k + n]) for w in [bare(text)] for n in range(1, 6) for k in range(len(w) - n + 1)}
        for i, item in items:
            if i not in near or not near[i] & held_here and len(bare(text)) >= 5:
                continue  # no shingle in common, in any window
            for start, words in windows(text, item):
                own = Counter(grams(words))
                both = sum(min(n, bags[i][g]) * weight(g) for g, n in own.items())
                total = sum(n * weight(g) for b in (own, bags[i]) for g, n in b.items())
                found = both / (total - both)
                if found >= 0.8 - 1e-12 and found > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (found, start)
    return out


def test_leaks_match_brute_force(make_docs, spark):
    draw = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(draw.choice([3, 5, 9, 20, 45])))) for i in range(30)] + [(90, None), (91, ""), (92, "One, two")]
    rows = []
    for i in range(60):
        words = text(80)
        if i % 2:
            passage = items[draw.randrange(30)][1].split()
            if i % 4 == 1 and len(passage) > 15:
                passage[draw.randrange(len(passage))] = "changed"
            at = draw.randrange(80)
            words[at:at] = [w.upper() + draw.choice(["", ",", "."]) for w in passage]
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "say one two. now"), (103, items[4][1] * 1), (103, items[4][1] * 1)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contaminated(make_docs(rows), benchmark).collect()
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in out}
    want = {k: (round(s, 9), at) for k, (s, at) in brute_leaks(rows, items).items()}
    assert got == want


def test_every_fingerprint_within_the_radius_is_found():
    draw = random.Random(6)
    items = decontamination.Items(tuple((i, " ".join(f"x{draw.randrange(500)}" for _ in range(20))) for i in range(40)))
    for i, fingerprint in enumerate(items.prints):
        for bits in range(decontamination.RADIUS + 1):
            flipped = fingerprint
            for b in draw.sample(range(64), bits):
                flipped ^= 1 << b
            assert i in items.within(flipped)


def test_leaks_in_slices_and_empty_tables(make_docs, spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_ITEMS", 2)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(7)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"before {t} after") for i, t in items]
    assert decontamination.contaminated(make_docs(rows), benchmark).count() == 7
    assert decontamination.contaminated(make_docs([]), benchmark).count() == 0
    assert decontamination.contaminated(make_docs(rows), benchmark.limit(0)).count() == 0


def shared_passages(draw, per_holders, changes):
    """Items that share passages, among 1, 2, 5 or 10 of them, and texts with items of which words are changed."""
    vocabulary = [f"v{i}" for i in range(5000)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items, rows = [], []
    for holders in (1, 2, 5, 10):
        for _ in range(per_holders):
            passage = text(40 * holders)  # one changed word leaves a weighted similarity of about 0.8
            own = len(items)
            items += [(own + k, " ".join(passage + text(2))) for k in range(holders)]
            for _ in range(3):
                words = items[own][1].split()
                for at in draw.sample(range(5, len(words) - 5), draw.choice(changes)):
                    words[at] = "changed"
                rows.append((len(rows), " ".join(text(20) + words + text(20))))
    return items, rows


def test_recall_by_similarity():
    """Against the exact search: of the pairs found every one is right; at least 0.9 are found in every band."""
    items, rows = shared_passages(random.Random(18), 9, [0, 1, 1, 1, 2, 2])
    searcher = decontamination.Items(tuple(items))
    got = {(d, i): s for d, t in rows for i, (s, _) in searcher.matches(t).items()}
    want = {k: s for k, (s, _) in brute_leaks(rows, items).items()}
    assert set(got) <= set(want) and all(s <= want[k] + 1e-9 for k, s in got.items())
    for low, high, floor in ((0.8, 0.85, 0.9), (0.85, 0.9, 0.97), (0.9, 1.01, 1.0)):
        band = [k for k, s in want.items() if low <= s < high]
        assert len(band) >= 15
        assert sum(k in got for k in band) >= floor * len(band), (low, high)


def test_slicing_does_not_matter(make_docs, spark, monkeypatch):
    items, rows = shared_passages(random.Random(8), 4, [1, 1, 2])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    results = []
    for slice_items in (20_000, 24):  # one slice and six
        monkeypatch.setattr(decontamination, "SLICE_ITEMS", slice_items)
        out = decontamination.contaminated(make_docs(rows), benchmark).collect()
        results.append({(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in out})
    want = {k: (round(s, 9), at) for k, (s, at) in brute_leaks(rows, items).items()}
    assert results[0] == results[1]
    assert len(set(results[0]) & set(want)) >= 0.9 * len(want) > 50


def test_a_text_shorter_than_an_item_is_one_window(make_docs, spark):
    words = [f"w{k}" for k in range(59)]
    benchmark = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    rows = [(1, " ".join(words[:58])), (2, " ".join(words[10:58])), (3, " ".join(words[:20])), (4, " ".join(words[:4]))]
    out = decontamination.contaminated(make_docs(rows), benchmark).collect()
    got = {r.doc_id: (round(r.similarity, 9), r.start_word, r.n_words) for r in out}
    assert got == {1: (round(54 / 55, 9), 0, 58), 2: (0.8, 0, 48)}


def test_query_finds_the_planted_passages(spark, sf_dir):
    docs, items = (
        [(r[0], " ".join(bare(r.text))) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").collect()]
        for t in ("documents", "benchmark")
    )
    exact = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id) for r in op5_decontamination(spark, sf_dir).collect()}
    assert exact <= got


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("kept", F.lit("own"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == columns, name
        assert 0 < after.count() <= docs.count()
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: r.decoded for r in last} == {r.doc_id: r.text for r in docs.collect()}


def test_stages_decide_by_row(spark, make_docs, sf_dir):
    item = max((r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()), key=len)
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    leaks = make_docs([(None, item), (None, a), (None, b), (3, item), (3, c), (4, a)])
    kept = corpus_pipeline.without_benchmark(spark, leaks, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, a), (0, b), (3, c), (4, a)])
    near = a.replace("a30", "other")
    rows = make_docs([(2, a), (5, near), (5, b), (6, c), (6, c + " more"), (None, a)])
    kept = corpus_pipeline.one_of_similar(spark, rows, sf_dir).collect()
    got = sorted((r.doc_id or 0, r.text) for r in kept)
    assert got[:3] == [(0, a), (2, a), (5, b)] and [i for i, _ in got[3:]] == [6]


def test_pipeline_run(spark, sf_dir):
    import re

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.decoded) for r in rows]
    assert 0 < len(rows) == len(set(texts)) and len({r.doc_id for r in rows}) == len(rows)


def test_stages_on_empty_tables(spark, make_docs, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), sf_dir).count() == 0

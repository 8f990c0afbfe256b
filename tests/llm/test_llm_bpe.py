import random

import public_tokenizers
from tokenizers import Tokenizer

from ledgerloom.llm import bpe
from ledgerloom.llm.queries import op9_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n a  b\n", "aaaaaaaaaaaaa" * 50, "<|endoftext|>hi<|endoftext|>", " " * 100 + "x",
    "日本語 テスト　x", "\r\n\t \x0b", "it's I'll we'VE", "é ½ ² ٣", "x" * 20000, "the the the",
]


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [(e.ids, tokenizer.decode(e.ids, skip_special_tokens=False)) for e in found]


def test_ids_and_texts_equal_the_library(make_docs):
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choice("ab \n'ſé1<|>​😀") for _ in range(draw.randrange(60))) for _ in range(400)]
    docs = make_docs(list(enumerate(texts)))
    rows = {r.doc_id: (r.ids, r.decoded) for r in bpe.round_trip(docs, PATH).collect()}
    assert [rows[i] for i in range(len(texts))] == library(texts)
    again = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {r.doc_id: r.decoded for r in again.collect()} == {i: d for i, (_, d) in rows.items()}


def test_cache_may_overflow(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    texts = [f"word{i} other{i}" for i in range(50)]
    codec = bpe.Codec(PATH)
    assert [codec.encode([t])[0] for t in texts] == [ids for ids, _ in library(texts)]
    assert codec.encode(texts) == [ids for ids, _ in library(texts)]


def test_repeated_rows_and_empty_table(make_docs):
    rows = bpe.round_trip(make_docs([(1, "a b"), (1, "a b"), (None, "a b")]), PATH).collect()
    assert len(rows) == 3 and len({tuple(r.ids) for r in rows}) == 1
    assert bpe.round_trip(make_docs([]), PATH).count() == 0


def test_query_on_the_table(spark, sf_dir):
    import hashlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(docs, library(list(docs.values())), strict=True))
    for r in op9_bpe(spark, sf_dir).collect():
        ids, text = want[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_characters_newer_than_the_library_are_other_signs():
    from ledgerloom.llm.char_classes import newer_characters

    newer = newer_characters()
    assert len(newer) > 1000
    texts = [f"a{c}1 {c}b{c}{c} {c}" for c in newer[::37]] + [newer[:200], f"'{newer[5]}s it's"]
    codec = bpe.codec(PATH)
    assert codec.encode(texts) == [ids for ids, _ in library(texts)]


def test_digests_are_those_of_ids_and_text(make_docs):
    import hashlib

    texts = [t or "" for t in ODD]
    rows = {r.doc_id: tuple(r)[1:] for r in bpe.digests(make_docs(list(enumerate(ODD))), PATH).collect()}
    for i, (ids, text) in enumerate(library(texts)):
        want = (hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), text))
        assert rows[i] == (len(ids), *want), texts[i]


def test_array_and_list_steps_agree(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choice("aaabn ths\n") for _ in range(80)) for _ in range(300)]
    for dense in (0, 50, 60_000):
        monkeypatch.setattr(bpe, "DENSE", dense)
        assert bpe.Codec(PATH).encode(texts) == [ids for ids, _ in library(texts)], dense

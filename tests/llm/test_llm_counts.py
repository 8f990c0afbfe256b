import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from ledgerloom.llm import token_counts
from ledgerloom.llm.char_classes import LETTER, NUMBER, OTHER, QUOTE, class_of, newer_characters
from ledgerloom.llm.queries import op12_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n\n a  b\n", "a" * 650, "<|endoftext|>hi<|endoftext|>", "<|endoftext|>" * 3, " " * 100 + "x", "日本語 テスト　x",
    "\r\n\t \x0b", "it's I'll we'VE 're'l 'r e!'s ''s ' s 'v 'l", "é ½ ² ٣", "x" * 5000, "ab " * 3000, "'", "'r",
]
LETTERS = "ab \n\t'ſé1<|>​😀rlvestmd!"


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def drawn(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(60))) for _ in range(n)]


def test_counts_equal_the_library():
    texts = ODD + drawn(5000)
    machine = token_counts.transducer(PATH)
    assert [machine.count(t) for t in texts] == library(texts)


@pytest.mark.parametrize("size", [1, 3, 7, 50, 700])
def test_chunk_maps_compose_to_the_whole(size):
    machine = token_counts.transducer(PATH)
    for text in ODD + drawn(400, size):
        data = text.encode()
        cuts = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
        maps = [machine.chunk_map(c, i == 0, i == len(cuts) - 1) for i, c in enumerate(cuts)]
        if len(maps) <= 200:
            head, count, tail = machine.scan(maps)[-1]
            assert (head, count, tail) == (b"", machine.count(text), b"")
        # Any bracketing gives the same map.
        if len(maps) > 2:
            a, b, c = maps[:3]
            assert machine.compose(machine.compose(a, b), c) == machine.compose(a, machine.compose(b, c))


def test_machine_may_start_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 50)
    machine = token_counts.Transducer(PATH)
    texts = drawn(300)
    assert [machine.count(t) for t in texts] == library(texts)
    assert len(machine.states) <= 50 + 300


def test_classes_of_all_characters():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) not in " '"]
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for low in range(0, len(chars), 8192):
        part = chars[low : low + 8192]
        starts = {span[0] for _, span in split("".join(f"\na{c}1" for c in part))}
        for k, c in enumerate(part):
            want = LETTER if 4 * k + 2 not in starts else NUMBER if 4 * k + 3 not in starts else OTHER
            got = class_of(c)
            assert got == want or want == OTHER and got not in (LETTER, NUMBER, QUOTE), hex(ord(c))
    assert all(class_of(c) == OTHER for c in newer_characters())


def test_rows_tables_and_long_texts(spark, make_docs):
    texts = [None, "", "a b", "a b", "word " * 40_000, "x" * 3000]
    docs = make_docs(list(enumerate(texts)) + [(None, "a b"), (2, "a b")])
    docs = docs.withColumn("row", docs.source).withColumn("chunk", docs.source).withColumn("n_tokens", docs.source)
    want = sorted(zip([*range(6), 2], library([t or "" for t in [*texts, "a b"]])))
    for chunk in (None, 100, 7):
        rows = token_counts.count_tokens(docs.where("n_chars is null or n_chars < 4000 or " + str(chunk is None)), PATH, limit=2, chunk=chunk).collect()
        got = sorted((r.doc_id, r.n_tokens) for r in rows if r.doc_id is not None)
        assert got == [w for w in want if chunk is None or w[0] != 4]
        assert all(r.over_limit == (r.n_tokens > 2) for r in rows)
        assert [r.n_tokens for r in rows if r.doc_id is None] == [2]
    assert token_counts.count_tokens(make_docs([]), PATH).count() == 0


def test_query_on_the_table(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == dict(zip(docs, library(list(docs.values())), strict=True))
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)

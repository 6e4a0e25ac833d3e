"""Encoding, blocks and counts against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lamina.llm import bpe, counts, simple8b

from .conftest import ODD, large

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["<|", "|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "a<|STARTOFTEXT|>b", "<|startoftext|>", " ", "  ", "\n", "a", "The", "ing", "'s", "'RE", "é", "é", "　", "\x85", "1", "23", "!", "<|endoftext|>", "\t", "ß", "İ", "Σ", "漢", "🙂", "\x1c", "\xa0", "don't", ".", ",", "\x0b", "ﬁ", " word", " and"]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


def mixed(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)] + ["".join(r.choice("abcdefgthein") for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_byte_bpe_is_exact(byte_library):
    texts = ODD + mixed(3000, 1)
    encoder = bpe.BatchEncoder(bpe.vocabulary(BYTE))
    ids, at = encoder.encode(large(texts))
    for i, e in enumerate(byte_library.encode_batch(texts, add_special_tokens=False)):
        own = ids[at[i] : at[i + 1]]
        assert own.tolist() == e.ids, texts[i]
        assert encoder.bpe.decode(own) == byte_library.decode(e.ids, skip_special_tokens=False)
        assert encoder.bpe.encode(texts[i]) == e.ids


def test_byte_bpe_of_invalid_sequences(byte_library):
    vocabulary, r = bpe.vocabulary(BYTE), random.Random(3)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(6)]
        assert vocabulary.decode(np.array(ids)) == byte_library.decode(ids, skip_special_tokens=False)


def test_byte_bpe_query(spark, make, byte_library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(7, None), (7, "again"), (7, "again"), (None, "no id")]
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_documents(make(rows), BYTE).collect())
    want = []
    for i, t in rows:
        ids = byte_library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(byte_library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_documents(make([]), BYTE).count() == 0
    both = bpe.decode_ids(bpe.encode_ids(make([(1, "Some text."), (2, None)]), BYTE), BYTE)
    assert sorted((r.doc_id, r.text) for r in both.collect()) == [(1, "Some text."), (2, "")]


def test_word_bpe_is_exact(word_library):
    texts = ODD + mixed(3000, 2)
    ids, at = simple8b.WordEncoder(WORD).encode(large(texts))
    for i, e in enumerate(word_library.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == e.ids, texts[i]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**60), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    words, escapes = simple8b.pack(np.array(values, dtype=np.uint64))
    assert simple8b.unpack(words, escapes, len(values)).tolist() == values
    assert len(words) <= max(len(values), 0)


def test_simple8b_packs():
    assert len(simple8b.pack(np.ones(600, np.uint64))[0]) == 10
    assert len(simple8b.pack(np.full(300, 40_000, np.uint64))[0]) == 100
    words, escapes = simple8b.pack(np.array([2**60, 5, 2**64 - 1], np.uint64))
    assert escapes.tolist() == [2**60, 2**64 - 1]
    names, at, ids = simple8b.read_block(simple8b.write_block([5, None], [np.array([1, 2], np.uint64), np.array([], np.uint64)]))
    assert (names, at.tolist(), ids.tolist()) == ([5, None], [0, 2, 2], [1, 2])
    with pytest.raises(ValueError):
        simple8b.read_block(b"XXXX" + b"\0" * 40)


@pytest.mark.parametrize("shard", [3, 4096])
def test_token_files(spark, make, word_library, shard):
    rows = [(i * 3 % 23, t) for i, t in enumerate(ODD)] + [(100, None), (100, "tie b"), (100, "tie a"), (None, "no id"), (5000, "last")]
    written, starts = simple8b.write_token_blocks(make(rows), WORD, shard_documents=shard, block_ids=1000)
    got = simple8b.read_token_blocks(written, starts).collect()
    want = {}
    for i, t in rows:
        ids = [*word_library.encode(t or "", add_special_tokens=False).ids, 1]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is not None for r in ordered] == sorted(r.doc_id is not None for r in ordered)
    names = [r.doc_id for r in ordered if r.doc_id is not None]
    assert names == sorted(names)
    total = 0
    for r in ordered:
        assert r.start == total
        total += r.n_tokens


def test_an_id_of_many_rows_fills_several_shards(spark, make):
    r = random.Random(8)
    rows = [(i, f"text {i}") for i in range(400)] + [(200, "the same copy")] * 200 + [(None, f"null {i}") for i in range(150)]
    r.shuffle(rows)
    written, starts = simple8b.write_token_blocks(make(rows), WORD, shard_documents=25)
    got = sorted(simple8b.read_token_blocks(written, starts).collect(), key=lambda x: x.start)
    assert len(got) == len(rows)
    assert [x.doc_id for x in got[:150]] == [None] * 150
    names = [x.doc_id for x in got[150:]]
    assert names == sorted(names)
    assert len({x.shard for x in got if x.doc_id == 200}) >= 4 and max(sum(x.shard == s for x in got) for s in {x.shard for x in got}) < 80
    total = 0
    for x in got:
        assert x.start == total
        total += x.n_tokens


def test_no_documents(spark, make):
    assert simple8b.token_files(make([]), WORD).count() == 0


def test_tree_follows_edits(byte_library):
    encoder, r = bpe.BatchEncoder(bpe.vocabulary(BYTE)), random.Random(5)
    for _ in range(400):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 60)))
        tree = counts.Tree(text, lambda ts: [encoder.count(t) for t in ts], leaf=r.choice([4, 8, 16]))
        for _ in range(4):
            at, removed, new = r.randint(-2, len(text) + 2), r.randint(0, 12), "".join(r.choice(PARTS) for _ in range(r.randint(0, 6)))
            tree.edit(at, removed, new)
            at = min(max(at, 0), len(text))
            text = text[:at] + new + text[min(at + removed, len(text)) :]
            assert tree.text == text
            assert tree.total == len(byte_library.encode(text, add_special_tokens=False).ids), text


def test_edit_touches_few_leaves():
    encoder = bpe.BatchEncoder(bpe.vocabulary(BYTE))
    tree = counts.Tree("some words of text " * 5000, lambda ts: [encoder.count(t) for t in ts])
    tree.edit(40_000, 5, "other")
    assert tree.encoded <= 4 < len(tree.texts)


def test_edited_counts(spark, make, byte_library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (99, "same id"), (None, "no id")]
    trees = counts.plant(make(rows), BYTE)
    got = sorted((str(r.doc_id), r.n_tokens, r.edited_tokens, r.edited_chars) for r in counts.edited_counts(counts.standard_edits(trees), BYTE).collect())
    want = []
    for i, t in rows:
        t = t or ""
        n = len(byte_library.encode(t, add_special_tokens=False).ids)
        new = t[: len(t) // 2] + " edited" + t[len(t) // 2 :]
        new = new[5:] + "\nThis line was added."
        want.append((str(i), n, len(byte_library.encode(new, add_special_tokens=False).ids), len(new)))
    assert got == sorted(want)
    none = trees.selectExpr("*", "cast(null as array<struct<start:int,removed:int,inserted:string>>) edits")
    assert sorted((str(r.doc_id), r.n_tokens, r.edited_tokens, r.encoded_leaves) for r in counts.edited_counts(none, BYTE).collect()) == sorted((i, n, n, 0) for i, n, _, _ in want)
    empty = counts.plant(make([]), BYTE)
    assert counts.edited_counts(counts.standard_edits(empty), BYTE).count() == 0


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_kept_trees_follow_a_table_of_edits(spark, make, byte_library, most):
    r = random.Random(7)
    texts = {i: " ".join(r.choice(["some", "words", "of", "a", "text", "\n", "don't", "漢字"]) for _ in range(r.randint(0, 900))) for i in range(30)}
    trees = counts.plant(make(list(texts.items())), BYTE)
    for _ in range(3):
        edits = [(r.randrange(0, 40), n, r.randrange(0, 3000), r.randrange(0, 30), r.choice(["", " new", "x", None])) for n in range(40)] + [(None, 0, 0, 5, "lost")]
        table = spark.createDataFrame(edits, "doc_id long, number int, start int, removed int, inserted string")
        edited_ids = {e[0] for e in edits}
        for i, _, start, removed, inserted in sorted((e for e in edits if e[0] is not None), key=lambda e: e[1]):
            if i in texts:
                at = min(start, len(texts[i]))
                texts[i] = texts[i][:at] + (inserted or "") + texts[i][at + removed :]
        rows = counts.edited(counts.with_edits(trees, table, most), BYTE).collect()
        for x in rows:
            assert x.text == texts[x.doc_id] and x.edited_chars == len(x.text) == sum(x.leaf_chars)
            assert x.edited_tokens == len(byte_library.encode(x.text, add_special_tokens=False).ids) == sum(x.leaf_tokens)
            assert x.doc_id in edited_ids or x.encoded_leaves == 0
        assert {x.doc_id for x in rows} == set(texts)
        trees = spark.createDataFrame([(x.doc_id, x.text, x.leaf_chars, x.leaf_tokens) for x in rows], counts.KEPT)

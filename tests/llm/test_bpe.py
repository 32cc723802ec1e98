import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from devtide.llm import bpe

from . import corpus

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODEC = bpe.Codec(bpe.public_vocabulary())
PARTS = st.one_of(
    st.text(max_size=12),
    st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "'ll", " ", "\x1c", "\x85", " the", "1", "!"]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_equals_the_library(value):
    ids = CODEC.encode(value)
    assert ids == LIBRARY.encode(value, add_special_tokens=False).ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_letter_is_cut_as_the_library_does():
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for first in range(0, 0x110000, 64):
        signs = [chr(c) for c in range(first, first + 64) if not 0xD800 <= c < 0xE000]
        value = "".join(f"a{c}1{c}!{c}'ll{c}" for c in signs)
        sizes = [b - a for _, (a, b) in library.pre_tokenize_str(value)]
        assert [len(p) for p in bpe.cut(value)] == sizes


@pytest.mark.parametrize("value", ["ab" * 60_000, "a" * 50_000, " " * 5000 + "x", "x " * 5000])
def test_very_long_pieces(value):
    assert CODEC.encode(value) == LIBRARY.encode(value, add_special_tokens=False).ids


def test_forgotten_pieces_are_found_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    codec = bpe.Codec(bpe.public_vocabulary())
    value = " ".join(f"word{k % 17} and{k % 5}" for k in range(500))
    assert codec.encode(value) == LIBRARY.encode(value, add_special_tokens=False).ids


def test_ids_that_are_no_text():
    assert CODEC.decode([222, 50256]) == LIBRARY.decode([222, 50256], skip_special_tokens=False)


def test_contract(spark, tmp_path):
    rows = corpus.edge_rows()
    folder = corpus.save(corpus.documents(spark, rows, clashing=True), tmp_path)
    got = bpe.op4_bpe_codec(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for row in rows:
        ids = LIBRARY.encode(row[1] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = hashlib.sha256((row[1] or "").encode()).hexdigest()
        want.append((row[0], len(ids), digest, text))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_clashing_columns_and_round_trip(spark):
    docs = corpus.documents(spark, corpus.edge_rows(), clashing=True)
    vocabulary = bpe.public_vocabulary()
    got = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert got.columns == docs.columns
    assert all(r["decoded"] == (r["text"] or "") for r in got.collect())


def test_empty_table(spark):
    vocabulary = bpe.public_vocabulary()
    assert bpe.encode(corpus.documents(spark, []), vocabulary).collect() == []

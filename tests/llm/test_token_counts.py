import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from devtide.llm import token_counts

from . import corpus

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
COUNTER = token_counts.PrefixCounts(token_counts.public_vocabulary())
PARTS = st.one_of(
    st.text(max_size=10),
    st.text("aeinrst ", max_size=12),
    st.sampled_from([" ", "  ", "   ", "\n", "\t", token_counts.BLANK, "<s>", "</s>", "<unk>", "<0x41>", "ﬁ", "😀", "the "]),
)


def size(value: str) -> int:
    return len(LIBRARY.encode(value))


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=8).map("".join))
def test_every_prefix_equals_the_library(value):
    counts = token_counts.unpacked(COUNTER.packed([value])[0]).tolist()
    assert counts == [size(value[:k]) for k in range(len(value) + 1)]


@pytest.mark.parametrize("value", ["ab" * 3000, "a" * 5000, " " * 5000 + "x", "0123456789" * 500, "é中😀" * 700])
def test_long_runs(value):
    counts = token_counts.unpacked(COUNTER.packed([value])[0])
    assert len(counts) == len(value) + 1
    for k in (0, 1, 17, 1000, 1999, len(value) - 1, len(value)):
        assert counts[k] == size(value[:k])


def test_forgotten_words_are_found_again(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    counter = token_counts.PrefixCounts(token_counts.public_vocabulary())
    value = " ".join(f"word{k % 17} and{k % 5}" for k in range(500))
    assert token_counts.unpacked(counter.packed([value])[0])[-1] == size(value)


def test_steps_that_do_not_fit_a_byte(monkeypatch):
    value = "some words é"
    narrow = token_counts.unpacked(COUNTER.packed([value])[0])
    monkeypatch.setattr(token_counts.PrefixCounts, "_steps", lambda self, word, counts=None: None)
    counter = token_counts.PrefixCounts(token_counts.public_vocabulary())
    wide = counter.packed([value])[0]
    assert wide[0] == 4 and token_counts.unpacked(wide).tolist() == narrow.tolist()


def test_pieces_across_blanks_are_no_cut():
    """A vocabulary with a piece that reaches over a blank: the whole text is one word."""
    pieces = {c: -9.0 for c in "ab" + token_counts.BLANK} | {f"a{token_counts.BLANK}": -1.0, f"a{token_counts.BLANK}b": -2.0}
    counter = token_counts.PrefixCounts(token_counts.Vocabulary(pieces))
    assert token_counts.unpacked(counter.packed(["a b"])[0]).tolist() == [0, 2, 2, 2]


def test_a_model_of_another_kind_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        token_counts.load(str(path))


def test_contract(spark, tmp_path):
    rows = corpus.edge_rows()
    folder = corpus.save(corpus.documents(spark, rows, clashing=True), tmp_path)
    got = token_counts.op13_token_counts(spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_fit", "fit_tokens"]
    assert dict(got.dtypes)["over_limit"] == "boolean"
    want = [
        (r[0], len((r[1] or "").encode()), size(r[1] or ""), size(r[1] or "") > token_counts.LIMIT) for r in rows
    ]
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert any(r[3] for r in want)


@pytest.mark.parametrize("budget", [0, 1, 7, 40])
def test_truncations_against_encoding_every_prefix(spark, budget):
    rng = random.Random(budget)
    letters = "abcdeinrst  \n1é中"
    rows = [(k, "".join(rng.choices(letters, k=rng.randint(0, 90))), "aa", "s", 0) for k in range(40)]
    docs = corpus.documents(spark, rows, clashing=True).selectExpr("*", "1 as n_fit", "'x' as prefix_tokens")
    counted = token_counts.prefix_counts(docs, token_counts.public_vocabulary())
    got = token_counts.truncations(counted, budget).collect()
    for row in got:
        fits = [k for k in range(len(row.text) + 1) if size(row.text[:k]) <= budget]
        assert (row.n_fit, row.fit_tokens) == (fits[-1], size(row.text[: fits[-1]]))
    assert len(got) == len(rows)


def test_empty_table(spark):
    counted = token_counts.prefix_counts(corpus.documents(spark, []), token_counts.public_vocabulary())
    assert token_counts.truncations(counted, 5).collect() == []

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from shelfwise.llm import bpe

VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["Hello world, it's 2024!  \n\n tabs\t\tand   spaces ", "", None, "a" * 5000, "é ü ñ 日本語 🎉🎉", "\x1c\x85　x",
         "aaaa aaa aa a", "Hello world, it's 2024!  \n\n tabs\t\tand   spaces ", "don't 's 've I'll", " \n ", "\x00\x01\x7f"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCAB), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe._Encoder(bpe.Merges(bpe.read_ranks(VOCAB)), public_tokenizers.PATTERN)


def test_round_trip_and_ids(spark, frame, reference):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "y")]
    docs = frame(rows, "doc_id long, text string, ids string")  # a column with the output's name is replaced
    out = bpe.decode(bpe.encode(docs, VOCAB, public_tokenizers.PATTERN), VOCAB)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_encodes_its_own_output_column(spark, frame, reference):
    out = bpe.encode(frame([("ab cd",)], "ids string"), VOCAB, public_tokenizers.PATTERN, text_col="ids")
    assert out.collect()[0]["ids"] == reference.encode_ordinary("ab cd")


def test_empty_table(spark, frame):
    out = bpe.decode(bpe.encode(frame([], "doc_id long, text string"), VOCAB, public_tokenizers.PATTERN), VOCAB)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "ids", "decoded"]


def test_decode_null_and_unknown_ids(spark, frame):
    df = frame([(1, [72, 73]), (2, None), (3, [])], "n int, ids array<int>")
    got = {r["n"]: bytes(r["decoded"]) for r in bpe.decode(df, VOCAB).collect()}
    assert got == {1: b"ij", 2: b"", 3: b""}
    with pytest.raises(Exception):
        bpe.decode(frame([(1, [10 ** 6])], "n int, ids array<int>"), VOCAB).collect()
    with pytest.raises(Exception):
        bpe.decode(frame([(1, [None])], "n int, ids array<int>"), VOCAB).collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab cdeéthin's1 \n", max_size=40), max_size=8))
def test_replay_equals_the_library(encoder, reference, texts):
    assert encoder(pa.array(texts, pa.string())).to_pylist() == [reference.encode_ordinary(t) for t in texts]


def test_forgetting_pieces_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 2)
    monkeypatch.setattr(bpe, "SPLIT_BYTES", 16)
    small = bpe._Encoder(bpe.Merges(bpe.read_ranks(VOCAB)), public_tokenizers.PATTERN)
    texts = ["one two three four five", "six seven eight", "one two three"]
    for _ in range(3):
        assert small(pa.array(texts, pa.string())).to_pylist() == [reference.encode_ordinary(t) for t in texts]

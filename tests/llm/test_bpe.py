import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from logvigil.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENS = bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


@pytest.mark.parametrize("leaf_chars, leaf_bytes", [(1 << 16, 8), (7, 8), (3, 2)])
def test_same_ids_as_the_library(known, monkeypatch, leaf_chars, leaf_bytes):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf_chars)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
    rng, codec = random.Random(1), bpe.Codec(TOKENS, public_tokenizers.PATTERN)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'re", "'", "ll", "é", "ß", "漢", "23", "!!", "\x1c", "\x85", "\xa0", " ", "​", "　"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(50)))
        assert codec.encode(text) == known.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + "c", " " * 9999 + "x", "abcabd" * 777, "=" * 1234, "ñandú" * 500, "x y " * 40000])
def test_long_texts(known, text):
    codec = bpe.Codec(TOKENS, public_tokenizers.PATTERN)
    ids = codec.encode(text)
    assert ids == known.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_memory_of_pieces_is_bounded(known, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    codec = bpe.Codec(TOKENS, public_tokenizers.PATTERN)
    text = " ".join(f"word{i}, x{i * i}" for i in range(2000))
    assert codec.encode(text) == known.encode_ordinary(text)
    assert max(map(len, (codec, codec.spaced, codec.small, codec.fits))) <= 51


def test_round_trips_of_odd_rows(known, odd_docs, no_docs):
    rows = bpe.round_trips(odd_docs, PATH, public_tokenizers.PATTERN).collect()
    assert [r.doc_id for r in rows] == [r.doc_id for r in odd_docs.select("doc_id").collect()]
    for row, source in zip(rows, odd_docs.collect()):
        ids = known.encode_ordinary(source.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((source.text or "").encode()).hexdigest()
    assert bpe.round_trips(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_encoded_and_decoded_columns(odd_docs, no_docs):
    ids = bpe.encoded(odd_docs, PATH, public_tokenizers.PATTERN)
    assert dict(ids.dtypes)["ids"] == "array<int>" and dict(ids.dtypes)["n_tokens"] == "string"
    back = bpe.decoded(ids, PATH).collect()
    assert [bytes(r.decoded).decode() for r in back] == [r.text or "" for r in odd_docs.collect()]
    assert bpe.decoded(bpe.encoded(no_docs, PATH, public_tokenizers.PATTERN), PATH).count() == 0

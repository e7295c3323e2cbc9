"""BPE against tiktoken and exact round trips (operator 3)."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm_fixtures import awkward, doc_rows, docs, nothing  # noqa: F401

from roomrate.llm import bpe
from roomrate.llm.queries import bpe_vocabulary


@pytest.fixture(scope="module")
def ranks():
    with open(bpe_vocabulary(), "rb") as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, public_tokenizers.PATTERN)


def test_random_strings(encoder, reference):
    rng = random.Random(2)
    bits = [" ", "\n", "\t", " ", "\x1c", "　", "a", "b", "the", "é", "ñ", "中", "🙂", "1", "23", "'s", "'ll",
            ".", "--", "  ", "İ", "и", "\x00", "\x85", "ing", "tion"]
    for _ in range(4000):
        s = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert encoder.encode(s) == reference.encode_ordinary(s), repr(s)


def test_long_pieces(encoder, reference):
    for s in ["a" * 20_000, "ab" * 5_000, "the" * 3_000, "中" * 2_000, "=" * 5_000, "x \n" * 500]:
        assert encoder.encode(s) == reference.encode_ordinary(s)


def test_pairs_agree_with_plain_merging(ranks):
    t = bpe.Transducer(ranks)
    rng = random.Random(1)
    ids = sorted(t.bytes_of)
    for _ in range(3000):
        a, b = rng.choice(ids), rng.choice(ids[:2000])
        assert t.may_follow(a, b) == (bpe.merge_by_rank(t.bytes_of[a] + t.bytes_of[b], ranks) == [a, b])


def test_small_state_table_gives_the_same(ranks, reference):
    small = bpe.Encoder(ranks, public_tokenizers.PATTERN, max_pieces=10)
    small.transducer.max_states = 20
    s = "Some words, and other words; déjà vu " * 20 + "z" * 5000
    assert small.encode(s) == reference.encode_ordinary(s)


def test_stream_decoder_splits_anywhere(ranks):
    text = "naïve 中文 🙂 ́ end"
    bytes_of = {i: bytes([i]) for i in range(256)}
    for step in range(1, 9):
        d = bpe.StreamDecoder(bytes_of)
        raw = text.encode()
        out = [d.feed(raw[i:i + step]) for i in range(0, len(raw), step)]
        assert "".join(out) + d.finish() == text
    d = bpe.StreamDecoder(bytes_of)
    assert d.feed(b"\xe4\xb8") + d.finish() == "�"
    for bad in (b"a\xffb", b"\xc0\x80", b"\xed\xa0\x80", b"\xf5a", b"\x80\x80"):
        d = bpe.StreamDecoder(bytes_of)
        assert d.feed(bad) + d.finish() == bad.decode("utf-8", "replace")


def test_query_over_documents(spark, docs, awkward, nothing, reference):
    for df in (docs, awkward, nothing):
        want = sorted((r.doc_id, len(ids := reference.encode_ordinary(r.text or "")),
                       hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.collect())
        got = bpe.round_trip(df, bpe_vocabulary())
        assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert sorted(tuple(r)[:4] for r in got.collect()) == want


def test_encode_then_decode(docs, doc_rows):
    back = bpe.decode_documents(bpe.encode_documents(docs, bpe_vocabulary()), bpe_vocabulary())
    assert {r.doc_id: r.text for r in back.collect()} == doc_rows


def test_parts_are_kept_once(ranks, reference):
    """A part that is one piece is not kept as a piece too; what is kept is packed."""
    enc = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "Some unlikelywordhere, some unlikelywordhere 中文"
    ids = reference.encode_ordinary(text)
    assert enc.encode_packed(text) == np.array(ids, "<u4").tobytes() and enc.encode(text) == ids
    assert " unlikelywordhere" in enc.pieces and "unlikelywordhere" in enc.parts
    assert " some" not in enc.pieces and isinstance(enc.parts["some"], bytes)
    assert enc.encode_packed("") == b""

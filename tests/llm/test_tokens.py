"""Token operators against the libraries that define their results."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import SparkSession

from tilewright.llm import bpe, bpe_codec, common, token_counts

from .conftest import AWKWARD

TEXTS = st.text(st.sampled_from("abcdefgh THE the  \n\t\x1c\x85\xa0!?'sl 12²éßΣ😀漢▁\x00\r<|>") | st.characters(codec="utf-8"), max_size=60)


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.ByteCodec(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_codec_on_any_text(codec, library):
    @settings(max_examples=300, deadline=None)
    @given(TEXTS)
    def check(text):
        ids = library.encode(text, add_special_tokens=False).ids
        got, decoded = codec.encode([text])[0]
        assert got == ",".join(map(str, ids))
        assert decoded.decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)

    check()


def test_counts_on_any_text(pieces):
    @settings(max_examples=300, deadline=None)
    @given(TEXTS)
    def check(text):
        assert pieces[0].count([text]) == [len(pieces[1].encode(text))]

    check()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 900, "!" * 2500, "éé" * 600, "x" * 511, "x" * 513])
def test_long_words(codec, library, pieces, text):
    assert codec.encode([text])[0][0] == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))
    assert pieces[0].count([text]) == [len(pieces[1].encode(text))]


def test_merging_in_step_equals_one_by_one(codec):
    rng = np.random.default_rng(0)
    words = [rng.choice(list(b"the andings"), rng.integers(1, 40)) for _ in range(300)]
    flat = codec.byte_id[np.concatenate(words)]
    symbols, n = codec.merger.merge(flat, np.array([len(w) for w in words]))
    ends = np.cumsum(n)
    table = codec.merger._dict()
    for w, end, k in zip(words, ends, n):
        assert symbols[end - k : end].tolist() == bpe.merge_one(codec.byte_id[w].tolist(), table)


def test_speculation_is_verified(codec):
    words = [w.encode() for t in AWKWARD if t[1] for w in codec.parts(t[1])]
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    tokens, n = codec.speculate(flat, np.array([len(w) for w in words]))
    assert codec.decode(tokens.tolist()) == b"".join(words)
    assert n.sum() == len(tokens)


def want8(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_op8(spark: SparkSession, sf, awkward, library):
    for docs in (common.read_table(spark, sf, "documents"), awkward):
        want = sorted(((r.doc_id or 0, *want8(library, r.text)) for r in docs.select("doc_id", "text").collect()))
        assert sorted((r.doc_id or 0, *r[1:]) for r in bpe_codec.bpe_round_trip(docs).collect()) == want
    assert bpe_codec.bpe_round_trip(awkward.limit(0)).count() == 0


def test_op10(spark: SparkSession, sf, awkward, pieces):
    for docs in (common.read_table(spark, sf, "documents"), awkward):
        rows = docs.select("doc_id", "text").collect()
        n = [len(x) for x in pieces[1].encode([r.text or "" for r in rows])]
        want = sorted((r.doc_id or 0, len((r.text or "").encode()), k, k > 4096) for r, k in zip(rows, n))
        assert sorted((r.doc_id or 0, *r[1:]) for r in token_counts.token_counts(docs).collect()) == want
    assert token_counts.token_counts(awkward.limit(0)).count() == 0

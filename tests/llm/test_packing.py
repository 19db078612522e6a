"""Packing: exact tokens, gapless sequences, and no more of them than an exact search needs."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright.llm import common, packing


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_words_on_any_text(library):
    codec = packing.WordCodec(public_tokenizers.path("word_bpe_49k.json"))

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from("abcdef THE the  \n\t\x1c\x85\xa0!?'sl 12²éßΣ😀漢\x00<|>") | st.characters(codec="utf-8"), max_size=60))
    def check(text):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == want

    check()


def fewest(items, capacity):
    """By exhaustive search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {*rooms}:
            if r >= items[i]:
                rest = [*rooms]
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(items):
    counts = np.bincount(items, minlength=21)[:21].astype(np.int64)
    fixed = packing.reduce_instance(counts, 20)
    rest = [i for i in range(21) for _ in range(counts[i])]
    assert sum(b.count for b in fixed) + fewest(rest, 20) == fewest(items, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=200))
def test_plan_places_every_piece_once(items):
    slots, sequences = packing.plan_packing({n: items.count(n) for n in {*items}}, 30)
    taken = {}
    for n in {*items}:
        own = slots[slots[:, 0] == n]
        for rank in range(items.count(n)):
            slot = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            nth = rank - slot[1]
            seq, at = slot[3] + nth // slot[2], slot[4] + nth % slot[2] * n
            taken.setdefault(int(seq), []).append((int(at), n))
    assert len(taken) == sequences
    for parts in taken.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 30


def test_op6(spark, sf, awkward, library):
    for docs in (common.read_table(spark, sf, "documents"), awkward):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
            for p, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at : at + 4096]
                want.append((r.doc_id or 0, p, at, len(part), zlib.crc32(part.tobytes())))
        got = packing.pack_documents(docs).collect()
        assert sorted((r.doc_id or 0, *r[1:5]) for r in got) == sorted(want)
        filled = {}
        for r in got:
            filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in filled.values():
            end = 0
            for at, n in sorted(parts):
                assert at == end
                end += n
            assert end <= 4096
        assert len(filled) <= 1.02 * (sum(w[3] for w in want) / 4096) + 1
    assert packing.pack_documents(awkward.limit(0)).count() == 0

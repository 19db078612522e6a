"""Scores against a model held whole in dictionaries, and that the model is a probability."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from tilewright.llm import common, lm_scoring


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, order=3, mu=3.0):
    held = [zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 1 for r in rows]
    runs = Counter()
    for r, h in zip(rows, held):
        if not h:
            t = ("<s>", *tokens(r.text))
            runs.update(t[i : i + k] for k in range(1, order + 1) for i in range(len(t) - k + 1) if k > 1 or i)
    runs["<s>",] = runs[None,]
    one = {w[0]: n for w, n in runs.items() if len(w) == 1 and w[0] != "<s>" and n}
    n, v = sum(one.values()), len(one)

    def p(run):
        if len(run) == 1:
            return (one.get(run[0], 0) + 0.5) / (n + 0.5 * (v + 1))
        return (runs[run] + mu * p(run[1:])) / (runs[run[:-1]] + mu)

    out = []
    for r, h in zip(rows, held):
        t = ("<s>", *tokens(r.text))
        score = sum(math.log10(p(t[max(0, i + 1 - order) : i + 1] if order > 1 else t[i : i + 1])) for i in range(1, len(t)))
        out.append((r.doc_id or 0, h, len(t) - 1, sum(w in one for w in t[1:]), n, sum(math.log10(p((w,))) for w in t[1:]), score))
    return sorted(out)


def compare(docs, **more):
    got = sorted((r.doc_id or 0, *r[1:]) for r in lm_scoring.lm_scores(docs, **more).collect())
    want = brute(docs.select("doc_id", "text").collect(), **more)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_against_dictionaries(spark, sf, awkward, monkeypatch):
    compare(common.read_table(spark, sf, "documents"))
    compare(awkward)
    assert lm_scoring.lm_scores(awkward.limit(0)).count() == 0
    monkeypatch.setattr(lm_scoring, "BLOCK", 20_000)
    compare(common.read_table(spark, sf, "documents"), order=4)
    compare(common.read_table(spark, sf, "documents"), order=2)
    compare(awkward, order=1)


def test_held_out_text_is_better_predicted_than_by_single_words(spark):
    got = lm_scoring.lm_scores(common.read_table(spark, "/root/testdata/sf0.1", "documents")).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got.s > got.b


def test_packing_round_trips():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    for kind, own in ((1, keys), (2, np.unique(keys & lm_scoring.SHORT))):
        for slot, part in lm_scoring.cut(own, 9):
            assert (lm_scoring.unpack_keys(lm_scoring.pack_keys(own[part], kind), kind) == own[part]).all() and (own[part] >> np.uint64(55) == slot).all()
    for n in ([0, 1, 255, 256, 1 << 40], [0], [7]):
        assert (lm_scoring.unpack(lm_scoring.pack(np.array(n))) == n).all()

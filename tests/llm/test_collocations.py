import random
import re
import string
from collections import Counter

import pytest

from tilewright.llm import collocations as co
from tilewright.llm import common

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, min_n=2, max_n=3, least=10, top=2000, share=50):
    counts, n = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, max_n + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) >= min_n and a >= least}
        longer = Counter()
        for p, a in some.items():
            for k in range(min_n, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        kept = []
        for p, a in some.items():
            if 100 * longer[p] < share * a:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    some = ["the", "of", "and", "A", "été", "漢字", "ﬁ", "x\x1cy", "nb\xa0sp", "|", "-", "'s"] + [f"w{k}" for k in range(30)]
    rows = []
    for k in range(300):
        text = "".join(rng.choices(some, [30, 20, 10] + [1] * (len(some) - 3))[0] + rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "!?")) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "fr", None, "und", "EN", ""]), text + rng.choice(["", " same words at the end of it", "\nSAME WORDS AT"])))
    rows += [("en", None), ("en", ""), (None, " \t\n.,"), ("de", "word " * 30_000), ("de", "x" * 200_000), ("xx", "a b " * 9), ("the the", "the " * 40)] + [("es", "uno dos tres")] * 12
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "2 as size", "'p' as phrase", "3 as rank", "4 as doc_id")


@pytest.mark.parametrize("settings", [{}, {"max_n": 4, "least": 3}, {"max_n": 2, "top": 5}, {"min_n": 3, "share": 90}])
def test_against_brute_force(docs, settings):
    got = sorted(tuple(r) for r in co.collocations(docs, **settings).collect())
    assert got == brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()], **settings)


def test_small_keys_and_many_hot_words(docs, monkeypatch):
    """Suffixes of hot words spread over keys by their second and third words and are put together again."""
    want = brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()])
    for hot in (4, 40, 4096):
        monkeypatch.setattr(co, "HOT", hot)
        monkeypatch.setattr(co, "KEY", 50)
        monkeypatch.setattr(co, "CELLS", 512)  # words share cells
        frame = docs.repartition(3)
        assert sorted(tuple(r) for r in co.collocations(frame).collect()) == want


def test_whole_table_and_awkward(spark, sf, awkward):
    for frame in (common.read_table(spark, sf, "documents"), awkward):
        assert sorted(tuple(r) for r in co.collocations(frame).collect()) == brute([(r.lang, r.text) for r in frame.select("lang", "text").collect()])
    assert co.collocations(awkward.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        l, r = rng.randint(10, 10**14), rng.randint(10, 10**14)
        rows.append((rng.randint(1, min(l, r)), l, r))
    rows += [(10**14, 10**14, 10**14), (10**14 - 1, 10**14, 10**14 - 1)]
    for r in co.scored(spark.createDataFrame(rows, "a long, l long, r long")).collect():
        assert r.score == 1_000_000 * r.a * r.a // (r.l * r.r)

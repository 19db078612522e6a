import random
import re
import string

import numpy as np
import pytest

from tilewright.llm import decontamination as dc

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(dc.WORD, (text or "").translate(LOWER))


def brute(docs, items, longest=10):
    windows = {}
    for item, text in items:
        w = words(text)
        g = min(len(w), longest)
        for a in range(len(w) - g + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + g]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for g in {len(x) for x in windows}:
            for a in range(len(w) - g + 1):
                if (owners := windows.get(tuple(w[a : a + g]))) is not None:
                    hit |= set(range(a, a + g))
                    found |= owners - {None}
        out.append((doc, len(w), len(hit), len(found), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    some = [f"w{k}" for k in range(40)] + ["été", "漢字", "A", "b"]
    text = lambda n: " ".join(rng.choices(some, k=n))
    items = [(k, text(rng.randint(8, 30))) for k in range(60)] + [(100, "one"), (101, "Two words"), (102, None), (103, " ,. "), (104, "w1 w2 w1"), (None, "the item without an id has " + text(12))]
    preamble = "choose the right answer to every one of these questions please: "
    items += [(200 + k, preamble + text(8)) for k in range(20)] + [(300, items[0][1]), (301, items[0][1]), (0, items[0][1])]
    docs = []
    for k in range(120):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 9))
            parts += [rng.choice((" ", ", ", "...\n")).join(w[a : a + rng.randint(8, 14)]).upper(), text(rng.randint(0, 20))]
        docs.append((k, " ".join(parts)))
    docs += [(None, docs[3][1]), (5, docs[6][1]), (5, docs[6][1]), (900, None), (901, ""), (902, "!?"), (903, preamble * 300), (904, text(20_000)), (905, "one"), (906, "x" * 300_000)]
    clash = ["1 as n_words", "2 as id", "3 as mark", "4 as window", "5 as seeds"]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *clash), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", *clash)


@pytest.mark.parametrize("longest", [10, 4, 1])
def test_against_brute_force(tables, longest):
    docs, items, d, b = tables
    got = sorted((tuple(r) for r in dc.decontaminate(d, b, longest).collect()), key=str)
    assert got == brute(docs, items, longest)


def test_a_full_filter_changes_nothing(tables, monkeypatch):
    docs, items, d, b = tables
    monkeypatch.setattr(dc, "filter_bits", lambda prints: np.full(8192, 255, np.uint8))
    got = sorted((tuple(r) for r in dc.decontaminate(d, b).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(tables, awkward):
    _, _, d, b = tables
    assert dc.decontaminate(d.limit(0), b).count() == 0
    for none in (b.limit(0), b.filter("item_id = 103")):
        rows = dc.decontaminate(awkward, none).collect()
        assert len(rows) == awkward.count() and not any(r.contaminated or r.n_hit or r.item_ids for r in rows)


def test_every_long_shared_run_has_a_shared_fingerprint():
    rng = np.random.default_rng(3)
    for run in (1, 2, 6):
        a, b = (rng.integers(0, 4, 400).astype(np.uint64) for _ in range(2))
        at = {k: set(dc.winnow(x, np.array([150, 250]), run).tolist()) for k, x in (("a", a), ("b", b))}
        for i in range(400 - run + 1):
            for j in range(400 - run + 1):
                whole = all(not x < 150 < x + run for x in (i, j))
                if whole and (a[i : i + run] == b[j : j + run]).all():
                    assert any(i + k in at["a"] and j + k in at["b"] for k in range(run))

"""The banded join against all pairs compared one by one."""

import random

import numpy as np
import pytest

from tilewright.llm import common, ngram_join


def sets_of(rows, n=5):
    out = []
    for r in rows:
        text = r.text or ""
        for c in "\t\n\x0b\f\r":
            text = text.replace(c, " ")
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split(" ") if w]
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        out.append(grams or ({tuple(words)} if words else set()))
    return out


def brute(rows, threshold=0.8):
    sets, n = sets_of(rows), len(rows)
    links, label = [0] * n, list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= threshold * max(len(a), len(b)) - 1e-9:
                both = len(a & b)
                if both >= threshold * (len(a) + len(b) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    label[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return sorted((r.doc_id or 0, least.get(find(i), r.doc_id) or 0, links[i]) for i, r in enumerate(rows))


def test_whole_small_table_and_awkward_rows(spark, sf, awkward):
    for docs in (common.read_table(spark, sf, "documents"), awkward):
        got = ngram_join.ngram_join(docs).collect()
        assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in got) == brute(docs.select("doc_id", "text").collect())
        assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    assert ngram_join.ngram_join(awkward.limit(0)).count() == 0
    kept = ngram_join.keep_classes(awkward)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 8, 9, 10, None}


def test_large_near_copy_group_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(120):
        words = [*base]
        for _ in range(rng.randrange(6)):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.ngram_join(docs).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute(docs.collect())


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and 1 - (1 - 0.5**rows) ** bands <= 0.25


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 60), (60, 50)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    label = common.roots(len(nodes), np.array([at[a] for a, _ in edges], int), np.array([at[b] for _, b in edges], int))
    assert got == {x: nodes[label[at[x]]] for x in nodes}


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    saved = []
    monkeypatch.setattr(common, "save", lambda frame, save=common.save: saved.append(1) or save(frame))
    edges = spark.range(1, 5001).selectExpr("id as a", "id + 1 as b")
    got = common.components(edges).selectExpr("count(*) n", "min(component) low", "max(component) high").first()
    assert (got.n, got.low, got.high) == (5001, 1, 1) and len(saved) <= 3 * 22 + 2

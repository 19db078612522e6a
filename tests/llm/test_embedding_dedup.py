"""The forest against all cosines."""

import math

import numpy as np

from tilewright.llm import common, embedding_dedup


def brute(rows, threshold=0.93):
    usable = {}
    for i, r in enumerate(rows):
        e = r.embedding
        if r.vec_id is not None and r.label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e):
            v = np.array(e, float)
            v = v / np.abs(v).max()
            usable.setdefault((r.label, len(e)), []).append((i, v / np.linalg.norm(v)))
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for own in usable.values():
        m = np.stack([v for _, v in own])
        for a, b in zip(*np.nonzero(m @ m.T >= threshold)):
            if a < b:
                i, j = own[a][0], own[b][0]
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[find(i)] = min(least.get(find(i), r.vec_id), r.vec_id)
    return sorted((r.vec_id or 0, links[i], least.get(find(i)) or 0) for i, r in enumerate(rows))


def compare(frame, settings=embedding_dedup.Settings()):
    got = embedding_dedup.embedding_dedup(frame, settings=settings).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == brute(frame.collect())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_small_table(spark):
    compare(common.read_table(spark, "/root/testdata/sf0.01", "embeddings"), embedding_dedup.Settings(leaf=16))


def test_crowded_leaves_in_blocks(spark, sf):
    compare(common.read_table(spark, sf, "embeddings").selectExpr("vec_id", "embedding", "1 as label"), embedding_dedup.Settings(leaf=64, block=8))


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, None], 1), (7, [1.0, nan], 1),
        (8, [inf, 1.0], 1), (9, [], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1), (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1),
        (14, [1.0, 0.0], 1), (14, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (15, [1e-30, 0.0], 1), (16, [3e38, 3e38], 3), (17, [3e38, 2.9e38], 3),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as rep", "2 as links", "3 as vector")
    compare(frame)
    assert embedding_dedup.embedding_dedup(frame.limit(0)).count() == 0
    compare(frame.selectExpr("vec_id", "cast(embedding as array<double>) embedding", "label"))


def groups(spark, n, dims=(16,), labels=(1,), seed=0):
    """Vectors around common middles, at cosines on either side of the threshold."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        dim, label = dims[i % len(dims)], labels[i % len(labels)]
        if i % 5 == 0 or dim != len(middle):
            middle = rng.normal(size=dim)
        rows.append((i, [float(x) for x in middle + 0.22 * rng.normal(size=dim)], label))
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_recall_against_brute_force(spark):
    frame = groups(spark, 3000, labels=(1, 2))
    want = {i: n for i, n, _ in brute(frame.collect())}
    # Splits of the upper levels and of those below them, set in two steps.
    got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_dedup(frame, settings=embedding_dedup.Settings(leaf=24, first=3, block=256)).collect()}
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) >= 0.99 * sum(want.values()) > 3000


def test_vectors_of_any_number_of_lengths(spark):
    compare(groups(spark, 700, dims=tuple(range(3, 90))), embedding_dedup.Settings(leaf=4))


def test_first_shared_leaf():
    lists = [np.array(x, np.int64) for x in ([1, 5, 9], [5, 9], [2, 9], [2, 5, 9], [9])]
    i, j = np.triu_indices(5, 1)
    for leaf in (1, 2, 5, 6, 9):
        got = embedding_dedup.share_any(embedding_dedup.sets_before(lists, leaf), i, j)
        assert got.tolist() == [bool({x for x in lists[a] if x < leaf} & {*lists[b].tolist()}) for a, b in zip(i, j)]

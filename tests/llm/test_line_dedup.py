"""Line dedup against all pairs of lines compared one by one."""

import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tilewright.llm import common, line_dedup


def brute(rows, threshold=0.8, least=3):
    lines = []
    for r in rows:
        for i, line in enumerate((r.text or "").split("\n")):
            words = {"".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", line)}
            if len(words) >= least:
                lines.append(((r.doc_id if r.doc_id is not None else line_dedup.LAST, i), words))
    lines.sort(key=lambda x: x[0])
    by_word, gone = {}, {}
    for k, (place, words) in enumerate(lines):
        seen = {}
        for w in words:
            for j in by_word.get(w, ()):
                seen[j] = seen.get(j, 0) + 1
            by_word.setdefault(w, []).append(k)
        if any(n >= threshold * (len(words) + len(lines[j][1]) - n) - 1e-9 and lines[j][0] < place for j, n in seen.items()):
            gone.setdefault(place[0], set()).add(place[1])
    return {d: sorted(x) for d, x in gone.items()}


def compare(docs):
    rows = docs.select("doc_id", "text").collect()
    want = brute(rows)
    got = {r.doc: r.lines for r in line_dedup.removed_lines(docs).collect()}
    assert {d: sorted(set(x)) for d, x in got.items()} == want
    return want


def test_small_table(spark, sf):
    assert compare(common.read_table(spark, sf, "documents"))


def test_awkward_rows(spark, awkward):
    compare(awkward)
    out = line_dedup.line_dedup(awkward)
    assert out.columns == [*(c for c in awkward.columns if c != line_dedup.LOST), line_dedup.LOST] and out.count() == awkward.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[3].text is None and rows[4].text == "" and rows[2].text == "" and rows[1].line_dedup_removed == []
    assert {r.doc_id for r in line_dedup.without_repeats(awkward).collect()} == {1, 3, 4, 5, 6, 7, 8, 9, 10, None}
    assert line_dedup.line_dedup(awkward.limit(0)).count() == 0


def test_many_variants_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    monkeypatch.setattr(line_dedup, "VERIFIED", 16)
    monkeypatch.setattr(line_dedup, "PIVOTS", 2)
    monkeypatch.setattr(line_dedup, "TOGETHER", 8)
    monkeypatch.setattr(line_dedup, "PENDING", 50)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(80):
        lines = [" ".join(base[: 24 + rng.randrange(7)] + [f"x{rng.randrange(40)}" for _ in range(rng.randrange(4))]) for _ in range(3)]
        rows.append((i, "\n".join([*lines, f"only here {i} {rng.random()}"])))
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_short_lines_go_too(spark, sf):
    rows = [(1, "buy now buy now buy now\nhome\nHome\na b c\na b c d"), (2, "now buy\n\n \nhome page\nc b a a\nd e a b c"), (3, "HOME")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc: r.lines for r in line_dedup.removed_lines(docs, least=1).collect()} == {1: [2], 2: [0, 4, 5], 3: [0]}
    assert {r.doc_id for r in line_dedup.without_repeats(docs, least=1).collect()} == {1, 2}
    docs = common.read_table(spark, sf, "documents")
    want = brute(docs.select("doc_id", "text").collect(), least=1)
    got = {r.doc_id: [*map(int, r.removed.split(","))] for r in line_dedup.op7_line_dedup(spark, sf).collect() if r.n_removed}
    assert got == want and want != brute(docs.select("doc_id", "text").collect())


def test_names_of_its_own_in_the_input(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e f", 7, "g"), (2, "d e f\nx", 8, "h"), (None, "x\ny", 9, None)], "doc_id int, text string, line_dedup_removed int, gone_doc string")
    out = line_dedup.line_dedup(docs, least=1)
    assert out.columns == ["doc_id", "text", "gone_doc", "line_dedup_removed"]
    assert {(r.doc_id, r.text, r.gone_doc): r.line_dedup_removed for r in out.collect()} == {(1, "a b c\nd e f", "g"): [], (2, "x", "h"): [0], (None, "y", None): [0]}
    again = line_dedup.line_dedup(out, least=1)
    assert all(r.line_dedup_removed == [] for r in again.collect())
    kept = line_dedup.without_repeats(docs, least=1)
    assert kept.columns == docs.columns and sorted((r.text, r.line_dedup_removed) for r in kept.collect()) == [("a b c\nd e f", 7), ("x", 8), ("y", 9)]


def tied(lines, threshold, second, long):
    """Of each line the smallest one that the prefix join ties it to, without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lines)), pa.int64()), pa.array([" ".join(x) for x in lines])], ["doc_id", "text"])
    every = SimpleNamespace(value=np.full(1 << 10, 255, np.uint8))
    frequency = SimpleNamespace(value=np.ones(line_dedup.CELLS, np.int64))
    packs = pa.Table.from_batches(line_dedup.prefixes(frequency, threshold, 1, 4, often=every, long=long)(iter([batch]))).sort_by("key")
    marks = line_dedup.Lines(batch, 1).marks()[0].tolist()
    at = {m: k for k, m in reversed([*enumerate(marks)])}
    a, b = [], []
    for out in line_dedup.meeting(threshold, second)(iter(packs.to_batches())):
        a += [at[x] for x in out.column("a").to_pylist()]
        b += [at[x] for x in out.column("b").to_pylist()]
    same = [at[m] for m in marks]
    return common.roots(len(lines), np.array([*a, *range(len(lines))]), np.array([*b, *same]))


@pytest.mark.parametrize("threshold, sizes, second, long", [(0.8, (4, 40), 4, 256), (0.8, (4, 60), 4, 30), (0.3, (1, 8), 4, 256), (0.55, (1, 12), 2, 7), (0.8, (4, 40), 1 << 30, 256)])
def test_split_words_tie_every_pair(threshold, sizes, second, long):
    rng = random.Random(8)
    lines = []
    for _ in range(120):
        words = rng.sample(range(70), rng.randint(*sizes))
        lines.append(words)
        for _ in range(3):
            keep = rng.sample(words, max(1, len(words) - rng.randrange(len(words) // 4 + 2)))
            lines.append(list({*keep, *rng.sample(range(70), rng.randrange(len(words) // 5 + 2))}))
    lines = [[f"w{x}" for x in words] for words in lines]
    root, sets = tied(lines, threshold, second, long), [{*words} for words in lines]
    near = lambda i: len(sets[i]) >= threshold * (len(sets[i]) + 1) - 1e-9
    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if near(i) and near(j) and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    assert len(pairs) > 100 and all(root[i] == root[j] for i, j in pairs)


def test_compared_pairs_grow_with_the_lines(monkeypatch):
    """Four times the lines over the same words: pairs that meet at one word would be sixteen times as many."""
    compared, entries = [], line_dedup.entries
    monkeypatch.setattr(line_dedup, "entries", lambda *a: (out := entries(*a), compared.append(int(out[1].sum())))[0])
    made = []
    for n in (1500, 6000):
        rng = random.Random(n)
        lines = [[f"w{x}" for x in rng.sample(range(1000), 20)] for _ in range(n)]
        lines += [[*x[:-1], "other"] for x in lines[:50]]
        compared.clear()
        root = tied(lines, 0.8, 16, 256)
        assert all(root[n + k] == root[k] for k in range(50))
        made.append(sum(compared))
    assert made[1] < 8 * made[0] and made[1] < 20 * 6000


def test_small_bodies_leave_together():
    docs = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([f"a{i}\nb{i}" for i in range(300)])], ["doc_id", "text"])
    bodies = line_dedup.gathered([docs], 1000)
    assert bodies.num_rows > 200
    gone = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([[i % 2] for i in range(300)], pa.list_(pa.int32()))], ["doc", "lines"])
    met = pa.Table.from_batches([*line_dedup.losses(1000)(iter([gone])), bodies])
    met = met.append_column("last", pc.is_null(met.column("doc"))).sort_by([("part", "ascending"), ("last", "ascending")])
    out = [*line_dedup.without_losses(["doc_id", "text", line_dedup.LOST])(iter(met.to_batches()))]
    rows = sorted((r["doc_id"], r["text"]) for b in out for r in b.to_pylist())
    assert len(out) == 1 and rows == [(i, f"b{i}" if i % 2 == 0 else f"a{i}") for i in range(300)]

import hashlib
import string

import numpy as np

from tilewright.llm import common, exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r.text or "").translate(LOWER), []).append(r.doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_against_brute_force(spark, sf, awkward):
    for docs in (common.read_table(spark, sf, "documents"), awkward):
        got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs).collect()), key=str)
        assert got == brute(docs.select("doc_id", "text").collect())
    assert exact_dedup.exact_dedup(awkward.limit(0)).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 500, 400).astype(np.uint64) for _ in range(5)]
    runs = [np.unique(p, return_counts=True) for p in parts]
    found, n = exact_dedup.merge_runs([r[0] for r in runs], [r[1] for r in runs])
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (found == want[0]).all() and (n == want[1]).all()


def test_filters_are_packed_without_loss():
    rng = np.random.default_rng(2)
    for bits in (4, 8, 17, 20):
        found = np.unique(rng.integers(0, 1 << (64 - bits), 300, dtype=np.uint64))
        for most in (2, 300, 1 << 40):
            counts = rng.integers(1, most, len(found))
            a, b = exact_dedup.packed(found, exact_dedup.remainder_bytes(bits)), exact_dedup.packed(counts.astype(np.uint64), exact_dedup.count_bytes(counts))
            got = exact_dedup.opened(a, b, bits)
            assert (got[0] == found).all() and (got[1] == counts).all()
            assert len(a) <= len(found) * 8 and (most > 256 or len(b) == len(found))


def test_equal_fingerprints_of_different_texts_stay_apart(spark, monkeypatch):
    """Were all texts to share one fingerprint, the bytes would still tell them apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}

import numpy as np

from tilewright.llm import common, hashing, quality


def test_held_out_accuracy(spark):
    """Of the labelled documents of sf0.1 that had no part in the fit, nearly all are judged rightly."""
    sf = "/root/testdata/sf0.1"
    docs, labels = common.read_table(spark, sf, "documents"), common.read_table(spark, sf, "labels")
    got = {r.doc_id: r.selected for r in quality.resample(docs, labels.filter("doc_id % 2 = 0")).collect()}
    assert len(got) == docs.count()
    for q, least in ((1, 0.97), (0, 0.9)):
        ids = [r.doc_id for r in labels.filter(f"doc_id % 2 = 1 and quality = {q}").collect()]
        assert np.mean([got[i] == bool(q) for i in ids]) >= least


def test_model_is_the_ratio_of_plain_counts(spark):
    docs = spark.createDataFrame([(i, "good words here" if i < 20 else "bad !! noise") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20), 0) for i in range(30)], "doc_id long, quality int, toxic int")
    settings = quality.Settings(buckets=64)
    sample = quality.labelled_sample(labels, settings)
    model = quality.fit(docs, sample, settings)
    total = np.zeros((2, 64))
    held = {r.doc_id: r.held_out for r in sample.collect()}
    for i in range(30):
        words = [hashing.word_hashes([w], lower=False)[0][0] for w in ("good words here" if i < 20 else "bad !! noise").split()]
        pairs = hashing.grams(np.array(words), np.array([3]), 2)[0]
        for h in [*words, *pairs]:
            total[0, int(h) % 64] += 1
            total[1, int(h) % 64] += i < 20 and not held[i]
    expected = total[0] * total[1].sum() / total[0].sum()
    assert np.allclose(model.log_ratio, np.log((total[1] + 5) / (expected + 5)))


def test_top_k_is_exact(spark):
    keys = np.concatenate((np.random.default_rng(0).normal(size=500), [0.25] * 40, [-np.inf] * 3))
    frame = spark.createDataFrame([(float(x),) for x in keys], "key double")
    for k in (1, 2, 57, 300, 539):
        cut = quality.top_k_cut(frame, k, bins=8, rounds=40)
        assert np.isclose(cut, sorted(keys)[-k])
    assert quality.top_k_cut(frame, 0) == np.inf and quality.top_k_cut(frame, 10_000) == -np.inf


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 0, 0), (9, 0, 0), (None, 1, 0), (3, None, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.resample(awkward, labels).collect()
    assert len(got) == awkward.count()
    assert {r.doc_id for r in got if not r.n_features} == {3, 4, 5} and not any(r.selected for r in got if not r.n_features)
    kept = quality.keep_drawn(awkward, labels)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in got if r.selected)
    assert quality.resample(awkward.limit(0), labels).count() == 0
    none = quality.resample(awkward, labels.limit(0)).collect()
    assert all(r.selected == (r.n_features > 0) for r in none)


def test_selected_is_the_exact_top_k_of_log_weight_and_noise(spark, sf):
    """The whole query by plain Python: counts, log ratios of whole texts, noise, k from the labels, the k largest."""
    docs, labels = common.read_table(spark, sf, "documents"), common.read_table(spark, sf, "labels")
    settings = quality.Settings()
    marks = {r.doc_id: r for r in quality.labelled_sample(labels, settings).collect()}
    u = docs.selectExpr("doc_id", "text", f"(pmod(xxhash64(doc_id, {settings.seed}), {1 << 52}) + 0.5D) / {float(1 << 52)!r}D as u").collect()
    total, grams = np.zeros((2, settings.buckets)), []
    for r in u:
        words = [hashing.word_hashes([w], lower=False)[0][0] for w in (r.text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        pairs = hashing.grams(np.array(words, np.uint64), np.array([len(words)]), 2)[0]
        own = [int(h) % settings.buckets for h in [*words, *pairs]]
        np.add.at(total[0], own, 1)
        if r.doc_id in marks and marks[r.doc_id].good and not marks[r.doc_id].held_out:
            np.add.at(total[1], own, 1)
        grams.append(own)
    ratio = np.log((total[1] + settings.smoothing) / (total[0] * total[1].sum() / total[0].sum() + settings.smoothing))
    weight = np.array([ratio[g].sum() for g in grams])
    key = np.where([len(g) > 0 for g in grams], weight - np.log(-np.log([r.u for r in u])), -np.inf)
    fresh = [i for i, r in enumerate(u) if grams[i] and r.doc_id in marks and (marks[r.doc_id].held_out or not marks[r.doc_id].good)]
    cut = quality.best_cut(weight[fresh], np.array([marks[u[i].doc_id].good for i in fresh]), settings.mercy)
    k = int(np.sum((weight >= cut) & [len(g) > 0 for g in grams]))
    want = {u[i].doc_id for i in np.argsort(-key, kind="stable")[:k]}
    got = quality.op1_quality_classifier(spark, sf).collect()
    assert {r.doc_id for r in got if r.selected} == want and 0 < k < len(u)
    # The noise decides near the cut: the draw isn't a plain threshold.
    assert len(quality.resample(docs, labels, k=20).filter("selected").collect()) == 20

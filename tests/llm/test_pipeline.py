"""Every stage on its own input against the brute-force versions of its operator."""

import numpy as np
import public_tokenizers
import tokenizers

import corpus_pipeline
from tilewright.llm import common, packing, quality

from . import test_line_dedup, test_ngram_join


def test_stages(spark, sf):
    docs = common.read_table(spark, sf, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = common.save(stage(spark, docs, sf))
        kept.append((name, before, docs.collect()))
        assert name == "best-fit packing" or docs.columns == columns

    _, before, after = kept[0]
    labels = common.read_table(spark, sf, "labels")
    drawn = {r.doc_id for r in quality.resample(spark.createDataFrame(before), labels).filter("selected").collect()}
    assert {r.doc_id for r in after} == drawn and len(after) < len(before)
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good & drawn) >= 0.95 * len(good)

    _, before, after = kept[1]
    gone = test_line_dedup.brute(before, least=1)
    want = {}
    for r in before:
        text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in gone.get(r.doc_id, ()))
        if r.doc_id not in gone or text.strip(" \t\n\x0b\f\r"):
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in after} == want and gone

    _, before, after = kept[2]
    assert {r.doc_id for r in after} == {c for _, c, _ in test_ngram_join.brute(before)}

    _, before, after = kept[3]
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = sorted((r.doc_id, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in before)
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert sorted(got.items()) == n
    assert len({r.sequence_id for r in after}) <= 1.05 * np.ceil(sum(x for _, x in n) / 4096) + 1


def test_awkward_rows_pass_through_every_stage(spark, awkward, sf):
    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf))
        assert docs.columns == awkward.columns
    assert packing.pack_documents(docs).count() >= docs.count()


def test_empty_documents_pass_through_every_stage(spark, awkward, sf):
    docs = awkward.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.save(stage(spark, docs, sf))
        assert docs.count() == 0

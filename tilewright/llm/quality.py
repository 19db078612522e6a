"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams, one of the target (documents labelled good) and one of the raw corpus
(all documents), give each text the log of the ratio of its probabilities. Gumbel noise on that log weight and the
top k of the sums draw k documents without replacement in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, hashing


@dataclass(frozen=True)
class Settings:
    """buckets: hashed n-grams are counted in so many, which bounds the model. labelled: most labelled rows used to
    learn the target and k, those of the smallest hashes of doc_id; a quarter of them is held out of the target and
    sets k. mercy: how much worse it is to lose a good text than to keep a bad one, as shares of their classes. ngram:
    longest run of words. smoothing: counts added to each bucket of both models."""

    buckets: int = 1 << 15
    ngram: int = 2
    labelled: int = 20_000
    mercy: float = 3.0
    smoothing: float = 5.0
    seed: int = 17


def features(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, text by text for each n, and the number of the text it belongs to."""
    words, counts = hashing.word_hashes(texts, lower=False)
    buckets, rows = [], []
    for n in range(1, settings.ngram + 1):
        hashes, sizes = hashing.grams(words, counts, n)
        buckets.append((hashes % np.uint64(settings.buckets)).astype(np.int64))
        rows.append(np.repeat(np.arange(len(texts)), sizes))
    return np.concatenate(buckets), np.concatenate(rows)


def counted(settings: Settings):
    """mapInArrow function: (target, bucket, n) of a partition, a row for each bucket in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, settings.buckets), np.int64)
        for batch in common.slices(batches, most=1 << 20):
            buckets, rows = features(batch.column("text").to_pylist(), settings)
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            total[0] += np.bincount(buckets, minlength=settings.buckets)
            total[1] += np.bincount(buckets[good[rows]], minlength=settings.buckets)
        target, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"target": pa.array(target, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(total[target, bucket])})

    return run


def labelled_sample(labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, good, held_out: at most settings.labelled rows. A document with several labels is good if all of them are."""
    rows = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    rows = rows.withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(4)) == 0)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.labelled)


@dataclass
class Model:
    """log_ratio of each bucket."""

    log_ratio: np.ndarray
    settings: Settings

    def weigh(self) -> Column:
        """struct<n_features, log_weight> of text: log_weight is the log of the ratio of its probabilities."""
        log_ratio, settings = self.log_ratio, self.settings

        @F.pandas_udf("n_features long, log_weight double")
        def weigh(texts: pd.Series) -> pd.DataFrame:
            n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            texts = texts.fillna("").tolist()
            sizes = np.cumsum([*map(len, texts)])
            for part in np.split(np.arange(len(texts)), np.searchsorted(sizes, np.arange(1 << 20, sizes[-1] if len(sizes) else 0, 1 << 20))):
                if len(part):
                    buckets, rows = features([texts[i] for i in part], settings)
                    n[part] = np.bincount(rows, minlength=len(part))
                    total[part] = np.bincount(rows, log_ratio[buckets], minlength=len(part))
            return pd.DataFrame({"n_features": n, "log_weight": total})

        return weigh(F.col("text"))

    def key(self, weight: Column) -> Column:
        """The log weight with Gumbel noise from a hash of doc_id; texts without words are below all."""
        u = (F.pmod(F.xxhash64("doc_id", F.lit(self.settings.seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        gumbel = -F.log(-F.log(u))
        return F.when(weight["n_features"] > 0, weight["log_weight"] + gumbel).otherwise(F.lit(float("-inf")))


def best_cut(keys: np.ndarray, good: np.ndarray, mercy: float) -> float | None:
    """Where good and bad part best (share of bad below less mercy times the share of good), in the middle of the gap.

    None when either class is missing.
    """
    if good.all() or not good.any():
        return None
    order = np.argsort(keys, kind="stable")
    keys, good = keys[order], good[order]
    below_good, below_bad = np.cumsum(good) / good.sum(), np.cumsum(~good) / (~good).sum()
    gain = below_bad - mercy * below_good
    at = int(np.argmax(gain))
    if gain[at] <= 0:
        return None
    if not np.isfinite(keys[at]):
        return float(keys[at + 1]) if at + 1 < len(keys) else None
    return float((keys[at] + keys[min(at + 1, len(keys) - 1)]) / 2)


def fit(documents: DataFrame, sample: DataFrame, settings: Settings = Settings()) -> Model:
    """Counts over all documents for the raw model, over the good of a labelled_sample() that aren't held out for the target."""
    # The sample has settings.labelled rows at most, which bounds the broadcast.
    marked = common.texts(documents).join(F.broadcast(sample), "doc_id", "left")
    counts = marked.select("text", F.coalesce(F.col("good") & ~F.col("held_out"), F.lit(False)).alias("good")).mapInArrow(common.task(counted(settings)), "target int, bucket int, n long")
    total = np.zeros((2, settings.buckets))
    for r in counts.groupBy("target", "bucket").agg(F.sum("n").alias("n")).collect():  # 2 x buckets rows at most
        total[r.target, r.bucket] = r.n
    # Target against raw counts brought to the target's size; few counts say little, so both lean towards equal.
    expected = total[0] * total[1].sum() / max(total[0].sum(), 1)
    log_ratio = np.log((total[1] + settings.smoothing) / (expected + settings.smoothing))
    if not total[1].any():
        log_ratio[:] = 0
    return Model(log_ratio, settings)


def wanted(scored: DataFrame, sample: DataFrame, mercy: float) -> int | None:
    """k: how many documents have a log weight where, by the labels, good ones are. None without both classes.

    Bad texts are no part of the target, so all of them are fresh to it; of the good only those held out.
    """
    fresh = scored.join(F.broadcast(sample.filter("held_out or not good")), "doc_id").filter("n_features > 0")
    found = fresh.groupBy("good", "log_weight").count().collect()  # the sample's rows at most
    if not found:
        return None
    weights, good, n = (np.array([r[c] for r in found]) for c in ("log_weight", "good", "count"))
    cut = best_cut(np.repeat(weights, n), np.repeat(good, n).astype(bool), mercy)
    return None if cut is None else scored.filter((F.col("n_features") > 0) & (F.col("log_weight") >= cut)).count()


def top_k_cut(keys: DataFrame, k: int, bins: int = 1024, rounds: int = 12) -> float:
    """The k-th largest finite value of column key, found by counting in ever narrower bins, never by one big sort.

    After the last round, or when a bin holds one value, its lower edge stands for it.
    """
    keys = keys.filter(F.col("key") > float("-inf"))
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if n <= k:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0
    for _ in range(rounds):
        if high <= low:
            break
        width = (high - low) / bins
        edges = low + width * np.arange(bins + 1)
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1)).cast("int")
        inside = keys.filter(F.col("key").between(low, high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for r in sorted(inside.collect(), key=lambda r: -r.bin):
            if above + r.n >= k:
                low, high = r.low, r.high
                break
            above += r.n
    return float(low)


def drawn(documents: DataFrame, labels: DataFrame, k: int | None, settings: Settings) -> tuple[Model, DataFrame, float]:
    """The model, the table doc_id, n_features, log_weight, key of all documents, and the k-th largest key."""
    sample = common.save(labelled_sample(labels, settings))
    model = fit(documents, sample, settings)
    weighed = common.texts(documents).select("doc_id", model.weigh().alias("w"))
    scored = common.save(weighed.select("doc_id", "w.n_features", "w.log_weight", model.key(F.col("w")).alias("key")))
    k = wanted(scored, sample, settings.mercy) if k is None else k
    cut = float("-inf") if k is None else top_k_cut(scored, k)
    common.discard(sample)
    return model, scored, cut


def resample(documents: DataFrame, labels: DataFrame, k: int | None = None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, log_weight, key, selected for every row.

    selected: among the k of largest key, the log weight plus Gumbel noise; so k documents are drawn without
    replacement in proportion to their weights. With k None the labels set k (see wanted()). Null, empty and blank
    texts have no features and are not drawn; without both classes among the labels every other text is. Texts of any
    length count whole. Repeated rows share key and fate; rows that tie with the k-th are all drawn. An empty table
    gives no rows. Other columns, whatever their names, stay behind.
    """
    _, scored, cut = drawn(documents, labels, k, settings)
    return scored.withColumn("selected", (F.col("key") >= F.lit(cut)) & (F.col("n_features") > 0))


def keep_drawn(documents: DataFrame, labels: DataFrame, k: int | None = None, settings: Settings = Settings()) -> DataFrame:
    """The rows of documents, with all their columns, that resample() selects. Keys are worked out again: the same
    text and doc_id give the same key, and no text meets a table of keys."""
    model, scored, cut = drawn(documents, labels, k, settings)
    common.discard(scored)
    weight = model.weigh()
    # The noise is at most -log(-log(1 - 2**-53)), about 36.8, so -inf keys never reach a finite cut.
    return documents.filter((weight["n_features"] > 0) & (model.key(weight) >= F.lit(cut)))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))

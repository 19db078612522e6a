"""Token counts of a score-ranked piece vocabulary, by rank-synchronous array merging.

Texts fall into pre-tokens; the new ones of a batch lie in one ragged array of symbols, and each round every
pre-token applies its own lowest-rank pair at the same time. The symbols that survive are the tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common

#: The vocabulary writes a space as this sign; here every text keeps plain spaces, and the sign counts as one.
SIGN, SPACE = "▁", " "


class PieceCounter:
    """Counts for one vocabulary. Symbols are code points until they merge, then numbers from 1 << 21 on."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        score = {sp.id_to_piece(i).replace(SIGN, SPACE): sp.get_score(i) for i in range(sp.get_piece_size()) if not special(i)}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        whole = [p for p in score if len(p) > 1]
        symbol = {p: (1 << 21) + i for i, p in enumerate(whole)} | {p: ord(p) for p in score if len(p) == 1}
        known = {*symbol} | {c for p in whole for c in p}
        sym = lambda p: symbol[p] if p in symbol else ord(p)
        pairs = [(sym(p[:i]), sym(p[i:]), order[score[p]], symbol[p]) for p in whole for i in range(1, len(p)) if p[:i] in known and p[i:] in known]
        self.merger = bpe.Merger(bpe.Pairs.of(*zip(*pairs)))
        self.single = np.array(sorted(ord(p) for p in score if len(p) == 1), np.int64)
        self.counts: dict[str, int] = {}
        self.held = 0
        # A character that no longer piece holds merges with nothing, so a text may be cut at it.
        inner = {c for p in whole for c in p}
        cut = "".join(c for c in "\n\r\t" if c not in inner)
        if any(SPACE in p.lstrip(SPACE) for p in whole):
            raise ValueError("a piece goes on past a space; texts can't be split there")
        self.word = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" + (f"|[{cut}]" if cut else ""))

    def words(self, text: str) -> list[str]:
        return self.word.findall(SPACE + text.replace(SIGN, SPACE)) if text else []

    def learn(self, words: list[str]) -> None:
        """Counts of pre-tokens not met yet."""
        if not words:
            return
        symbols = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.held += 4 * len(symbols) + bpe.ENTRY * len(words)
        symbols, sizes = self.merger.merge(symbols, sizes)
        # Unmerged characters outside the vocabulary fall back to their UTF-8 bytes.
        at = np.minimum(np.searchsorted(self.single, symbols), len(self.single) - 1)
        bytes_of = 1 + (symbols > 0x7F) + (symbols > 0x7FF) + (symbols > 0xFFFF)
        tokens = np.where((symbols >= 1 << 21) | (self.single[at] == symbols), 1, bytes_of)
        ends = np.concatenate(([0], np.cumsum(tokens)))[np.concatenate(([0], np.cumsum(sizes)))]
        self.counts.update(zip(words, np.diff(ends).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        split = [self.words(t) for t in texts]
        if self.held > bpe.KEPT:
            self.counts.clear()
            self.held = 0
        self.learn(list(set().union(*split) - self.counts.keys()))
        return [sum(map(self.counts.__getitem__, words)) for words in split]


def counted(model_file: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counter = PieceCounter(model_file or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in common.slices(batches):
            n = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(documents: DataFrame, limit: int = 4096, model_file: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row: whole texts, no begin or end tokens.

    Null and empty texts have 0 tokens, texts of any length count whole. Repeated rows are counted each; a null doc_id
    is carried along. An empty table gives no rows. Other columns, whatever their names, stay behind.
    """
    rows = common.texts(documents)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.octet_length("text").cast("long").alias("n_bytes"))
    out = rows.mapInArrow(common.task(counted(model_file)), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.read_table(spark, sf_dir, "documents"))

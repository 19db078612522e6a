"""Fill-in-middle transformation by lookaround splitting.

A grammar of units is translated into one zero-width regex: the pairs of neighbouring character classes between which
a unit ends, each as a lookbehind and a lookahead. Splitting there keeps every character, so the units of a text put
together are the text. Everything is expressions of one projection: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY = "(?s:.)"


@dataclass(frozen=True)
class Grammar:
    """Units as pairs of classes: a unit ends between a character of the first and one of the second."""

    ends: tuple[tuple[str, str], ...]

    @classmethod
    def each(cls) -> Grammar:
        """Every code point is a unit."""
        return cls(((ANY, ANY),))

    @classmethod
    def closed(cls, by: str) -> Grammar:
        """A unit ends with the first character of a class: lines with their feeds."""
        return cls(((by, ANY),))

    @classmethod
    def trailed(cls, head: str, tail: str) -> Grammar:
        """A unit is a run of head characters with the tail characters after it: words with the space after them."""
        return cls(((tail, head),))

    @classmethod
    def runs(cls, *classes: str) -> Grammar:
        """A unit is a run of one class: words, spaces and signs apart."""
        return cls(tuple((a, b) for a in classes for b in classes if a != b))

    def boundary(self) -> str:
        return "|".join(f"(?<={a})(?={b})" for a, b in self.ends)


GRAMMARS = {
    "code points": Grammar.each(),
    "words": Grammar.trailed(r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"),
    "lines": Grammar.closed(r"\n"),
    "runs": Grammar.runs(r"[\p{L}\p{M}\p{N}]", r"[\x20\x09-\x0D]", r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"),
}


def units(text: Column, grammar: Grammar) -> Column:
    """The units of a text in order; an empty text has none. Regexes match code points, never halves of them."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, grammar.boundary(), -1))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the seed and the id, the same wherever they are worked out."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(documents: DataFrame, grammar: Grammar | str = "code points", seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """doc_id, text, n (units), form, prefix, middle, suffix (null if plain) and output for every row.

    Two draws by id choose where prefix and middle end, each from 0 to n units; rate of 100 ids are transformed, spm of
    100 of those with the suffix first. Texts that are empty or hold one of MARKS stay plain, and so does the rest.
    A null text counts as empty, a null id draws as an empty one; repeated rows come out alike, texts of any length
    are taken whole, an empty table gives no rows, and other columns, whatever their names, stay behind.
    """
    grammar = GRAMMARS[grammar] if isinstance(grammar, str) else grammar
    rows = common.texts(documents).withColumn("units", units(F.col("text"), grammar))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    n = F.size("units")
    held = F.lit(False)
    for mark in MARKS:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (h3 % 100 >= rate)
    rows = rows.select(
        "doc_id", "text", "units", n.cast("long").alias("n"),
        F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm").alias("form"),
        F.least(h1 % (n + 1), h2 % (n + 1)).cast("int").alias("a"), F.greatest(h1 % (n + 1), h2 % (n + 1)).cast("int").alias("b"),
    )
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("units", start, length), ""))
    rows = rows.select(
        "doc_id", "text", "n", "form", part(F.lit(1), F.col("a")).alias("prefix"),
        part(F.col("a") + 1, F.col("b") - F.col("a")).alias("middle"), part(F.col("b") + 1, F.col("n").cast("int") - F.col("b")).alias("suffix"),
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm_ = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return rows.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm_))


def restored(rows: DataFrame) -> DataFrame:
    """Adds the text that output was made from. Its parts hold no mark, nor can one arise where they meet."""
    parts = F.split("output", "|".join(MARKS), -1)
    psm, spm = (F.concat(*(F.get("parts", F.lit(k)) for k in order)) for order in ((1, 3, 2), (2, 3, 1)))
    rows = rows.withColumn("parts", F.when(F.col("form") != "plain", parts))
    return rows.withColumn("restored", F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", psm).otherwise(spm)).drop("parts")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored(fill_in_middle(common.read_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), h AS (
    SELECT doc_id, t, n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d
), c AS (
    SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM h
), p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

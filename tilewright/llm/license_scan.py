"""License scans with ordered signature rules, in DataFrame expressions only.

Each text passes once: its keywords are looked up as plain substrings, the rules whose keywords are all there are
tried as regular expressions, every match becomes an interval, and intervals that lie inside one of the same or a
better priority are suppressed. One projection, no join and no shuffle, whatever the size of the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .license_rules import Rule, rules

HITS = "array<struct<start:int,minus_end:int,priority:int,place:int,label:string,weight:double>>"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases of whole words and their labels, with the weight that one gives a text.
PHRASES = {"cc by": ("cc-by", 0.8), "general public license": ("gpl", 0.8), "all rights reserved": ("reserved", 0.5)}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once a row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans(text: Column, rule: Column) -> Column:
    """Every match of the rule: what lies between matches gives their places."""

    def walk(found, between):
        def step(acc, i):
            start = acc["at"] + F.length(F.get(between, i))
            hit = lambda end: F.struct(
                start.alias("start"),
                (-end).alias("minus_end"),
                rule["priority"].alias("priority"),
                rule["place"].alias("place"),
                rule["label"].alias("label"),
                rule["weight"].alias("weight"),
            )
            return let(start + F.length(F.get(found, i)), lambda end: F.struct(end.alias("at"), F.concat(acc["hits"], F.array(hit(end))).alias("hits")))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast(HITS).alias("hits"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), empty, step, lambda acc: acc["hits"])

    return F.when(
        F.rlike(text, rule["pattern"]),
        let(
            F.struct(F.regexp_extract_all(text, rule["pattern"], F.lit(0)).alias("found"), F.split(text, rule["pattern"], -1).alias("between")),
            lambda m: walk(m["found"], m["between"]),
        ),
    ).otherwise(F.array().cast(HITS))


def unsuppressed(hits: Column, priorities: int) -> Column:
    """Of hits in order of start, longest first: those outside every earlier one of the same or a better priority."""

    def step(acc, hit):
        outside = ~F.exists(F.slice(acc["ends"], 1, hit["priority"]), lambda end: end >= -hit["minus_end"])
        grown = F.transform(
            acc["ends"],
            lambda end, i: F.when(i == hit["priority"] - 1, F.greatest(end, -hit["minus_end"])).otherwise(end),
        )
        return F.when(outside, F.struct(F.concat(acc["kept"], F.array(hit)).alias("kept"), grown.alias("ends"))).otherwise(acc)

    start = F.struct(F.array().cast(HITS).alias("kept"), F.array_repeat(F.lit(-1), priorities).alias("ends"))
    return F.aggregate(hits, start, step, lambda acc: acc["kept"])


def places(words: Column, phrase: str) -> Column:
    """Where the words of the phrase stand one after another."""
    parts = phrase.split(" ")

    def here(i):
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + k) == part)
        return test

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), here)


def license_scan(documents: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the detections for every row.

    detections: array of start and end (characters of the text), priority, label and weight, after suppression.
    Null counts as empty; a text without a hit has n_base 0, null words, empty labels and score 0. Texts of any length
    are read whole. Repeated rows come out each; a null doc_id is carried along. An empty table gives no rows. Other
    columns, whatever their names, stay behind.
    """
    signatures = rules() if signatures is None else signatures
    priorities = max(r.priority for r in signatures)
    keywords = sorted({w for r in signatures for w in r.keyword.split(" ")})
    table = [r._asdict() | {"place": i, "keywords": r.keyword.split(" ")} for i, r in enumerate(signatures)]
    kind = "array<struct<label:string,priority:int,weight:double,place:int,pattern:string,keywords:array<string>>>"
    table = F.from_json(F.lit(json.dumps(table)), kind)
    rows = common.texts(documents).select("doc_id", common.lower_az(F.col("text")).alias("text"))

    text, has = F.col("text"), lambda w: F.contains(F.col("text"), F.lit(w))
    gate = F.lit(False)
    for phrase in PHRASES:
        both = F.lit(True)
        for word in phrase.split(" "):
            both = both & has(word)
        gate = gate | both
    words = F.when(gate, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).otherwise(F.array().cast("array<string>"))
    present = F.filter(F.from_json(F.lit(json.dumps(keywords)), "array<string>"), lambda k: F.contains(text, k))
    tried = let(present, lambda p: F.filter(table, lambda r: F.forall(r["keywords"], lambda w: F.array_contains(p, w))))
    hits = F.flatten(F.transform(tried, lambda r: spans(text, r)))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), words.alias("words"), hits.alias("hits"))

    by_phrase = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(weight).alias("weight"), places(F.col("words"), p).alias("at")) for p, (label, weight) in PHRASES.items()])
    base = F.when(F.size("words") > 0, F.filter(by_phrase, lambda b: F.size(b["at"]) > 0)).otherwise(F.slice(by_phrase, 1, 0))
    kept = F.when(F.size("hits") > 0, unsuppressed(F.array_sort("hits"), priorities)).otherwise(F.col("hits"))
    rows = rows.select("doc_id", "n_words", base.alias("base"), kept.alias("hits"))
    at = F.flatten(F.transform("base", lambda b: b["at"]))
    base_labels = F.transform("base", lambda b: b["label"])
    weights = F.concat(F.transform("base", lambda b: b["weight"]), F.transform("hits", lambda h: h["weight"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.transform("hits", lambda h: h["label"]))), ",").alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.transform(
            "hits",
            lambda h: F.struct(
                h["start"].alias("start"), (-h["minus_end"]).alias("end"), h["priority"].alias("priority"), h["label"].alias("label"), h["weight"].alias("weight")
            ),
        ).alias("detections"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(common.read_table(spark, sf_dir, "documents")).drop("detections")

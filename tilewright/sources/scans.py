"""What imports read."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .hadoop import Files

OSM_PARTS = ("node", "way", "relation")


def scan(spark: SparkSession, pattern: str | list[str], schema: StructType | str | None = None, required: bool = True) -> DataFrame:
    """Parquet by glob or by a list of globs. Without a match: FileNotFoundError, or an empty table of the schema."""
    patterns = [pattern] if isinstance(pattern, str) else pattern
    found = [path for p in patterns for path in Files(spark).matching(p)]
    if not found:
        if required or schema is None:
            raise FileNotFoundError(f"nothing matches {pattern}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*found)


def osm_parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, ways and relations from root/type=node and so on."""
    node, way, relation = (scan(spark, f"{root.rstrip('/')}/type={t}") for t in OSM_PARTS)
    return node, way, relation


def newest_release(spark: SparkSession, *patterns: str) -> list[str]:
    """Patterns with the one path segment "*" replaced by the newest name for which all of them match something."""
    files = Files(spark)
    heads = {p.split("/*/")[0] for p in patterns}
    if len(heads) != 1 or any("/*/" not in p for p in patterns):
        raise ValueError("the patterns must share what stands before /*/")
    for name in reversed(files.names(heads.pop())):
        pinned = [p.replace("/*/", f"/{name}/", 1) for p in patterns]
        if all(files.matching(p) for p in pinned):
            return pinned
    raise RuntimeError(f"no release has all of {patterns}")


def text_keys(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by partitions of quadkey text: "0123" must not turn into the number 123."""
    name, before = "spark.sql.sources.partitionColumnTypeInference.enabled", None
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(name, before)


def schemas(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Schema documents by their id: every .json file of a folder, a few dozen; those without an id are left out."""
    files = Files(spark)
    found = [json.loads(files.read_text(f"{folder}/{name}")) for name in files.names(folder) if name.endswith(".json")]
    return {d["id"]: d for d in found if "id" in d}


def execute(spark: SparkSession, query: str, parameters: dict) -> DataFrame:
    """SQL with those of the parameters that it names as :name."""
    named = set(re.findall(r"(?<![:\w]):([A-Za-z_]\w*)", query))
    return spark.sql(query, args={k: v for k, v in parameters.items() if k in named})

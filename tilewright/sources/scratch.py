"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder set on the context; in local mode without either, one made now."""
    if path := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return path
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tilewright-"))
    return spark.sparkContext.getCheckpointDir()


def saved(frame: DataFrame) -> DataFrame:
    """frame as a table: worked out once however often it is read, and safe from lost executors."""
    path, schema = f"{folder(frame.sparkSession)}/tilewright-{uuid.uuid4().hex}", frame.schema
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(schema).parquet(path)

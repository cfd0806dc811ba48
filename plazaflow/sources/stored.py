"""Tables written to the shared folder that the cluster names in spark.checkpoint.dir, to cut lineage."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def place(spark: SparkSession) -> str:
    """A new path below the shared folder. Only a session in one process may do without the setting; it uses the warehouse folder."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(top or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/kept-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it again."""
    spark, path = df.sparkSession, place(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

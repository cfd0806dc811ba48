"""Tables written to the shared folder that the cluster names in spark.checkpoint.dir: they cut lineage and survive lost executors.

Results that are read lazily still need their tables, so a folder goes when the driver's Python ends, not before; what is known to be
over can be dropped earlier.
"""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A folder of its own below the shared one. Only a session in one process may do without the setting; it uses the warehouse folder."""

    def __init__(self, spark: SparkSession):
        top = spark.conf.get("spark.checkpoint.dir", None)
        if not top and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = top or spark.conf.get("spark.sql.warehouse.dir")
        self.spark, self.at = spark, f"{top.rstrip('/')}/scratch-{uuid.uuid4().hex}"
        atexit.register(self.close)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and reads it again."""
        path = f"{self.at}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Deletes a table that nothing needs any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Deletes the folder, if the session still runs."""
        if self.spark.sparkContext._jsc is not None:
            self.drop("")

"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="pacewright-")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only where none is set and all tasks run in this process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found or _own_folder()


class Scratch:
    """Tables of one run. ``save`` cuts the lineage: a lost executor costs a reread, not the steps before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/pacewright-{uuid.uuid4().hex}"
        self.made = 0

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.made:03d}"
        self.made += 1
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(conf).delete(path, True)

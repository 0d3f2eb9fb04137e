"""Tables, stored intermediates and session settings shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import scratch_folder

# Rows of an Arrow batch. Texts have any length, so batches are kept short.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators count on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str = "_own") -> str:
    """A column name that ``df`` does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


class Scratch:
    """Tables written below the shared folder: cheap to read again, and safe if an executor is lost."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{scratch_folder(spark)}/tidelog-{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written rows."""
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no plan reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

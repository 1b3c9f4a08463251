"""Tables that several branches of one job read: written once to the shared folder, in buckets of their key."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one where it is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


@contextmanager
def exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a job that starts inside as soon as it has ended, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bucketed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows written in one exchange, a file for each bucket of the keys, and read back: groups and windows by the keys need no further
    exchange, and each reader takes its own columns. It also cuts the lineage, so lost executors cost no more than their tasks."""
    spark = df.sparkSession
    name = f"ledgerline_{uuid.uuid4().hex}"
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartition(count, *keys).write.format("parquet").option("path", f"{shared_folder(spark)}/{name}")
    out.bucketBy(count, *keys).sortBy(*keys, *order).saveAsTable(name)
    return spark.table(name)


def written(df: DataFrame) -> DataFrame:
    """The rows written as they stand and read back."""
    path = f"{shared_folder(df.sparkSession)}/ledgerline_{uuid.uuid4().hex}"
    with exchanges_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables written once on the way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset (local runs)."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gridloom-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """A small table kept in the shared folder, its lineage cut: it is made once and survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` as a Parquet table that goes away at the end of the block."""
    path = new_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)

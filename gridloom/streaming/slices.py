"""New slices as they appear: the slice-at-a-time loop as a file stream.

The source has no event-time logic, and neither has this: slices are appended
to a store while a simulation is running and each micro-batch handles the new
ones only. The file sink commits each batch once, so a restarted stream neither
loses nor repeats slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridloom.schema import FIELD_SLICE


def new_slices(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(FIELD_SLICE).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_slices(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived since the last call, then stop."""
    return (
        stream.writeStream.format("parquet").partitionBy("run", "variable")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

"""Slices written to a store and read back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources import scratch, slice_store
from proxies import tables as tb
from proxies.registry import query


def _store(spark: SparkSession, sf: str, dtype: str = "float64") -> str:
    path = scratch.new_path(spark, "store")
    slice_store.write(tb.slices(spark, sf), path, dtype=dtype, file_bytes=16 << 10, staged=False)
    return path


@query(f"""with {tb.SLICES} select run, variable, iteration, time, len(data)::int as points, round(data[1], 6) as first from sl
where variable = 'rho' and iteration in (0, 100, 222, 301, 499)""")
def store_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The file ranges of the manifest decide which files are opened."""
    found = slice_store.lookup(spark, _store(spark, sf), "rho", [0, 100, 222, 301, 499])
    return found.select("run", "variable", "iteration", "time", F.size("data").alias("points"), F.round(F.col("data")[0], 6).alias("first"))


@query(f"""with {tb.SLICES} select run, variable, iteration, row_number() over (partition by run, variable order by iteration) - 1 as position,
  round(data[64]::float::double, 6) as last from sl""")
def store_stream_order(spark: SparkSession, sf: str) -> DataFrame:
    """Places by file ranges and rows in files; arrays kept in single precision."""
    placed = slice_store.numbered(spark, _store(spark, sf, "float32"))
    return placed.select("run", "variable", "iteration", "position", F.round(F.col("data")[63], 6).alias("last"))

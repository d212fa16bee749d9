"""Puncture tracks: six scalar files to one (iteration, time, x, y, z) track per body."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def combine_axes(samples: DataFrame, keys: Sequence[str] = ("run", "restart"), line: str = "line") -> DataFrame:
    """Rows (keys, body, axis, iteration, time, value, line) -> tracks, distinct as whole rows over restarts.

    The three files of a body in one restart are paired by iteration and, where an iteration has several
    rows, by their place in the file (`line`, any type that orders; times and values without it). The x
    file supplies the time. A row that one axis lacks is NULL there.
    """
    own = [*keys, "body", "axis", "iteration"]
    order = [line] if line in samples.columns else ["time", "value"]
    # One shuffle by what window, group and distinct rows have in common.
    near = samples.repartition(*[k for k in keys if k != "restart"], "body", "iteration")
    placed = near.withColumn("_place", F.row_number().over(W.partitionBy(*own).orderBy(*order)))

    def at(axis: str, column: str):
        return F.max(F.when(F.col("axis") == axis, F.col(column)))

    return (
        placed.groupBy(*keys, "body", "iteration", "_place")
        .agg(at("x", "time").alias("time"), *[at(a, "value").alias(a) for a in "xyz"])
        .select(*[k for k in keys if k != "restart"], "body", "iteration", "time", "x", "y", "z")
        .distinct()
    )


def lookup(track: DataFrame, wanted: DataFrame, by: str = "iteration", keys: Sequence[str] = ("run",)) -> DataFrame:
    """Position of both bodies at exactly the wanted iterations or times, first match per body."""
    on = [*keys, by]
    hits = wanted.select(*on).distinct().join(track, on)
    first = hits.groupBy(*on, "body").agg(F.min(F.struct("iteration", "time", "x", "y", "z")).alias("_r"))

    def of(body: int):
        return F.max(F.when(F.col("body") == body, F.col("_r")))

    return first.groupBy(*on).agg(of(0).alias("body0"), of(1).alias("body1"))

"""Work lists: requested variables, task grids and parameter sweeps.

Lists that come from a configuration are literals; they are exploded onto each
row instead of being cross-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import cutoff_periods
from gridloom.operators.ordered import Ordered


def _requested(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(variables)], "seq int, variable string"
    )


def requested_variables(index: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Rows of the requested variables, numbered in configuration order."""
    return index.join(F.broadcast(_requested(index, variables)), "variable")


def skipped_variables(index: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Requested variables without any row."""
    return _requested(index, variables).join(
        index.filter(F.col("variable").isin(list(variables))).select("variable").distinct(), "variable", "left_anti"
    )


def task_grid(iterations: DataFrame, variables: Sequence[str]) -> DataFrame:
    """All (variable, iteration) tasks, iteration fastest, numbered from 0.

    The list of (seq, variable) pairs is a literal, and task numbers are
    seq * count + position.
    """
    o = Ordered.of(iterations.withColumn("_all", F.lit(0)), ["_all"], "iteration").index("_i").count("_n")
    pairs = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(v).alias("variable")) for i, v in enumerate(variables)])
    return (
        o.result().withColumn("_v", F.explode(pairs))
        .select(
            "_v.variable", "iteration",
            (F.col("_v.seq").cast("bigint") * F.col("_n") + F.col("_i")).alias("task"),
        )
    )


def run_cutoffs(runs: DataFrame, periods: Sequence[float] | None = None) -> DataFrame:
    """Every run with every cutoff period."""
    periods = cutoff_periods() if periods is None else periods
    return runs.select("*", F.posexplode(F.array(*[F.lit(float(p)) for p in periods])).alias("cutoff", "period"))

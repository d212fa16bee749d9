"""Join of two sampled series whose grids agree up to a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import KeyStats


def join_on_grid(
    left: DataFrame, right: DataFrame, keys: Sequence[str], x: str, *, tolerance: float, missing: str = "error",
) -> DataFrame:
    """Rows of `left` with the columns of the `right` row of the same keys within `tolerance` of its x.

    Samples meet by buckets of four tolerances: a right row lies in its own bucket and, near an edge, in the one beside it,
    so the join is an equi-join and no key or bucket gathers more than it holds. Right samples must lie more than two
    tolerances apart, which makes the partner unique. `missing`: "error" for a left sample without a partner, "null" to
    keep it, "drop" to leave it out. NULL keys match each other; a NULL or NaN x has no partner.
    """
    if missing not in ("error", "null", "drop"):
        raise ValueError(f"missing must be error, null or drop, not {missing!r}")
    keys, width = list(keys), 4.0 * tolerance
    spaced = Ordered.of(right, keys, x, stats=KeyStats.of(right, keys)).neighbours(_before=f"lag:{x}").result()
    close = F.raise_error(F.lit("samples of a grid lie within two tolerances of each other")).cast("double")
    checked = spaced.withColumn("_x", F.when(F.col(x) - F.col("_before") <= 2 * tolerance, close).otherwise(F.col(x)))

    def bucket(at):
        return F.floor(at / width)

    near = F.array_distinct(F.array(bucket(F.col("_x") - tolerance), bucket(F.col("_x") + tolerance)))
    there = checked.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], "_x", *[c for c in right.columns if c not in (*keys, x)], F.explode(near).alias("_bucket"))
    here = left.withColumn("_own", bucket(F.col(x)))
    on = [F.col("_own") == F.col("_bucket"), F.abs(F.col(x) - F.col("_x")) <= tolerance, *[left[k].eqNullSafe(there[f"_r_{k}"]) for k in keys]]
    joined = here.join(there, on, "inner" if missing == "drop" else "left")
    if missing == "error":
        gone = F.raise_error(F.lit("a sample has no partner on the other grid")).cast("double")
        joined = joined.withColumn(x, F.when(F.col("_x").isNotNull(), F.col(x)).otherwise(gone))
    return joined.drop("_own", "_bucket", "_x", *[f"_r_{k}" for k in keys])

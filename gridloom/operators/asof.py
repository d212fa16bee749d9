"""Forward as-of lookup: for each target the first sample at or after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import broadcast_row_limit, count_up_to, sized


def asof_forward(
    targets: DataFrame,
    samples: DataFrame,
    keys: Sequence[str],
    target: str,
    time: str,
    payload: Sequence[str],
    *,
    clamp: bool = False,
    few_targets: bool = True,
) -> DataFrame:
    """One row per distinct (keys, target) with the payload of the first sample `time >= target`.

    No tolerance; without a hit the payload is NULL, or with `clamp` that of the
    last sample. Among samples at the same time the smallest payload is first.
    Targets and samples with a NULL key or time are left out.

    Few targets (their number is checked unless `few_targets` is False): each sample is dropped into the gap
    between two neighbouring targets with a broadcast lookup and a map-side
    combining minimum per gap remains, so samples are neither sorted nor
    shuffled. Many targets: both sides are ordered together and the next sample
    is carried back over the gaps, segment by segment.
    """
    keys, payload = list(keys), list(payload)
    wanted = targets.select(*keys, F.col(target).alias("_t")).dropna().distinct()
    samples = samples.dropna(subset=[*keys, time])
    hit = F.struct(F.col(time).alias("_time"), *payload)
    limit = broadcast_row_limit(samples)
    n = count_up_to(wanted, limit) if few_targets is not False else limit + 1
    if n <= limit:
        found = _by_gaps(wanted, n, samples, keys, time, hit)
    else:
        found = _by_order(wanted, samples, keys, time, hit)
    if clamp:
        ends = samples.groupBy(*keys).agg(F.max(hit).alias("_last"))
        found = found.join(sized(ends), keys, "left").withColumn(
            "_hit", F.coalesce("_hit", "_last")
        )
    return found.select(
        *keys, F.col("_t").alias(target),
        F.col("_hit._time").alias(time), *[F.col(f"_hit.{p}").alias(p) for p in payload],
    )


def _by_gaps(wanted: DataFrame, n: int, samples: DataFrame, keys: list[str], time: str, hit) -> DataFrame:
    grid = wanted.groupBy(*keys).agg(F.array_sort(F.collect_list("_t")).alias("_grid"))
    # Number of targets <= time, by binary search: `get` is null past the end.
    steps = ",".join(str(1 << b) for b in range(max(n, 1).bit_length() - 1, -1, -1))
    gap = F.expr(f"aggregate(array({steps}), 0, (i, s) -> if(get(_grid, i + s - 1) <= `{time}`, i + s, i))")
    first = (
        samples.join(F.broadcast(grid), keys)
        .withColumn("_gap", gap)
        .filter("_gap > 0")
        .groupBy(*keys, "_gap")
        .agg(F.min(hit).alias("_own"))
    )
    later = W.partitionBy(*keys).orderBy(F.desc("_gap")).rowsBetween(W.unboundedPreceding, W.currentRow)
    spots = grid.select(*keys, F.posexplode("_grid").alias("_p", "_t")).withColumn("_gap", F.col("_p") + 1)
    return (
        spots.join(first, [*keys, "_gap"], "left")
        .withColumn("_hit", F.last("_own", ignorenulls=True).over(later))
        .select(*keys, "_t", "_hit")
    )


def _by_order(wanted: DataFrame, samples: DataFrame, keys: list[str], time: str, hit) -> DataFrame:
    # One row per sample time: ties are combined before they are ordered.
    points = samples.groupBy(*keys, F.col(time).alias("_t")).agg(F.min(hit).alias("_own"))
    both = points.withColumn("_is_target", F.lit(0)).unionByName(
        wanted.withColumn("_own", F.lit(None).cast(points.schema["_own"].dataType)).withColumn("_is_target", F.lit(1))
    )
    # At equal times the target comes first, so the sample is "at or after" it.
    both = both.withColumn("_side", 1 - F.col("_is_target"))
    return (
        Ordered.of(both, keys, "_t", ["_side"]).next_known("_own", "_hit").result()
        .filter("_is_target = 1")
        .select(*keys, "_t", "_hit")
    )


def nearest_in_time(
    targets: DataFrame, samples: DataFrame, keys: Sequence[str], target: str, time: str, payload: Sequence[str]
) -> DataFrame:
    """Forward lookup that falls back to the last sample past the end."""
    return asof_forward(targets, samples, keys, target, time, payload, clamp=True)

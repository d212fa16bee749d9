"""Exact percentiles of groups of any size: the values of given ranks, by narrowing brackets.

A group with at most `small` values is one aggregate. For larger ones a quantile sketch of fixed size per group
brackets each wanted rank; a second pass counts the values below the bracket and keeps those inside, about 3 / STEPS
of the group. That repeats until at most `small` distinct values are left per bracket, which are sorted. All groups narrow at once, the state
per group never grows with it, and what a sketch suggests is checked by counting, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators.skew import is_small, join_keys
from gridloom.sources.scratch import settled

#: Brackets of one pass; the sketch is eight times as fine, so that a rank lies within one bracket of where it is sought.
STEPS = 512
SMALL = 1 << 20


def small_group(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("gridloom.selection.rows", str(SMALL)))


def percentiles(
    values: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], out: str = "percentiles",
    *, small: int | None = None, steps: int = STEPS,
) -> DataFrame:
    """(keys, out ARRAY<DOUBLE>): percentiles of the non-null values of each key, interpolated between ranks.

    `small` defaults to the session's `gridloom.selection.rows`, or SMALL.
    """
    keys, small = list(keys), small or small_group(values)
    rows = values.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    plain = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs])).alias(out)
    big = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > small)
    if big.isEmpty():
        return rows.groupBy(*keys).agg(plain)
    big = settled(big)
    few = is_small(big)
    usual = join_keys(rows, big, keys, "left_anti", broadcast=few).groupBy(*keys).agg(plain)

    places = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array(*[
        F.struct(F.lit(2 * i + side).alias("_j"), near(place).cast("bigint").alias("_rank"))
        for i, place in enumerate(places) for side, near in enumerate((F.floor, F.ceil))
    ])
    ranks = big.select(*keys, "_n", F.explode(wanted).alias("_w")).select(*keys, "_n", "_w.*")
    found = of_rank(join_keys(rows, big.select(*keys), keys, "left_semi", broadcast=few), ranks, keys, small, steps)
    of = lambda j: F.max(F.when(F.col("_j") == j, F.col("_v")))
    sides = found.groupBy(*keys).agg(*[of(j).alias(f"_{j}") for j in range(2 * len(probs))])
    made = join_keys(sides, big, keys, "inner", broadcast=few)

    def between(i: int) -> Column:
        low, high, at = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}"), places[i]
        return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return usual.unionByName(made.select(*keys, F.array(*[between(i) for i in range(len(probs))]).alias(out)))


def of_rank(rows: DataFrame, ranks: DataFrame, keys: Sequence[str], small: int = SMALL, steps: int = STEPS) -> DataFrame:
    """(keys, _j, _v): for each row (keys, _n, _j, _rank) of `ranks` the value at that 0-based rank among the key's `_v`.

    `_n` is the number of the key's values, and _j tells the ranks of a key apart.
    """
    keys = list(keys)
    group, before = keys, None
    while True:
        rows, ranks = _narrowed(rows, ranks, keys, group, steps)
        group = [*keys, "_j"]
        most = ranks.agg(F.max("_n")).first()[0] or 0
        if most <= small or most == before:
            break
        before = most
        # More values than that, but maybe few different ones.
        distinct = rows.groupBy(*group).agg(F.approx_count_distinct("_v", 0.02).alias("_d"))
        if (distinct.agg(F.max("_d")).first()[0] or 0) <= small:
            break
    counted = rows.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*group).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow))
    joined = join_keys(counted.withColumn("_upto", upto), ranks.select(*group, "_rank"), group, "inner", broadcast=is_small(ranks))
    return joined.filter(F.col("_upto") > F.col("_rank")).groupBy(*group).agg(F.min("_v").alias("_v"))


def _narrowed(rows: DataFrame, ranks: DataFrame, keys: list[str], group: list[str], steps: int) -> tuple[DataFrame, DataFrame]:
    """The values in the bracket of each rank, and the ranks counted from the start of their bracket."""
    cuts = rows.groupBy(*group).agg(F.percentile_approx("_v", [i / steps for i in range(1, steps)], 8 * steps).alias("_q"))
    few = is_small(ranks)
    step = F.floor(F.col("_rank") * F.lit(float(steps)) / F.col("_n")).cast("int")
    # Position i of _q (from 0) is the cut at (i + 1) / steps; one step to spare on either side, none beyond the ends.
    bracket = settled(join_keys(ranks, cuts, group, "inner", broadcast=few).select(
        *keys, "_j", "_rank", F.get("_q", step - 2).alias("_a"), F.get("_q", step + 1).alias("_b")))
    marked = join_keys(rows, bracket, group, "inner", broadcast=few) if "_j" in group else join_keys(
        rows, bracket.groupBy(*group).agg(F.collect_list(F.struct("_j", "_rank", "_a", "_b")).alias("_t")), group, "inner", broadcast=few,
    ).select(*keys, "_v", F.explode("_t").alias("_t")).select(*keys, "_v", "_t.*")
    below = F.coalesce(F.col("_v") < F.col("_a"), F.lit(False))
    inside = ~below & F.coalesce(F.col("_v") <= F.col("_b"), F.lit(True))
    counts = marked.groupBy(*keys, "_j", "_rank").agg(F.count_if(below).alias("_below"), F.count_if(inside).alias("_n"))
    rank = F.col("_rank") - F.col("_below")
    sure = F.when((rank >= 0) & (rank < F.col("_n")), rank).otherwise(F.raise_error(F.lit("a rank lies outside its bracket")).cast("bigint"))
    # Kept, so that a pass reads what the last one left and not all passes before it.
    return settled(marked.filter(inside).select(*keys, "_j", "_v")), settled(counts.select(*keys, "_j", "_n", sure.alias("_rank")))

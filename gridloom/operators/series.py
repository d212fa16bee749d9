"""Multi-run time series: merger, alignment, trimming, stitching, normalising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.constants import MILLIS
from gridloom.functions.scalars import finite_or_null, since_merger
from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import KeyStats, attach, heavy_hashes, join_keys, pin


def peak_rank(amp: Column, order: Column, digits: int | None = 15) -> Column:
    """Sort key of a peak: (rounded) amplitude, later sample on ties."""
    return F.struct(F.round(amp, digits) if digits is not None else amp, order)


def merger(
    df: DataFrame, keys: Sequence[str], t: str, amp: str, order: str | None = None, stats: KeyStats | None = None
) -> DataFrame:
    """Per run: time and amplitude of the largest amplitude, run end and sample count.

    Equal peaks (to 15 digits) resolve to the last. The exact maximum comes from
    a plain hash aggregate; rounding and tie-breaking then only see the samples
    next to it. With too many runs to broadcast their maxima, one aggregate does
    both at the price of a local sort. A run without any amplitude has NULL
    merger time and amplitude; a NULL run is a run.
    """
    order = order or t
    stats = stats or KeyStats.of(df, keys)
    rank = peak_rank(F.col(amp), F.col(order))
    peak = F.max_by(F.struct(t, amp), F.when(F.col(amp).isNotNull(), rank)).alias("_m")
    tops = df.groupBy(*keys).agg(F.max(amp).alias("_top"), F.max(t).alias("t_end"), F.count(F.lit(1)).alias("_n"))
    if stats.few:
        tops = pin(tops, stats)
        near = join_keys(df, tops.select(*keys, "_top"), keys, "inner").filter(F.col(amp) >= F.col("_top") - 1e-14)
        found = join_keys(tops, near.groupBy(*keys).agg(peak), keys)
    else:
        found = df.groupBy(*keys).agg(peak, F.max(t).alias("t_end"), F.count(F.lit(1)).alias("_n"))
    return found.select(*keys, F.col(f"_m.{t}").alias("t_merge"), F.col(f"_m.{amp}").alias("amp_merge"), "t_end", "_n")


def common_end(mergers: DataFrame) -> DataFrame:
    """Latest time after merger that every run reaches, as a one-row table."""
    return mergers.agg(F.min(F.col("t_end") - F.col("t_merge")).alias("t_common"))


def align(df: DataFrame, keys: Sequence[str], t: str, amp: str, *, from_merger: bool = True) -> DataFrame:
    """Cut all runs to a common end after merger and shift and scale them to it.

    Adds t_merge, t_ms and amp_norm. The end is exclusive: rows stop before the
    first sample at or past t_common + t_merge, and a run whose last sample falls
    short of that (by rounding) has no end index and yields no rows.
    """
    stats = KeyStats.of(df, keys)
    runs = pin(merger(df, keys, t, amp, stats=stats), stats)
    ends = runs.withColumn("_bound", common_end(runs).scalar() + F.col("t_merge")).filter(
        F.col("t_end") >= F.col("_bound")
    )
    rows = attach(df, ends.select(*keys, "t_merge", "amp_merge", "_bound", "_n"), keys, how="inner", stats=stats)
    keep = F.col(t) < F.col("_bound")
    if from_merger:
        keep = keep & (F.col(t) >= F.col("t_merge"))
    return (
        rows.filter(keep)
        .withColumn("t_ms", since_merger(t, "t_merge"))
        .withColumn("amp_norm", F.try_divide(F.col(amp), F.col("amp_merge")))
        .drop("_bound", "amp_merge")
    )


def event_window(
    df: DataFrame, keys: Sequence[str], t: str, amp: str, *, before: int, stop: str | None = None
) -> DataFrame:
    """Rows from `before` samples ahead of the merger to the end, with index `idx`.

    A start before the first sample is clamped to it. `stop` names a column
    holding an exclusive end time per row's run.
    """
    stats = KeyStats.of(df, keys)
    indexed = Ordered.of(df, keys, t, stats=stats).index("idx").result()
    at = indexed.groupBy(*keys).agg(
        F.max_by("idx", peak_rank(F.col(amp), F.col("idx"))).alias("idx_merge"), F.count(F.lit(1)).alias("_n")
    )
    rows = attach(indexed, at, keys, how="inner", stats=stats).filter(
        F.col("idx") >= F.greatest(F.col("idx_merge") - before, F.lit(0))
    )
    return rows if stop is None else rows.filter(F.col(t) < F.col(stop))


def first_restart_wins(
    df: DataFrame, keys: Sequence[str], at: str, restart: str
) -> DataFrame:
    """Stitch restarts: drop rows whose `at` an earlier restart of the run already holds.

    Duplicates inside one restart survive, rows without a restart do not; NULL keys are
    values like others. `at` is the iteration for scalars and the time for volume integrals.
    """
    full = [*keys, at]

    def kept(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(restart) == F.col("_first")).drop("_first")

    first = F.min(restart)
    heavy = heavy_hashes(df, full)
    if not heavy:
        return kept(df.withColumn("_first", first.over(W.partitionBy(*full))))
    # Heavily repeated keys are few: their first restart is aggregated and
    # broadcast, so their rows are not gathered anywhere.
    is_heavy = F.xxhash64(*full).isin(heavy)
    hot = df.filter(is_heavy)
    firsts = hot.groupBy(*full).agg(first.alias("_first"))
    light = df.filter(~is_heavy).withColumn("_first", first.over(W.partitionBy(*full)))
    return kept(light).unionByName(kept(join_keys(hot, firsts, full, "inner")).select(*df.columns))


def normalise_by_first(df: DataFrame, keys: Sequence[str], t: str, value: str, out: str) -> DataFrame:
    """value / value at the run's first sample."""
    firsts = df.groupBy(*keys).agg(F.min_by(value, t).alias("_y0"), F.count(F.lit(1)).alias("_n"))
    return attach(df, firsts, keys).withColumn(out, F.try_divide(F.col(value), F.col("_y0"))).drop("_y0")


def remove_mean(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], stats: KeyStats | None = None
) -> DataFrame:
    """Subtract each run's mean in place."""
    means = df.groupBy(*keys).agg(
        *[F.avg(v).alias(f"_mean_{v}") for v in values], F.count(F.lit(1)).alias("_n")
    )
    out = attach(df, means, keys, stats=stats)
    return out.withColumns({v: F.col(v) - F.col(f"_mean_{v}") for v in values}).drop(
        *[f"_mean_{v}" for v in values]
    )


def relative_to(df: DataFrame, run: str, baseline: str, at: Sequence[str], value: str, out: str = "rel") -> DataFrame:
    """(value - baseline value) / baseline value at the same position."""
    base = df.filter(F.col(run) == baseline).select(*at, F.col(value).alias("_base"))
    return (
        df.join(base, list(at))
        .withColumn(out, F.try_divide(F.col(value) - F.col("_base"), F.col("_base")))
        .drop("_base")
    )


def reduce_grid(cells: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Maximum and minimum over the grid, ignoring non-finite cells."""
    v = finite_or_null(value)
    return cells.groupBy(*keys).agg(F.max(v).alias("v_max"), F.min(v).alias("v_min"))


def cumulative_integral(
    df: DataFrame, keys: Sequence[str], t: str, flux: str, out: str, stats: KeyStats | None = None
) -> DataFrame:
    """Running trapezoid integral of `flux`, 0 at the run's first sample."""
    o = Ordered.of(df, keys, t, stats=stats).neighbours(_pt=f"lag:{t}", _pf=f"lag:{flux}")
    piece = F.coalesce((F.col(t) - F.col("_pt")) * (F.col(flux) + F.col("_pf")) / 2, F.lit(0.0))
    return o.running_sum(piece, out).result().drop("_pt", "_pf")


def merge_volume_families(short: DataFrame, long: DataFrame) -> DataFrame:
    """Union of the 8- and the 11-column volume tables; the short one gets NULLs."""
    return short.unionByName(long, allowMissingColumns=True)


def in_milliseconds(df: DataFrame, t: str = "t", t_merge: str = "t_merge", unit: float = MILLIS) -> DataFrame:
    return df.withColumn("t_ms", since_merger(t, t_merge, unit))

"""Exact algebra of index boxes: what a set of n-dimensional boxes covers, once, and what it leaves blank.

A box is a row with half-open bounds lo_0, hi_0, lo_1, ... The sweep takes one axis after the other: boxes
are cut at all bounds that occur on the axis, which makes slabs, and each slab is swept along the next axis
by itself. On the last axis only sums of starts and ends are left. Bounds are numbered and joined by
value, so no boxes are compared with one another, and numbering and sums are windows that split hot keys.
A box makes one row per slab that it spans. Tables between the steps, bounds only, are kept in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import join_keys
from gridloom.sources.scratch import settled


def bounds(chunks: DataFrame, keys: Sequence[str], n: int, off: str = "off", ext: str = "ext") -> DataFrame:
    """Boxes of the chunks with n axes, slowest axis first; others are left out."""
    at = [(F.col(off)[a].cast("bigint"), F.col(ext)[a].cast("bigint")) for a in range(n)]
    return chunks.filter((F.size(off) == n) & (F.size(ext) == n)).select(
        *keys, *[c.alias(name) for a, (o, e) in enumerate(at) for name, c in ((f"lo_{a}", o), (f"hi_{a}", o + e))]
    )


def _axes(boxes: DataFrame) -> int:
    n = 0
    while f"lo_{n}" in boxes.columns:
        n += 1
    if not n:
        raise ValueError("boxes need columns lo_0 and hi_0")
    return n


def _slabs(rows: DataFrame, group: list[str], a: int) -> DataFrame:
    """Cut along axis a at all bounds of the group: lo_a and hi_a become those of the slab."""
    lo, hi = f"lo_{a}", f"hi_{a}"
    marks = settled(rows.select(*group, F.explode(F.array(lo, hi)).alias("_at")).distinct())
    known = settled(Ordered.of(marks, group, "_at").index("_k").neighbours(_next="lead:_at").result())
    first = known.select(*group, F.col("_at").alias(lo), F.col("_k").alias("_k0"))
    last = known.select(*group, F.col("_at").alias(hi), F.col("_k").alias("_k1"))
    # Tables of bounds grow with the boxes, so they are joined by a shuffle unless Spark finds them small.
    cut = join_keys(join_keys(rows, first, [*group, lo], broadcast=False), last, [*group, hi], broadcast=False)
    cut = cut.drop(lo, hi).withColumn("_k", F.explode(F.sequence("_k0", F.col("_k1") - 1))).drop("_k0", "_k1")
    slab = known.select(*group, "_k", F.col("_at").alias(lo), F.col("_next").alias(hi))
    return join_keys(cut, slab, [*group, "_k"], broadcast=False).drop("_k")


def _joined(rows: DataFrame, keys: list[str], n: int, a: int) -> DataFrame:
    """Boxes that touch along axis a and agree in all else become one."""
    lo, hi = f"lo_{a}", f"hi_{a}"
    rest = [*keys, *[c for b in range(n) if b != a for c in (f"lo_{b}", f"hi_{b}")], "written"]
    o = Ordered.of(rows.select(*rest, lo, hi), rest, lo).neighbours(_before=f"lag:{hi}")
    o = o.running_sum(F.when(F.col("_before") == F.col(lo), 0).otherwise(1).cast("bigint"), "_run")
    return o.result().groupBy(*rest, "_run").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_run")


def decompose(boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint boxes that fill each key's bounding box: rows (keys, lo_0, hi_0, ..., written).

    `written` tells whether a given box lies there. Runs along the last axis are as long as they can be, and
    boxes that agree in all other bounds are joined along each axis, from the last to the first. Empty boxes, and those with
    a bound missing, count for nothing; a key without others has no rows. Repeated boxes count once, NULL keys are a key.
    """
    n, keys = _axes(boxes), list(keys)
    sides = [c for a in range(n) for c in (f"lo_{a}", f"hi_{a}")]
    whole = boxes.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in sides]).filter(" and ".join(f"lo_{a} < hi_{a}" for a in range(n))).distinct()
    frame = whole.groupBy(*keys).agg(*[f(c).alias(c) for a in range(n) for f, c in ((F.min, f"lo_{a}"), (F.max, f"hi_{a}"))])
    # The bounding box weighs nothing: it only makes rows where no box is.
    rows = whole.withColumn("_w", F.lit(1).cast("bigint")).unionByName(frame.withColumn("_w", F.lit(0).cast("bigint")))
    group = list(keys)
    for a in range(n - 1):
        rows = _slabs(settled(rows), group, a)
        group += [f"lo_{a}", f"hi_{a}"]
        # Boxes that a slab has made equal are one; the last axis adds their weights anyhow.
        rows = rows.groupBy(*group, *[c for b in range(a + 1, n) for c in (f"lo_{b}", f"hi_{b}")]).agg(F.max("_w").alias("_w"))
    lo, hi = f"lo_{n - 1}", f"hi_{n - 1}"
    events = settled(
        rows.select(*group, F.explode(F.array(F.struct(F.col(lo).alias("_at"), F.col("_w")), F.struct(F.col(hi).alias("_at"), (-F.col("_w")).alias("_w")))).alias("_e"))
        .select(*group, "_e.*").groupBy(*group, "_at").agg(F.sum("_w").alias("_w"))
    )
    swept = Ordered.of(events, group, "_at").running_sum(F.col("_w"), "_depth").neighbours(_next="lead:_at").result()
    out = swept.filter(F.col("_next").isNotNull()).select(*group, F.col("_at").alias(lo), F.col("_next").alias(hi), (F.col("_depth") > 0).alias("written"))
    # Runs of the last axis: neighbours that are both written, or both not.
    for a in reversed(range(n)):
        out = _joined(settled(out), keys, n, a)
    return out.select(*keys, *sides, "written")


def volume(boxes: DataFrame) -> Column:
    """Points of a box, exact up to 38 digits."""
    out = F.lit(1).cast("decimal(38,0)")
    for a in range(_axes(boxes)):
        out = (out * (F.col(f"hi_{a}") - F.col(f"lo_{a}"))).cast("decimal(38,0)")
    return out


def union_volume(boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, written_points, box_points): points in any box, and in the bounding box."""
    parts = decompose(boxes, keys)
    points = volume(parts)
    return parts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("written"), points)), F.lit(0)).cast("bigint").alias("written_points"), F.sum(points).cast("bigint").alias("box_points"),
    )


def unwritten(boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bounding box less all boxes, as disjoint boxes."""
    return decompose(boxes, keys).filter(~F.col("written")).drop("written")

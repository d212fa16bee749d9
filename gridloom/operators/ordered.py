"""Ordered-sequence operators over (key, order) that never need a key in one task.

Every operator is a window inside (key, segment) plus a correction that carries
the right value across segment borders. Keys below the hot limit have a single
segment, so the correction vanishes and the plan is the plain window. Border
tables hold one row per segment of a hot key, at most skew.MAX_EDGES plus
skew.MAX_HOT rows, which is why they may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.skew import KeyStats, Segments, attach, join_keys


@dataclass(frozen=True)
class Ordered:
    """A DataFrame whose rows are ordered by `order` (then `ties`) within `keys`.

    The ties are completed by all other columns that can be ordered, numbers first, so that
    rows which compare equal are equal and every operator sees one order.
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: str
    ties: tuple[str, ...]
    segments: Segments
    stats: KeyStats

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        ties: Sequence[str] = (),
        stats: KeyStats | None = None,
    ) -> "Ordered":
        """`stats` of a table with the same keys saves counting them again."""
        stats = stats or KeyStats.of(df, keys)
        rest = [f for f in df.schema.fields if f.name not in (*keys, order, *ties) and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
        rest.sort(key=lambda f: not isinstance(f.dataType, T.NumericType))
        full = (*ties, *[f.name for f in rest])
        tie = full[0] if full and isinstance(df.schema[full[0]].dataType, T.NumericType) else None
        segments = Segments.plan(df, keys, order, stats, tie)
        return cls(segments.tag(df), tuple(keys), order, full, segments, stats)

    @property
    def _group(self) -> list[str]:
        return [*self.keys, "_seg"]

    @property
    def _window(self):
        return W.partitionBy(*self._group).orderBy(self.order, *self.ties)

    @property
    def _rank(self) -> Column:
        return F.struct(self.order, *self.ties)

    def _borders(self, **aggs: Column) -> DataFrame:
        """One row per segment of the hot keys."""
        hot = self.df.sparkSession.createDataFrame(
            [k for k, _ in self.segments.edges],
            self.df.select(*self.keys).schema,
        )
        return (
            join_keys(self.df, hot, self.keys, "left_semi")
            .groupBy(*self._group)
            .agg(*[c.alias(n) for n, c in aggs.items()])
        )

    @property
    def _across(self):
        return W.partitionBy(*self.keys).orderBy("_seg")

    def _with(self, df: DataFrame) -> "Ordered":
        return replace(self, df=df)

    def result(self) -> DataFrame:
        return self.df.drop("_seg")

    def index(self, out: str = "idx") -> "Ordered":
        """Zero-based position within the key."""
        df = self.df.withColumn(out, F.row_number().over(self._window).cast("bigint") - 1)
        if self.segments:
            before = self._borders(_seg_n=F.count(F.lit(1))).select(
                *self._group,
                F.sum("_seg_n").over(self._across.rowsBetween(W.unboundedPreceding, -1)).alias("_seg_before"),
            )
            df = (
                join_keys(df, before, self._group)
                .withColumn(out, F.col(out) + F.coalesce("_seg_before", F.lit(0)))
                .drop("_seg_before")
            )
        return self._with(df)

    def count(self, out: str = "n") -> "Ordered":
        """Rows of the key, on every row."""
        if not self.segments:
            return self._with(self.df.withColumn(out, F.count(F.lit(1)).over(W.partitionBy(*self._group))))
        totals = self.df.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("_weight"), F.count(F.lit(1)).alias(out)
        )
        return self._with(attach(self.df, totals, self.keys, weight="_weight", stats=self.stats))

    def neighbours(self, **cols: str) -> "Ordered":
        """`neighbours(prev_y="lag:y", next_y="lead:y")` adds the adjacent rows' values."""
        wanted = {out: spec.split(":", 1) for out, spec in cols.items()}
        df = self.df
        for out, (side, src) in wanted.items():
            df = df.withColumn(out, (F.lag if side == "lag" else F.lead)(src).over(self._window))
        if self.segments:
            # Only the first (last) row of a segment looks across its border; its place, not its value, tells.
            df = df.withColumns({"_seg_first": F.lag(F.lit(1)).over(self._window).isNull(), "_seg_last": F.lead(F.lit(1)).over(self._window).isNull()})
            sources = F.struct(*sorted({src for _, src in wanted.values()}))
            edge = self._borders(_lo=F.min_by(sources, self._rank), _hi=F.max_by(sources, self._rank)).select(
                *self._group, F.lag("_hi").over(self._across).alias("_seg_prev"), F.lead("_lo").over(self._across).alias("_seg_next"),
            )
            df = join_keys(df, edge, self._group)
            for out, (side, src) in wanted.items():
                border, carry = ("_seg_first", "_seg_prev") if side == "lag" else ("_seg_last", "_seg_next")
                df = df.withColumn(out, F.when(F.col(border), F.col(carry)[src]).otherwise(F.col(out)))
            df = df.drop("_seg_first", "_seg_last", "_seg_prev", "_seg_next")
        return self._with(df)

    def running_sum(self, value: Column, out: str) -> "Ordered":
        """Inclusive cumulative sum within the key."""
        return self.running_sums(**{out: value})

    def running_sums(self, **values: Column) -> "Ordered":
        """`running_sums(total=F.col("y"))` adds inclusive cumulative sums; all share one look across the borders."""
        frame = self._window.rowsBetween(W.unboundedPreceding, W.currentRow)
        names = {out: f"_seg_v{i}" for i, out in enumerate(values)}
        tagged = self.df.withColumns({names[out]: value for out, value in values.items()})
        df = tagged.withColumns({out: F.sum(v).over(frame) for out, v in names.items()}).drop(*names.values())
        if self.segments:
            ahead = self._across.rowsBetween(W.unboundedPreceding, -1)
            before = self._with(tagged)._borders(**{v: F.sum(v) for v in names.values()}).select(
                *self._group, *[F.sum(v).over(ahead).alias(v) for v in names.values()],
            )
            df = (
                join_keys(df, before, self._group)
                .withColumns({out: F.col(out) + F.coalesce(v, F.lit(0)) for out, v in names.items()})
                .drop(*names.values())
            )
        return self._with(df)

    def next_known(self, value: str, out: str) -> "Ordered":
        """Nearest non-null `value` at or after the row.

        Read backwards, so that the frame only grows: frames that reach forward
        to the end of the partition are recomputed row by row.
        """
        backward = W.partitionBy(*self._group).orderBy(F.desc(self.order), *[F.desc(c) for c in self.ties])
        frame = backward.rowsBetween(W.unboundedPreceding, W.currentRow)
        df = self.df.withColumn(out, F.last(value, ignorenulls=True).over(frame))
        if self.segments:
            rank = F.when(F.col(value).isNotNull(), self._rank)
            down = W.partitionBy(*self.keys).orderBy(F.desc("_seg")).rowsBetween(W.unboundedPreceding, -1)
            after = self._borders(_seg_v=F.min_by(F.col(value), rank)).select(
                *self._group, F.last("_seg_v", ignorenulls=True).over(down).alias("_seg_after")
            )
            df = (
                join_keys(df, after, self._group)
                .withColumn(out, F.coalesce(F.col(out), F.col("_seg_after")))
                .drop("_seg_after")
            )
        return self._with(df)


def row_index(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), out: str = "idx") -> DataFrame:
    return Ordered.of(df, keys, order, ties).index(out).result()


def iteration_select(
    df: DataFrame,
    keys: Sequence[str],
    *,
    it_min: int | None = None,
    it_max: int | None = None,
    stride: int = 1,
    order: str = "iteration",
) -> DataFrame:
    """Closed iteration range first, then every `stride`-th survivor of each key."""
    if it_min is not None:
        df = df.filter(F.col(order) >= it_min)
    if it_max is not None:
        df = df.filter(F.col(order) <= it_max)
    if stride == 1:
        return df
    return row_index(df, keys, order, out="_i").filter(F.col("_i") % stride == 0).drop("_i")


def frame_select(df: DataFrame, start: int = 0, stop: int | None = None, stride: int = 1, idx: str = "idx") -> DataFrame:
    """Half-open index window with stride; `seq` renumbers the kept frames from 0."""
    i = F.col(idx)
    keep = (i >= start) & ((i - start) % stride == 0)
    if stop is not None:
        keep = keep & (i < stop)
    return df.filter(keep).withColumn("seq", F.expr(f"(`{idx}` - {int(start)}) div {int(stride)}"))


def split_contiguous(df: DataFrame, keys: Sequence[str], order: str, parts: int, out: str = "part") -> DataFrame:
    """Contiguous parts per key; the first n % parts of them get one extra row (0-based)."""
    o = Ordered.of(df, keys, order).index("_i").count("_n")
    small = F.expr(f"_n div {parts}")
    extra = F.col("_n") % parts
    edge = extra * (small + 1)
    # `small` is 0 only when every row lies before `edge`.
    part = F.when(F.col("_i") < edge, F.floor(F.col("_i") / (small + 1))).otherwise(
        extra + F.floor((F.col("_i") - edge) / F.greatest(small, F.lit(1)))
    )
    return o._with(o.df.withColumn(out, part.cast("bigint")).drop("_i", "_n")).result()


def round_robin(df: DataFrame, keys: Sequence[str], order: str, size: int, out: str = "rank") -> DataFrame:
    """Deal the ordered rows of each key over `size` workers, like slicing [rank::size]."""
    return row_index(df, keys, order, out="_i").withColumn(out, F.col("_i") % size).drop("_i")


def split_blocks(df: DataFrame, keys: Sequence[str], order: str, size: int, out: str = "rank") -> DataFrame:
    """Equal blocks of n // size rows; the last worker also takes the remainder."""
    o = Ordered.of(df, keys, order).index("_i").count("_n")
    block = F.expr(f"_n div {size}")
    rank = F.when(block == 0, size - 1).otherwise(
        F.least(F.floor(F.col("_i") / F.greatest(block, F.lit(1))), F.lit(size - 1))
    )
    return o._with(o.df.withColumn(out, rank.cast("bigint")).drop("_i", "_n")).result()

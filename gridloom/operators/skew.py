"""Hot-key detection and the two joins/orderings that must survive it.

A run, variable or frame may own a large share of all rows, so nothing here
sends one key's rows to one task. `KeyStats` counts rows per key with map-side
combining; keys above `gridloom.hot.rows`, or above 1/MAX_EDGES of all rows where
that is more, are hot: fewer than MAX_EDGES by that bound, however many keys there are.
The list steers routing only: results do not depend on what is in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT = 4096
MAX_EDGES = 65536
SALTS = 1024
_PROBS = 1024
BROADCAST_ROWS = 200_000


def hot_row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("gridloom.hot.rows", "2000000"))


def broadcast_row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("gridloom.broadcast.rows", str(BROADCAST_ROWS)))


def count_up_to(df: DataFrame, limit: int) -> int:
    """Row count of `df`, or `limit + 1` when there are more."""
    return df.limit(limit + 1).count()


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """True when `df` has at most `limit` rows; stops counting just past the limit."""
    limit = broadcast_row_limit(df) if limit is None else limit
    return count_up_to(df, limit) <= limit


def sized(df: DataFrame) -> DataFrame:
    """Hint a broadcast when the table is counted to be small, otherwise leave the join to Spark."""
    return F.broadcast(df) if is_small(df) else df


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", broadcast: bool = True) -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in the window or group that it replaces."""
    there = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(there[f"_r_{k}"]) for k in keys]
    out = left.join(F.broadcast(there) if broadcast else there, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


@dataclass(frozen=True)
class KeyStats:
    """What routing needs to know about the keys of a table, from one scan of the key columns.

    `top` holds the heaviest keys with their row counts `_n`: all keys, or MAX_HOT + 1
    of them, or all that are hot if those are more. Tables derived from the same
    source without adding keys or rows may share its stats.
    """

    top: tuple[Row, ...]
    limit: int

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str]) -> "KeyStats":
        counts, limit = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), hot_row_limit(df)
        top = counts.orderBy(F.desc("_n")).limit(MAX_HOT + 1).collect()
        if len(top) > MAX_HOT and top[-1]["_n"] > limit:
            # More hot keys than asked for: all of them, counted against the whole.
            limit = max(limit, (counts.agg(F.sum("_n")).first()[0] or 0) // MAX_EDGES + 1)
            hot = counts.filter(F.col("_n") > limit).collect()
            top = sorted(hot, key=lambda r: -r["_n"]) if len(hot) > len(top) else top
        return cls(tuple(top), limit)

    @property
    def few(self) -> bool:
        """All keys are in `top`, so one row per key is certain to be small."""
        return len(self.top) <= MAX_HOT

    @property
    def longest(self) -> int:
        return self.top[0]["_n"] if self.top else 0

    @property
    def hot(self) -> tuple[Row, ...]:
        return tuple(r for r in self.top if r["_n"] > self.limit)


def pin(table: DataFrame, stats: KeyStats) -> DataFrame:
    """Evaluate a one-row-per-key table once when it has at most MAX_HOT rows; else return it as it is."""
    if not stats.few:
        return table
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def heavy_hashes(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """xxhash64 of key combinations owning more than `gridloom.hot.rows` rows.

    For keys with too many values to count one by one. The frequent-items sketch
    has a fixed size and lists every key above about total / 7500 rows; counts
    may be off and hashes may collide, so use the list for routing only.
    """
    top = (
        df.select(F.xxhash64(*keys).alias("_h"))
        .agg(F.expr(f"approx_top_k(_h, {MAX_HOT}, 10000)").alias("_top"))
        .select(F.explode("_top").alias("_t"))
        .filter(F.col("_t.count") > hot_row_limit(df))
        .collect()
    )
    return [r["_t"]["item"] for r in top]


def _key_frame(df: DataFrame, keys: Sequence[str], hot: Sequence[Row]) -> DataFrame:
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("_n", T.LongType())])
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) + (r["_n"],) for r in hot], schema)


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    weight: str = "_n",
    many_keys: bool = False,
    how: str = "left",
    stats: KeyStats | None = None,
) -> DataFrame:
    """Join a one-row-per-key aggregate of `rows` back onto `rows`.

    `table[weight]` is the number of rows behind each key and is dropped. When
    a scan of the key columns finds at most MAX_HOT keys the table is broadcast.
    Otherwise (or at once, with `many_keys`) the heaviest keys above the hot limit,
    MAX_EDGES at most, are broadcast, and all other rows go through a plain equi-join in
    which the rows already served are spread over dead-end buckets rather than
    piling up on their key. The hot list only steers routing: the equi-join
    side still holds every key.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys and c != weight]
    if not many_keys and (stats or KeyStats.of(rows, keys)).few:
        return join_keys(rows, table.drop(weight), keys, how)

    packed = table.select(*keys, weight, F.struct(*values).alias("_cold"))
    warm = (
        packed.filter(F.col(weight) > hot_row_limit(rows))
        .orderBy(F.desc(weight))
        .limit(MAX_EDGES)
        .select(*keys, F.col("_cold").alias("_warm"))
    )
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).cast("int") + 1
    joined = (
        join_keys(
            join_keys(rows, warm, keys).withColumn("_salt", F.when(F.col("_warm").isNotNull(), spread).otherwise(0)),
            packed.drop(weight).withColumn("_salt", F.lit(0)), [*keys, "_salt"], broadcast=False,
        )
        .withColumn("_hit", F.coalesce("_warm", "_cold"))
    )
    if how == "inner":
        joined = joined.filter(F.col("_hit").isNotNull())
    return joined.select(*rows.columns, *[F.col("_hit")[v].alias(v) for v in values])


@dataclass(frozen=True)
class Segments:
    """Split points that cut each hot key's order axis into evenly filled pieces.

    `edges` holds (key values, sorted edges) for hot keys only; other keys are
    one segment, numbered 0. Edges are plain literals, so tagging a row is a
    deterministic function of that row and may be recomputed at will.

    A single order value may be hot by itself. It is then necessarily an edge,
    that is the lowest value of its segment; `tied` lists such values with edges
    on the tie column, which split them further.
    """

    keys: tuple[str, ...]
    order: str
    edges: tuple[tuple[tuple, tuple], ...]
    tie: str | None = None
    tied: tuple[tuple[tuple, tuple], ...] = ()

    @classmethod
    def plan(
        cls, df: DataFrame, keys: Sequence[str], order: str, stats: KeyStats | None = None, tie: str | None = None
    ) -> "Segments":
        keys = tuple(keys)
        hot = (stats or KeyStats.of(df, keys)).hot
        if not hot:
            return cls(keys, order, ())
        total = sum(r["_n"] for r in hot)
        chunk = max(hot_row_limit(df), total // MAX_EDGES + 1)
        own = join_keys(df.select(*keys, order), _key_frame(df, keys, hot), keys, "inner")
        edges = _quantile_edges(own, keys, order, F.first("_n"), chunk)
        edges = _finer(df, own, keys, order, edges, {tuple(r[k] for k in keys) for r in hot if r["_n"] > _PROBS * chunk}, chunk)
        if tie is None:
            return cls(keys, order, edges)
        at_edge = _edge_frame(df, keys, order, edges).select(*keys, F.explode(F.array_distinct("_edges")).alias(order))
        on = [*keys, order]
        same = join_keys(df.select(*on, tie), at_edge, on, "inner")
        counts = same.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk).collect()
        if not counts:
            return cls(keys, order, edges)
        same = join_keys(same, _key_frame(df, on, counts), on, "inner")
        return cls(keys, order, edges, tie, _quantile_edges(same, on, tie, F.first("_n"), chunk))

    def __bool__(self) -> bool:
        return bool(self.edges)

    def tag(self, df: DataFrame) -> DataFrame:
        """Add `_seg`, increasing with `order` (then the tie column) inside each key."""
        if not self.edges:
            return df.withColumn("_seg", F.lit(0).cast("bigint"))
        out = (
            join_keys(df, _edge_frame(df, self.keys, self.order, self.edges), self.keys)
            .withColumn("_seg", F.coalesce(_edges_passed(self.edges, self.order), F.lit(0)).cast("bigint"))
            .drop("_edges")
        )
        if not self.tied:
            return out
        on = [*self.keys, self.order]
        # The hot value leads its segment, so all other rows go behind its pieces.
        sub = F.coalesce(_edges_passed(self.tied, self.tie), F.lit(_TIE_ROOM - 1))
        return join_keys(out, _edge_frame(df, on, self.tie, self.tied), on).withColumn("_seg", F.col("_seg") * _TIE_ROOM + sub).drop("_edges")


_TIE_ROOM = 1 << 20
Edges = tuple[tuple[tuple, tuple], ...]


def _quantile_edges(df: DataFrame, keys: Sequence[str], value: str, rows: Column, chunk: int) -> Edges:
    """Per key, approximate quantiles of `value` about `chunk` rows apart; one small row per hot key."""
    probs = [i / _PROBS for i in range(1, _PROBS)]
    step = F.greatest(F.lit(1), F.floor(F.lit(_PROBS * chunk) / rows)).cast("int")
    found = (
        df.groupBy(*keys)
        .agg(F.percentile_approx(value, F.lit(probs), F.lit(8 * _PROBS)).alias("_cuts"), step.alias("_step"))
        .select(*keys, F.expr("array_distinct(filter(_cuts, (x, i) -> (i + 1) % _step = 0))").alias("_edges"))
        .collect()
    )
    return tuple((tuple(r[k] for k in keys), tuple(r["_edges"])) for r in found)


def _finer(df: DataFrame, own: DataFrame, keys: Sequence[str], order: str, edges: Edges, giant: set[tuple], chunk: int) -> Edges:
    """A second level of edges inside the pieces of keys that need more than one sketch gives."""
    if not giant:
        return edges
    first = tuple(e for e in edges if e[0] in giant)
    tagged = join_keys(own, _edge_frame(df, keys, order, first), keys, "inner").withColumn("_piece", _edges_passed(first, order))
    inner = _quantile_edges(tagged.select(*keys, "_piece", order), [*keys, "_piece"], order, F.count(F.lit(1)), chunk)
    more: dict[tuple, set] = {}
    for key, cuts in inner:
        more.setdefault(key[:-1], set()).update(cuts)
    return tuple((k, tuple(sorted({*cuts, *more.get(k, ())}))) for k, cuts in edges)


def _edge_frame(df: DataFrame, keys: Sequence[str], value: str, edges: Edges) -> DataFrame:
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("_edges", T.ArrayType(df.schema[value].dataType))]
    )
    return df.sparkSession.createDataFrame([(*k, list(e)) for k, e in edges], schema)


def _edges_passed(edges: Edges, value: str) -> Column:
    """Number of `_edges` <= value by binary search (`get` is null past the end); NULL without edges."""
    top = max(len(e) for _, e in edges).bit_length() - 1
    steps = ",".join(str(1 << b) for b in range(max(top, 0), -1, -1))
    search = f"aggregate(array({steps}), 0, (i, s) -> if(get(_edges, i + s - 1) <= `{value}`, i + s, i))"
    return F.expr(f"if(_edges is null, null, {search})")

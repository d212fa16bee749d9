"""Sharding by a k-d tree: split at distributed weighted medians along the widest metadata dimension.

Units are groups of equal texts, so copies share a shard; only a group that is larger than a shard
by itself is split, by a hash of the document id, into parts of about `share` of a shard. A node of k shards is cut where floor(k / 2) / k of its
bytes lie below, until each leaf is one shard. All nodes of a level are cut together: one
aggregation for the extents, then histograms that narrow the cut to a bin of at most EDGE units.
Those units alone come to the driver, where their sizes decide on which side each goes.

Size is the UTF-8 length of the text plus a fixed overhead; a null text has length 0 and equals an
empty one. Null metadata sorts first. Rows with the same id and text fall together. An empty table
gives no rows. Only the columns named below are returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ordered, settled

OVERHEAD = 8
#: Units of a cut that are compared one by one on the driver.
EDGE = 400
#: Parts of a group that fits no shard, as a share of one.
SHARE = 1 / 16
#: Digits of a position, eight bits each: 24 bits of coordinate, 32 bits of tie-breaking hash.
DIGITS = 7
DIMENSIONS = ("d0", "d1", "d2", "d3")


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, share: float = SHARE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place within the shard).

    Give the number of shards, or target bytes from which the number follows.
    """
    text = F.coalesce("text", F.lit(""))
    code = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(-1))
    meta = settled(docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g"), code("lang").alias("lang"), code("source").alias("source"),
    ))
    total = meta.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, math.ceil(total / (target_bytes or max(total, 1))))
    piece = max(1, int(total / shards * share))
    # Groups above a shard's bytes: fewer than there are shards, so this side of the join is bounded.
    large = meta.groupBy("g", "size").agg(F.sum("size").alias("all")).where(F.col("all") > total / shards).select(
        "g", "size", F.ceil(F.col("all") / piece).cast("long").alias("parts")
    )
    rows = meta.join(F.broadcast(large), ["g", "size"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), "parts"), F.lit(0).cast("long"))
    ).drop("parts")
    units = rows.groupBy("g", "size", "part").agg(
        F.sum("size").alias("bytes"), F.log2(F.first("size").cast("double")).alias("d0"),
        F.coalesce(F.min("doc_id"), F.lit(-1)).cast("double").alias("d1"), F.min("lang").cast("double").alias("d2"),
        F.min("source").cast("double").alias("d3"),
    ).withColumn("tie", F.shiftrightunsigned(F.xxhash64("g", "part"), 32))
    placed = rows.join(_leaves(settled(units), shards), ["g", "size", "part"])
    order = ordered(placed.select("doc_id", "size", "text_crc32", "shard"), [F.col("shard"), F.col("doc_id"), F.col("text_crc32")])
    counts = dict(order.groupBy("shard").count().collect())
    starts = {s: sum(n for k, n in counts.items() if k < s) for s in counts}
    return order.withColumn("slot", F.col("row_index") - _switch(F.col("shard"), starts)).drop("row_index")


def _switch(key: Column, values: dict, default=0) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def _leaves(units: DataFrame, shards: int) -> DataFrame:
    """(g, size, part, shard) of every unit. A node is (first shard, number of shards)."""
    state = units.withColumn("node", F.lit(0))
    nodes = {0: shards}
    reach = units.agg(*[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).first()
    while any(k > 1 for k in nodes.values()):
        open_ = [n for n, k in nodes.items() if k > 1]
        stats = {r.node: r for r in state.where(F.col("node").isin(open_)).groupBy("node").agg(
            F.sum("bytes").alias("bytes"), *[f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]
        ).collect()}
        axis, low, width = {}, {}, {}
        for n, r in stats.items():
            extent = {d: (r[f"{d}_max"] - r[f"{d}_min"]) / reach[d] if reach[d] else 0.0 for d in DIMENSIONS}
            axis[n] = max(DIMENSIONS, key=lambda d: extent[d])
            low[n], width[n] = r[f"{axis[n]}_min"], r[f"{axis[n]}_max"] - r[f"{axis[n]}_min"]
        along = F.when(F.lit(False), F.lit(0.0))
        for n in stats:
            along = along.when(F.col("node") == n, (F.col(axis[n]) - low[n]) / (width[n] or 1.0))
        place = F.floor(along * ((1 << 24) - 1)).bitwiseOR(F.lit(0)) * (1 << 32) + F.col("tie")
        state = state.withColumn("place", place)
        goal = {n: r.bytes * (nodes[n] // 2) / nodes[n] for n, r in stats.items()}
        cuts, left = _cut(state, goal)
        # Below the bin: left. In it: what the driver chose, at most EDGE units a node.
        side = F.when(F.lit(False), F.lit(True))
        for n, (lo, _hi) in cuts.items():
            side = side.when((F.col("node") == n) & (F.col("place") < lo), F.lit(True))
        chosen = state.sparkSession.createDataFrame(left or [(0, 0, -1)], "g bigint, size bigint, part bigint").withColumn("l", F.lit(True))
        moved = state.join(F.broadcast(chosen), ["g", "size", "part"], "left")
        go_right = F.col("node").isin(list(stats)) & ~(F.coalesce("l", side, F.lit(False)))
        step = _switch(F.col("node"), {n: nodes[n] // 2 for n in stats})
        state = settled(moved.withColumn("node", F.col("node") + F.when(go_right, step).otherwise(0)).drop("l", "place"))
        for n in open_:
            k = nodes[n]
            nodes[n], nodes[n + k // 2] = k // 2, k - k // 2
    return state.select("g", "size", "part", F.col("node").cast("int").alias("shard"))


def _cut(state: DataFrame, goal: dict[int, float]) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int, int]]]:
    """For each node the positions [lo, hi) of the bin that holds its cut, and the bin's units that go left."""
    bins = {n: (0, 1 << 8 * DIGITS) for n in goal}
    missing = dict(goal)
    ready: set[int] = set()
    for digit in range(DIGITS):
        todo = [n for n in bins if n not in ready]
        if not todo:
            break
        shift = 8 * (DIGITS - 1 - digit)
        here = F.when(F.lit(False), F.lit(False))
        for n in todo:
            here = here.when((F.col("node") == n) & (F.col("place") >= bins[n][0]) & (F.col("place") < bins[n][1]), F.lit(True))
        hist = state.where(here).groupBy("node", F.shiftright("place", shift).alias("bin")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n")
        ).collect()
        for n in todo:
            own = sorted((r for r in hist if r.node == n), key=lambda r: r.bin)
            at = 0
            while at < len(own) - 1 and missing[n] > own[at].bytes:
                missing[n] -= own[at].bytes
                at += 1
            lo = hi = at
            if own[at].n <= EDGE:
                # The cut may be anywhere among the nearest EDGE units: the more sizes, the closer it gets.
                ready.add(n)
                units, grown = own[at].n, True
                while grown:
                    grown = False
                    if lo > 0 and units + own[lo - 1].n <= EDGE:
                        lo, grown = lo - 1, True
                        units, missing[n] = units + own[lo].n, missing[n] + own[lo].bytes
                    if hi < len(own) - 1 and units + own[hi + 1].n <= EDGE:
                        hi, grown = hi + 1, True
                        units += own[hi].n
            bins[n] = (own[lo].bin << shift, (own[hi].bin + 1) << shift)
    here = F.when(F.lit(False), F.lit(False))
    for n, (lo, hi) in bins.items():
        here = here.when((F.col("node") == n) & (F.col("place") >= lo) & (F.col("place") < hi), F.lit(True))
    left = []
    edge = state.where(here).select("node", "place", "g", "size", "part", "bytes").orderBy("place", "g", "part").limit(EDGE * 2 * len(bins)).collect()
    for n in bins:
        need, over = missing[n], None
        for r in (r for r in edge if r.node == n):
            if r.bytes <= need:
                need -= r.bytes
                left.append((r.g, r.size, r.part))
            elif over is None or r.bytes < over.bytes:
                over = r
        # One unit too many, if that comes closer to the goal.
        if over is not None and over.bytes - need < need:
            left.append((over.g, over.size, over.part))
    return bins, left


def digest(placed: DataFrame) -> DataFrame:
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )

"""Merkle fixity audit of WARC replicas.

Every record is hashed; leaves in record order cover successive offset ranges, and each inner node
hashes `fanout` children, so a root stands for a whole replica. An audit compares roots and descends:
of each level only the children of mismatching nodes are compared, down to the damaged records.

The manifest of the reference replica fixes order, offsets and lengths; a replica's records are
aligned with it by id. Records with one id form one leaf (their count and the least, largest and
summed digests). Status is 'changed', 'missing' or 'extra' (an id the reference lacks, without a place
in the tree). Null url or payload counts as empty; a null id is an id like any other. Two empty
replicas agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from gridloom.llm.common import ordered, settled

FANOUT = 16


def record(url: Column, payload: Column) -> Column:
    """The bytes of a WARC response record."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    ).cast("binary")


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """id, length, digest: one row per id."""
    raw = record(F.col(url), F.col(payload))
    each = pages.select(F.col(key).alias("id"), F.octet_length(raw).cast("long").alias("length"), F.sha2(raw, 256).alias("digest"))
    head = F.conv(F.substring("digest", 1, 12), 16, 10).cast("decimal(20,0)")
    one = each.groupBy("id").agg(
        F.count("*").alias("n"), F.sum("length").alias("length"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.sum(head).alias("all"),
    )
    several = F.sha2(F.concat_ws(",", "n", "low", "high", "all"), 256)
    return one.select("id", "length", F.when(F.col("n") == 1, F.col("low")).otherwise(several).alias("digest"))


def manifest(recs: DataFrame) -> DataFrame:
    """records + place (0-based) and offset, in the order of ids; offsets sum within blocks of places, then over blocks."""
    placed = ordered(recs, [F.col("id")], "place")
    return settled(_offsets(placed, "place", "length"))


def _offsets(rows: DataFrame, place: str, size: str, block: int = 4096) -> DataFrame:
    """Running sums by two levels of blocks of places: no window covers more than `block` rows or blocks of blocks."""
    from pyspark.sql import Window as W

    b, bb = F.expr(f"{place} div {block}"), F.expr(f"{place} div {block * block}")
    rows = rows.withColumns({"_b": b, "_bb": bb})
    run = lambda part: W.partitionBy(part).orderBy(place).rowsBetween(W.unboundedPreceding, -1)
    inner = rows.withColumn("_in", F.coalesce(F.sum(size).over(run("_b")), F.lit(0)))
    blocks = rows.groupBy("_bb", "_b").agg(F.sum(size).alias("_s"))
    mid = blocks.withColumn("_mid", F.coalesce(F.sum("_s").over(W.partitionBy("_bb").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    tops, at = {}, 0
    for r in sorted(rows.groupBy("_bb").agg(F.sum(size).alias("s")).collect(), key=lambda r: r._bb):  # one per 16.8 million records
        tops[r._bb] = at
        at += r.s
    top = F.lit(0).cast("long")
    for k, v in tops.items():
        top = F.when(F.col("_bb") == k, F.lit(v)).otherwise(top)
    return inner.join(mid.select("_b", "_mid"), "_b").withColumn("offset", (F.col("_in") + F.col("_mid") + top).cast("long")).drop("_b", "_bb", "_in", "_mid")


def tree(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the leaves up: (node, digest, start, stop) with the offset range each node covers.

    leaves: place, digest (null where the replica lacks the record), offset, length.
    """
    level = settled(leaves.select(F.col("place").alias("node"), "digest", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop")))
    levels, n = [level], level.count()
    while n > 1:
        # At most `fanout` children a group.
        level = settled(level.groupBy(F.expr(f"node div {fanout}").alias("node")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", F.coalesce("digest", F.lit("-")).alias("d")))), lambda x: x["d"]), ""), 256).alias("digest"),
            F.min("start").alias("start"), F.max("stop").alias("stop"),
        ))
        levels.append(level)
        n = -(-n // fanout)
    return levels


def descend(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """The leaves (node, digest, replica_digest) that differ, found along mismatching branches only."""
    suspects = None
    for a, b in zip(reversed(left), reversed(right)):
        if suspects is not None:
            a, b = (x.join(suspects.withColumnRenamed("node", "_up"), F.expr(f"node div {fanout}") == F.col("_up"), "left_semi") for x in (a, b))
        both = a.join(b.select("node", F.col("digest").alias("replica_digest")), "node")
        suspects = settled(both.where(~F.col("digest").eqNullSafe(F.col("replica_digest"))).select("node", "digest", "replica_digest"))
        if suspects.isEmpty():
            break
    return suspects


def audit(reference: DataFrame, replica: DataFrame, fanout: int = FANOUT, **columns: str) -> DataFrame:
    """id, place, offset, length, digest, replica_digest, status of every damaged record of the replica."""
    base = manifest(records(reference, **columns))
    other = records(replica, **columns).select(F.col("id").alias("_id"), F.col("digest").alias("replica_digest"))
    aligned = base.join(other, F.col("id").eqNullSafe(F.col("_id")), "left")
    bad = descend(tree(base, fanout), tree(aligned.select("place", F.col("replica_digest").alias("digest"), "offset", "length"), fanout), fanout)
    located = base.join(bad.select(F.col("node").alias("place"), "replica_digest"), "place").select(
        "id", "place", "offset", "length", "digest", "replica_digest",
        F.when(F.col("replica_digest").isNull(), "missing").otherwise("changed").alias("status"),
    )
    extra = other.join(base, F.col("id").eqNullSafe(F.col("_id")), "left_anti").select(
        F.col("_id").alias("id"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("length"), F.lit(None).cast("string").alias("digest"), "replica_digest", F.lit("extra").alias("status"),
    )
    return located.unionByName(extra)

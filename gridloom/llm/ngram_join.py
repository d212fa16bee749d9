"""N-gram Jaccard join: MinHash banding, then verification on full n-gram sets.

1. Documents with equal n-gram sets form one class from the start; its number is kept, its copies are
   not paired.
2. MinHash signatures are cut into bands, their numbers chosen for the recall wanted at the
   threshold. Sets are shuffled on band hashes and tied to the least set in their bucket: linear in
   the size of a bucket. What is tied together, directly or not, is a candidate cluster.
3. The sets of a cluster are fetched once and all its pairs are verified, by counts of common n-grams
   as matrix products, a stripe of rows at a time. A cluster above BLOCK n-grams or SETS sets is dealt
   into blocks, and pairs of blocks go to different tasks. Tasks give numbers of links and a spanning
   forest, never pairs.

Numbers of links are exact for all pairs in a cluster, so verification grows with the square of the
number of different texts in one cluster; blocks spread it. The memory of a task is linear in the sets
and n-grams of its pair of blocks; each set is sent once to every block of its cluster.

Words are lower-cased runs of letters and digits (see `common.words`); a text of fewer than n words has one
n-gram of all of them. Texts without words, null ones too, have no links and are alone. Repeated
rows are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import U64, drawn, mixed, pressed, slices, small_batches, stored, unpressed, word_hashes
from gridloom.llm.components import components

N, THRESHOLD, RECALL = 5, 0.8, 0.999
MAX_HASHES = 128
#: N-grams whose pairs one task verifies at a time.
BLOCK = 600_000
#: Sets of one cluster in a block, about.
SETS = 2_000
SCAN_BYTES = 1 << 18
#: Columns of a dense matrix at most; entries of it, and of a stripe of the pairs.
COLUMNS, ENTRIES = 4096, 1 << 21

_BASE = U64(int(drawn(21, 1)[0]) | 1)


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the recall wanted at the threshold and the most rows, so the fewest false candidates, within `most` hashes."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= most:
            return bands, rows
    return most, 1


def ngrams(texts: list[bytes | None], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of many texts, repeats included, and the first of each text (and the end)."""
    value, _, _, first = word_hashes(texts)
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(value)) - first[:-1][text]
    # Starts of n-grams: all with n words left, or the first word of a shorter text.
    starts = np.flatnonzero((place + n <= sizes[text]) | (place == 0))
    with np.errstate(over="ignore"):
        out = np.zeros(len(starts), U64)
        width = np.minimum(n, sizes[text[starts]])
        for k in range(n):
            inside = width > k
            out[inside] = out[inside] * _BASE + value[starts[inside] + k]
        out = mixed(out + width.astype(U64))
    return out, np.searchsorted(text[starts], np.arange(len(texts) + 1))


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """docs (_text binary) without the text, + set_id (16 bytes, null without n-grams), size, band hashes."""
    seeds = drawn(22, bands * rows) | U64(1)
    shifts = drawn(23, bands * rows)
    names = [c for c in docs.columns if c != "_text"]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SCAN_BYTES):
                grams, first = ngrams(part.column("_text").to_pylist(), n)
                count = np.diff(first)
                full = np.flatnonzero(count)
                ids: list[bytes | None] = [None] * len(count)
                sizes = np.zeros(len(count), np.int64)
                for i in full.tolist():
                    own = np.unique(grams[first[i] : first[i + 1]])
                    with np.errstate(over="ignore"):
                        ids[i] = np.array([own.sum(), mixed(own ^ U64(0x5DEECE66D)).sum() + U64(len(own))], "<u8").tobytes()
                    sizes[i] = len(own)
                hashes: list = [None] * len(count)
                if len(full):
                    at = first[:-1][full]
                    with np.errstate(over="ignore"):
                        low = np.stack([np.minimum.reduceat(grams * a + b, at) for a, b in zip(seeds, shifts)], 1).reshape(len(full), bands, rows)
                        band = np.zeros((len(full), bands), U64)
                        for r in range(rows):
                            band = mixed(band * _BASE + low[:, :, r])
                    for i, row in zip(full.tolist(), band.view(np.int64)):
                        hashes[i] = row
                kept = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(ids, pa.binary()), pa.array(sizes), pa.array(hashes, pa.list_(pa.int64()))], [*names, "set_id", "size", "bands"])

    return docs.select(*names, "_text").mapInArrow(run, f"{types}, set_id binary, size bigint, bands array<bigint>")


def _verify(frame: pd.DataFrame, n: int, threshold: float) -> pd.DataFrame:
    """(set_id, links, root) from the clusters, or pairs of blocks, in one frame."""
    press = zstandard.ZstdDecompressor()
    out = []
    for _, rows in frame.groupby(["cluster", "i", "j"], sort=False):
        ids, weight, block = rows["set_id"].tolist(), rows["weight"].to_numpy(), rows["block"].to_numpy()
        grams, first = ngrams([press.decompress(z) for z in rows["z"]], n)
        sets = [np.unique(grams[a:b]) for a, b in zip(first, first[1:])]
        size = np.array([len(s) for s in sets])
        m = len(sets)
        owner = np.repeat(np.arange(m), size)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = often[column] > 1  # an n-gram of one set is in no intersection
        owner, column = owner[keep], column[keep]
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        last = int(column[-1]) + 1 if len(column) else 0
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        wide, high = max(1, min(COLUMNS, last, ENTRIES // m)), max(1, ENTRIES // m)
        links, label = np.zeros(m, np.int64), np.arange(m)
        for top in range(0, m, high):
            own = slice(top, min(m, top + high))
            common = np.zeros((own.stop - top, m), np.float32)
            for c in range(0, last, wide):
                a, b = np.searchsorted(column, [c, c + wide])
                x = np.zeros((m, wide), np.float32)
                x[owner[a:b], column[a:b] - c] = 1
                common += x[own] @ x.T
            linked = common >= threshold * (size[own, None] + size[None] - common) - 1e-6
            linked[np.arange(own.stop - top), np.arange(top, own.stop)] = False
            if i != j:
                linked &= block[own, None] != block[None]
            links[own] = linked @ weight
            for x, row in enumerate(linked, top):
                # Joining x to its linked sets before it is enough: each pair is met once.
                met = label[:x][row[:x]]
                if (met != label[x]).any():
                    met = np.unique(np.append(met, label[x]))
                    label[np.isin(label, met)] = met[0]
        out += [(ids[x], int(links[x]), ids[label[x]]) for x in range(m) if links[x]]
    return pd.DataFrame(out, columns=["set_id", "links", "root"])


def _dealt(members: DataFrame, block: int, most: int) -> DataFrame:
    """members + nb, the blocks of their cluster, and block: about `block` n-grams and `most` sets in one at most."""
    volume = members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("size") / block), F.ceil(F.count("*") / most)).cast("int").alias("nb"))
    return members.join(volume, "cluster").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("nb")).cast("int"))


def join(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, text: str = "text", block: int = BLOCK, most: int = SETS,
) -> DataFrame:
    """doc_id, class_id (least id of the class), n_links (other documents at or above the threshold), one row per row of docs."""
    return _joined(docs, n, threshold, recall, text, block, most).select(
        "doc_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _joined(docs: DataFrame, n: int, threshold: float, recall: float, text: str, block: int, most: int) -> DataFrame:
    """doc_id, _h (hash of the text), set_id (null without words), first (doc_id and _h of the class's first document, null ids last), n_links."""
    small_batches(docs.sparkSession)
    bands, rows = banding(threshold, recall)
    source = docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    # The text of a set is fetched again by these two, equal for equal rows.
    keyed = source.select("doc_id", _text_hash("_text").alias("_h"), "_text")
    signed = stored(signatures(keyed, n, bands, rows))
    sets = stored(signed.where("set_id is not null").groupBy("set_id").agg(
        F.count("*").alias("weight"), F.min(F.struct(F.col("doc_id").isNull().alias("_no"), "doc_id", "_h")).alias("one"), F.first("bands").alias("bands"), F.first("size").alias("size"),
    ))
    banded = sets.select("set_id", F.posexplode("bands").alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("set_id").alias("low")).where("n > 1").drop("n")
    tied = banded.join(buckets, ["band", "value"]).where("set_id <> low").select(F.col("set_id").alias("a"), F.col("low").alias("b"))
    clusters = components(tied).select(F.col("id").alias("set_id"), F.col("root").alias("cluster"))
    members = stored(clusters.join(sets.select("set_id", "weight", "size", "one"), "set_id"))
    total = members.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // block))
    fetched = _fetch(_dealt(members, block, most), keyed)
    # A block meets every block of its cluster once.
    spread = fetched.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "cluster", "set_id", "weight", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "nb", "z",
    ).withColumn("shard", F.when(F.col("nb") == 1, F.pmod(F.xxhash64("cluster"), F.lit(shards))).otherwise(F.xxhash64("cluster", "i", "j")))
    verified = stored(spread.drop("nb").groupBy("shard").applyInPandas(
        lambda frame: _verify(frame, n, threshold), "set_id binary, links bigint, root binary"))
    linked = verified.groupBy("set_id").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    leaves = sets.select("set_id", "weight", "one").join(roots.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = leaves.groupBy("root").agg(F.min("one").alias("first"))
    known = leaves.join(least, "root").join(linked, "set_id", "left").select(
        "set_id", "first", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("doc_id", "_h", "set_id").join(known, "set_id", "left")


def _fetch(members: DataFrame, docs: DataFrame) -> DataFrame:
    """members + z, the compressed text of one document of the set."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([press.compress(t) for t in batch.column("_text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_h"), z], ["_id", "_h", "z"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.mapInArrow(pack, f"_id {kind}, _h bigint, z binary")
    wanted = members.select("*", F.col("one.doc_id").alias("_one"), F.col("one._h").alias("_h")).drop("one")
    same = F.col("_one").eqNullSafe(F.col("_id"))
    return wanted.join(texts, [wanted["_h"] == texts["_h"], same]).drop("_h", "_id", "_one").dropDuplicates(["set_id"])


def representatives(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, text: str = "text", block: int = BLOCK, most: int = SETS,
) -> DataFrame:
    """The columns of docs: of each class one row of its least id (of its rows, that of the least text hash). Rows without words stay."""
    found = stored(_joined(docs, n, threshold, recall, text, block, most))
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_h") == F.col("first._h"))
    keep = found.where(F.col("set_id").isNull() | chosen).groupBy(F.col("doc_id").alias("_keep"), F.col("_h").alias("_hash")).agg(
        ((F.count("*") > 1) & F.first("set_id").isNotNull()).alias("_again"))
    pack = pressed(docs.withColumn("_h", _text_hash(text)), text)
    kept = unpressed(pack.join(keep, (pack["_h"] == keep["_hash"]) & pack["doc_id"].eqNullSafe(keep["_keep"])), text).select(*docs.columns, "_again")
    # Only rows equal in id and text are compared.
    once = kept.where("not _again").drop("_again")
    return once.unionByName(kept.where("_again").drop("_again").dropDuplicates(["doc_id", text])) if not keep.where("_again").isEmpty() else once

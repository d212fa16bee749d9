"""Repeated windows of a corpus: content-defined segments that bring equal windows together.

A window is `length` successive symbols of one text (words or bytes). Its anchor is the leftmost
k-gram of least hash within it, so equal windows have equal anchors at the same place. Successive
windows of one anchor form a segment, at most length - k + 1 windows; every window lies in just one
segment, and all windows equal to it lie in segments of the same anchor hash. So repeats are sought
among segments of one anchor, whose number is about 2 / (length - k + 2) of that of the symbols.

1. A document's equal segments are one row with the list of their places. Per anchor, the number of segments
   is combined before the shuffle. Anchors met once are done with.
2. Equal segments of an anchor are merged with their number, and each content is fetched once (not each copy).
3. Contents of an anchor go, with their numbers, to a shard of bounded size, where the caller's `resolve` finds the
   windows that occur twice or more, by the actual symbols. Its verdict holds at all places of the content.
4. An anchor with more than MAX_CONTENTS contents would be too large a group. Its windows are
   counted by a 128-bit hash instead, one row per window, combined before the shuffle.

Documents are known by (id, hash of text): rows equal in both are one key, but count as often as they occur.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import U64, drawn, mixed, pressed, slices, small_batches, stored, word_hashes

#: Different contents of one anchor that one shard may get.
MAX_CONTENTS = 4_000
#: Contents that occur so often that their verdicts are broadcast, at most.
MAX_FREQUENT = 4_096
#: Bytes of text whose arrays are held at once.
SCAN_BYTES = 1 << 18

_BASE = int(drawn(11, 1)[0]) | 1
_BACK = pow(_BASE, -1, 1 << 64)
_BYTES = drawn(12, 256)

KEY = ("_d", "_h")


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """docs + the key of each row."""
    small_batches(docs.sparkSession)
    return docs.withColumns({
        "_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "_h": F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col("doc_id").isNull()),
    })


class Symbols:
    """Words between ASCII white space, or bytes: hashes of many texts at once, and cutting a text."""

    def __init__(self, unit: str):
        self.unit = unit

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each symbol, first symbol of each text (and the end)."""
        if self.unit == "word":
            value, _, _, first = word_hashes(texts, None)
            return value, first
        raw = np.frombuffer(b"".join(texts), np.uint8)
        return _BYTES[raw], np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def cut(self, text: bytes) -> Callable[[int, int], bytes]:
        """A function from (first, end) symbols to their bytes; words are joined by one space."""
        if self.unit == "word":
            words = text.split()
            return lambda a, b: b" ".join(words[a:b])
        return lambda a, b: text[a:b]


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, _BASE, U64))])
                self.down = np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, _BACK, U64))])
        return self.up[:n], self.down[:n]


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in each run of `width` values, by doubling."""
    at = np.arange(len(values), dtype=np.int32)
    span = 1
    while 2 * span <= width:
        left, right = at[:-span], at[span:]
        at = np.where(values[right] < values[left], right, left)
        span *= 2
    if span < width:
        left, right = at[: len(at) - (width - span)], at[width - span :]
        at = np.where(values[right] < values[left], right, left)
    return at


def segments_of(h: np.ndarray, first: np.ndarray, length: int, k: int, powers: Powers, anchors_only: bool = False) -> dict[str, np.ndarray] | None:
    """Segments of the texts whose symbols lie one after the other in h.

    text, at (first symbol), windows, anchor (its hash), content (its hash), lead (symbols before the anchor); or anchor alone.
    """
    n = len(h)
    if n < length:
        return None
    with np.errstate(over="ignore"):
        up, down = powers.get(n + 1)
        sums = np.concatenate([[U64(0)], np.cumsum(h * up[:n])])
        grams = mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])
        anchor = least(grams, length - k + 1)  # one per window, also across texts
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inside = np.flatnonzero(text[: n - length + 1] == text[length - 1 :])
        if not len(inside):
            return None
        anchor, text = anchor[inside], text[inside]
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(text) != 0)])
        start = np.flatnonzero(new)
        if anchors_only:
            return {"anchor": grams[anchor[start]]}
        windows = np.diff(np.append(start, len(inside)))
        begin, a = inside[start], anchor[start]
        whole = (sums[begin + windows + length - 1] - sums[begin]) * down[begin]
        content = mixed(whole + mixed((a - begin).astype(U64) * U64(65536) + windows.astype(U64)))
    return {"text": text[start], "at": begin - first[text[start]], "windows": windows, "anchor": grams[a], "content": content, "lead": a - begin}


def _segments(docs: DataFrame, unit: str, length: int, k: int) -> DataFrame:
    """_d, _h, anchor, content, ats (first symbol and number of windows of each such segment of the document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, powers = Symbols(unit), Powers()
        for batch in batches:
            for part in slices(batch, "_text", SCAN_BYTES):
                got = segments_of(*symbols.hashes(part.column("_text").to_pylist()), length, k, powers)
                if got is None:
                    continue
                order = np.lexsort((got["at"], got["content"], got["anchor"], got["text"]))
                text, anchor, content = got["text"][order], got["anchor"][order], got["content"][order]
                places = (got["at"].astype(np.int64) << 16 | got["windows"])[order]
                new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]))
                own = pa.array(text[new])
                yield pa.RecordBatch.from_arrays([
                    part.column("_d").take(own), part.column("_h").take(own),
                    pa.array(anchor[new].view(np.int64)), pa.array(content[new].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.append(new, len(order)), pa.int32()), pa.array(places)),
                ], ["_d", "_h", "anchor", "content", "ats"])

    return docs.select(*KEY, "_text").mapInArrow(run, "_d bigint, _h bigint, anchor bigint, content bigint, ats array<bigint>")


def _anchors(docs: DataFrame, unit: str, length: int, k: int) -> DataFrame:
    """anchor, n: how many segments of some texts at a time have that anchor; neither contents nor places are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, powers = Symbols(unit), Powers()
        for batch in batches:
            for part in slices(batch, "_text", SCAN_BYTES):
                got = segments_of(*symbols.hashes(part.column("_text").to_pylist()), length, k, powers, anchors_only=True)
                if got is not None:
                    anchor, n = np.unique(got["anchor"], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])

    return docs.select("_text").mapInArrow(run, "anchor bigint, n bigint")


def _with_texts(rows: DataFrame, docs: DataFrame, schema: str, make: Callable) -> DataFrame:
    """Join rows (a key and a list `items`) with their texts, which travel compressed; make(text, row) gives row tuples."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("_d"), batch.column("_h"), pa.array([press.compress(t) for t in batch.column("_text").to_pylist()], pa.binary())], ["_d", "_h", "_z"])

    texts = docs.select(*KEY, "_text").mapInArrow(pack, "_d bigint, _h bigint, _z binary")
    return rows.join(texts, list(KEY)).mapInArrow(make, schema)


def place(at: Column) -> tuple[Column, Column]:
    return F.shiftright(at, 16), at.bitwiseAND(F.lit(65535))


def repeated(docs: DataFrame, unit: str, length: int, k: int, resolve: Callable, shard_symbols: int, max_contents: int = MAX_CONTENTS) -> DataFrame:
    """(_d, _h, _spans) of the documents with repeated windows; the spans are [first, end) symbols, unmerged.

    docs: _d, _h, _text (binary, not null). resolve(bodies, weights, length) gets the contents of one
    shard (bytes; words joined by one space) and how often each occurs, and gives a boolean array per
    content: which of its windows occur twice or more. A shard has about `shard_symbols` symbols.
    """
    segments = _segments(docs, unit, length, k)
    # Stored, so that the joins below have nothing but shuffled rows on either side and a hot key can be split.
    anchors = stored(_anchors(docs, unit, length, k).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))
    hits = stored(segments.join(anchors, "anchor"))

    contents = stored(hits.groupBy("anchor", "content").agg(
        F.sum(F.size("ats")).alias("n"), F.min(F.struct("_d", "_h", F.col("ats")[0].alias("at"))).alias("one"),
    ).select("anchor", "content", "n", "one.*"))
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("m"))
    fetched = _fetch(contents, docs, unit, length)
    total = fetched.agg(F.sum("symbols")).first()[0] or 0
    shards = max(1, -(-total // shard_symbols))
    crowded = sizes.where(F.col("m") > max_contents).select("anchor", F.lit(True).alias("crowded"))
    known = stored(fetched.join(crowded, "anchor", "left"))
    few = known.where("crowded is null").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))

    def in_shard(frame: pd.DataFrame) -> pd.DataFrame:
        flags = resolve(frame["body"].tolist(), frame["n"].to_numpy(), length)
        out = []
        for row, own in zip(frame[["anchor", "content", "n", "_d", "_h", "at"]].itertuples(index=False, name=None), flags):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            out += [(*row, a, b - 1 + length) for a, b in zip(edge[0::2], edge[1::2])]
        return pd.DataFrame(out, columns=["anchor", "content", "n", "_d", "_h", "at", "first", "end"]).astype("int64")

    #: What repeats in a content, counted from its first symbol.
    fields = "anchor bigint, content bigint, n bigint, _d bigint, _h bigint, at bigint, first bigint, end bigint"
    found = stored(few.groupBy("shard").applyInPandas(in_shard, fields))
    start, count = place(F.col("at"))
    single = found.where("n = 1").select(*KEY, (start + F.col("first")).alias("first"), (start + F.col("end")).alias("end"))
    often = found.where("n > 1").select("anchor", "content", "n", "first", "end").unionByName(
        known.where("crowded and n > 1").select("anchor", "content", "n", F.lit(0).cast("long").alias("first"), (count - 1 + length).alias("end")))
    verdicts = stored(often.groupBy("anchor", "content").agg(F.first("n").alias("n"), F.collect_list(F.struct("first", "end")).alias("own")))
    every = _at_all_places(hits, verdicts).unionByName(single).unionByName(_crowded(known.where("crowded"), unit, length))
    return every.groupBy(*KEY).agg(F.collect_set(F.struct("first", "end")).alias("_spans"))


def _at_all_places(hits: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(_d, _h, first, end): what repeats in each content, at every place of it.

    Contents that own over 1/MAX_FREQUENT of all places, MAX_FREQUENT at most, are broadcast; the rest meet by key.
    """
    places = verdicts.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") > max(1000, places // MAX_FREQUENT)
    on = ["anchor", "content"]
    known = hits.join(F.broadcast(verdicts.where(common).select(*on, "own")), on, "left")
    rest = known.where("own is null").drop("own").join(verdicts.where(~common).select(*on, "own"), on)
    both = known.where("own is not null").unionByName(rest).select(*KEY, F.explode("ats").alias("at"), "own")
    start, _ = place(F.col("at"))
    return both.select(*KEY, start.alias("start"), F.explode("own").alias("s")).select(
        *KEY, (F.col("start") + F.col("s.first")).alias("first"), (F.col("start") + F.col("s.end")).alias("end"))


def _fetch(contents: DataFrame, docs: DataFrame, unit: str, length: int) -> DataFrame:
    """contents + body (the symbols' bytes) and symbols (their number)."""
    names = ["_d", "_h", "anchor", "content", "n", "at", "body", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, press = Symbols(unit), zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                cut = symbols.cut(press.decompress(r["_z"]))
                for x in r["items"]:
                    first, size = x["at"] >> 16, (x["at"] & 65535) - 1 + length
                    rows.append((r["_d"], r["_h"], x["anchor"], x["content"], x["n"], x["at"], cut(first, first + size), size))
            cols = list(zip(*rows)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 6 else pa.int64()) for i, c in enumerate(cols)], names)

    lists = contents.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "content", "n", "at")).alias("items"))
    schema = "_d bigint, _h bigint, anchor bigint, content bigint, n bigint, at bigint, body binary, symbols bigint"
    return stored(_with_texts(lists, docs, schema, run).dropDuplicates(["anchor", "content"]))


def _crowded(rows: DataFrame, unit: str, length: int) -> DataFrame:
    """Spans of windows counted by hash, for anchors with very many contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, powers = Symbols(unit), Powers()
        for batch in batches:
            for part in slices(batch, "body", SCAN_BYTES):
                h, first = symbols.hashes(part.column("body").to_pylist())
                n = len(h)
                with np.errstate(over="ignore"):
                    up, down = powers.get(n + 1)
                    sums = np.concatenate([[U64(0)], np.cumsum(h * up[:n])])
                    other = np.concatenate([[U64(0)], np.cumsum(mixed(h) * up[:n])])
                    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                    at = np.flatnonzero(text[: n - length + 1] == text[length - 1 :])
                    one, two = ((s[at + length] - s[at]) * down[at] for s in (sums, other))
                own = pa.array(text[at])
                places = pa.array((part.column("at").to_numpy()[text[at]] >> 16) + at - first[text[at]])
                yield pa.RecordBatch.from_arrays([
                    part.column("_d").take(own), part.column("_h").take(own), part.column("n").take(own), places,
                    pa.array(mixed(one).view(np.int64)), pa.array(mixed(two).view(np.int64)),
                ], ["_d", "_h", "n", "first", "one", "two"])

    windows = rows.select(*KEY, "n", "at", "body").mapInArrow(run, "_d bigint, _h bigint, n bigint, first bigint, one bigint, two bigint")
    # A place is kept only of windows met once; of others, all places are needed.
    counted = windows.groupBy("one", "two").agg(F.sum("n").alias("all")).where("all > 1")
    return windows.where("n = 1").join(counted, ["one", "two"], "left_semi").select(*KEY, "first", (F.col("first") + length).alias("end"))


def with_spans(docs: DataFrame, spans: DataFrame, text: str) -> DataFrame:
    """docs without the text, + `_framed`: its spans as JSON, a line break, the compressed text (null for a null text)."""
    both = pressed(keyed(docs, text), text).join(spans, list(KEY), "left").drop(*KEY)
    frame = F.concat(F.coalesce(F.to_json("_spans"), F.lit("[]")).cast("binary"), F.lit("\n").cast("binary"), F.col("_z"))
    return both.withColumn("_framed", frame).drop("_spans", "_z")


def unframed(framed: bytes | None) -> tuple[list[tuple[int, int]], bytes | None]:
    """The merged spans and the text of a `_framed` value."""
    if framed is None:
        return [], None
    head, _, body = framed.partition(b"\n")
    spans = merged([(s["first"], s["end"]) for s in json.loads(head)])
    return spans, zstandard.ZstdDecompressor().decompress(body)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out

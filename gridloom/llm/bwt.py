"""Suffix-array dedup: byte strings that occur anywhere else are removed, by merged BWTs.

Candidate passages (see `anchors`) of one shard are dealt into parts. Each part's Burrows-Wheeler
transform is made by itself, over symbols of eight bytes that are aligned at the passages' anchors: equal windows have
equal distances from their anchors, so they are cut into symbols alike. The transforms are merged by
refining their interleave: a round stably sorts the interleave by the symbols it reads from the
transforms, which orders all suffixes by one symbol more, and splits the intervals of suffixes
that agree so far. No suffix is sorted anew. After as many rounds as a window has whole symbols, the
intervals are the classes of suffixes whose common prefix is at least that long; the odd bytes before
and after split them into the classes of equal windows.

A null text is empty; empty and shorter texts keep all bytes. Copies, also of one row, remove each
other. Windows count bytes, so a cut can fall within a character; `cleaned` then keeps that character whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.anchors import KEY, Powers, Symbols, keyed, repeated, segments_of, unframed, with_spans
from gridloom.llm.common import BINARY, LONG, STRING, U64, mixed, with_text

LENGTH, K = 200, 64
SYMBOL = 8
#: Bytes of passages in one shard, and parts that it is dealt into.
SHARD_BYTES, PARTS = 1_000_000, 8


def sorted_by(values: np.ndarray) -> np.ndarray:
    """Stable order of values below 2**32, by two radix passes of 16 bits."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    high = values >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def transform(symbols: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """BWT and suffix array of strings that each end in a 0, sorted by `depth` symbols at least.

    first: start of each string, and the end. A suffix goes on at the start of its own string.
    """
    n = len(symbols)
    follow = np.arange(1, n + 1)
    follow[first[1:] - 1] = first[:-1]
    before = np.empty(n, np.int64)
    before[follow] = np.arange(n)
    rank, span = symbols.astype(np.int64), 1
    while span < depth:
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[follow], return_inverse=True)
        follow, span = follow[follow], span * 2
    suffix = np.argsort(rank, kind="stable")
    return symbols[before[suffix]], suffix


def interleave(parts: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Refine the interleave of BWTs: (part at each place, interval of suffixes with `rounds` common symbols)."""
    read = np.concatenate(parts)
    part = np.repeat(np.arange(len(parts), dtype=np.uint8), [len(p) for p in parts])
    interval, symbol = np.zeros(len(read), np.int64), read
    for _ in range(rounds):
        order = sorted_by(symbol)
        symbol, old = symbol[order], interval[order]
        part = part[order]
        interval[0] = 0
        interval[1:] = np.cumsum((symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1]))
        fresh = np.empty_like(symbol)
        fresh[np.argsort(part, kind="stable")] = read
        symbol = fresh
    return part, interval


def resolve(bodies: list[bytes], weights: np.ndarray, size: int) -> list[np.ndarray]:
    lead = segments_of(*Symbols("byte").hashes(bodies), size, min(K, size), Powers())["lead"]
    q, lengths = SYMBOL, np.array([len(b) for b in bodies])
    pad = -lead % q
    blocks = -(-(pad + lengths) // q)
    base = np.concatenate([[0], np.cumsum(blocks)])
    flat = np.zeros(base[-1] * q, np.uint8)
    source = np.concatenate([[0], np.cumsum(lengths)])
    spot = np.arange(source[-1]) + np.repeat(base[:-1] * q + pad - source[:-1], lengths)
    flat[spot] = np.frombuffer(b"".join(bodies), np.uint8)
    block = flat.view("<u8").astype(U64)
    rounds = (size - q + 1) // q

    # Symbols are dense numbers from 1; every passage ends in a 0.
    _, dense = np.unique(block, return_inverse=True)
    owner = np.repeat(np.arange(len(bodies)), blocks)
    string = np.zeros(len(block) + len(bodies), np.int64)
    string[np.arange(len(block)) + owner] = dense + 1
    start = base + np.arange(len(base))
    deal = np.searchsorted(start, np.linspace(0, start[-1], PARTS + 1)[1:-1]) if rounds else []
    bounds = sorted({0, len(bodies), *map(int, deal)})
    made = [transform(string[start[a] : start[b]], start[a : b + 1] - start[a], rounds) for a, b in zip(bounds, bounds[1:])]
    part, interval = interleave([m[0] for m in made], rounds)
    kind = np.empty(len(string), np.int64)
    kind[np.concatenate([m[1] + start[a] for m, a in zip(made, bounds)])] = interval[np.argsort(part, kind="stable")]

    # Windows: whole symbols from `whole` on, `head` bytes before and `tail` bytes after them.
    windows = lengths - size + 1
    own = np.repeat(np.arange(len(bodies)), windows)
    at = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows) + pad[own]
    odd = at % q
    whole = base[own] + -(-at // q)
    head = np.where(odd > 0, block[whole - 1] >> (odd * 8).astype(U64), U64(0))
    tail = size - -odd % q - rounds * q
    with np.errstate(over="ignore"):
        key = mixed(kind[whole + own].astype(U64) * U64(8) + odd.astype(U64)) + head
        for k in range(2):
            left = (tail - k * q).clip(0, q)
            there = block[np.minimum(whole + rounds + k, len(block) - 1)]
            key = mixed(key) + np.where(left == q, there, there & ((U64(1) << (left.clip(0, q - 1) * 8).astype(U64)) - U64(1)))
        key = mixed(key)
    _, group = np.unique(key, return_inverse=True)
    often = np.bincount(group, weights=weights[own])[group] > 1
    return np.split(often, np.cumsum(windows)[:-1])


def repeated_bytes(docs: DataFrame, length: int = LENGTH, text: str = "text", **limits: int) -> DataFrame:
    """Per document key: spans of bytes in windows that occur anywhere else."""
    rows = keyed(docs, text).select(*KEY, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    return repeated(rows, "byte", length, min(K, length), resolve, SHARD_BYTES, **limits)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def dedup(docs: DataFrame, length: int = LENGTH, text: str = "text", **limits: int) -> DataFrame:
    """docs + n_bytes, n_removed, removed (maximal runs of bytes), kept_sha256, kept (bytes that stay)."""
    framed = with_spans(docs, repeated_bytes(docs, length, text, **limits), text)

    def make():
        def work(parts: list[bytes | None]):
            out = [[], [], [], [], [], []]
            for part in parts:
                spans, whole = unframed(part)
                body = whole or b""
                edge = [0, *(x for s in spans for x in s), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edge[0::2], edge[1::2]))
                row = (
                    len(body), len(body) - len(kept), [{"start": a, "end": b} for a, b in spans], hashlib.sha256(kept).hexdigest(), kept,
                    None if whole is None else body.decode(),
                )
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    fields = [("n_bytes", LONG), ("n_removed", LONG), ("removed", SPANS), ("kept_sha256", STRING), ("kept", BINARY), (text, STRING)]
    return with_text(framed, "_framed", fields, make).drop("_framed")


def cleaned(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """The columns of docs, the text without its repeated spans; characters are kept or removed as a whole."""
    framed = with_spans(docs, repeated_bytes(docs, length, text), text)

    def make():
        def work(parts: list[bytes | None]):
            out = []
            for part in parts:
                spans, body = unframed(part)
                if body is None:
                    out.append(None)
                    continue
                kept, at = [], 0
                for a, b in spans:
                    while a < b and body[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(body) and body[b] & 0xC0 == 0x80:
                        b -= 1
                    kept.append(body[at:a])
                    at = b
                out.append((b"".join(kept) + body[at:]).decode())
            return [out]

        return work

    made = with_text(framed, "_framed", [(text, STRING)], make)
    return made.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")

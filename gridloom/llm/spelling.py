"""Spelling variants: words one edit apart, found by dense comparison of prefixes and suffixes.

1. Runs of letters are counted per task and combined before the shuffle; a share of them, chosen by a
   hash of document and run, loses one code point (`typo`), which gives the query variants to find.
2. Two words are one edit apart if the lengths of their common prefix and suffix together reach the longer
   length minus one. Words are compared in tiles of two blocks: padded matrices of code points, from the left
   for prefixes and from the right for suffixes.
3. Which tiles: an edit lies either behind the first half of a word or within it. So words meet in two groups,
   those of equal first and those of equal second halves, by the length of the shorter word. A group beyond
   GROUP words is halved again by the same rule, until the place of the edit is known up to one code point
   (which bounds the group by the alphabet). A pair of words belongs to just one group, so nothing is counted twice.
4. A word's form is its most frequent near word, if frequent enough; roots are found by pointer doubling.

Defined results: a null text has no words; a null id counts as an empty one; equal rows count as often as they
occur; an empty table gives no rows; other columns are not carried along. Runs of any length are compared,
in tiles that shrink with the length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import settled, slices, small_batches, stored

MIN_CHARS, MIN_COUNT, FORM_RATIO, TYPO = 6, 5, 5, 199
#: Words of one group before it is halved, and rows of one shard (about).
GROUP, SHARD = 2_048, 16_384
#: Rows of a block, elements of a tile, distinct words a task holds before it passes them on.
BLOCK, TILE, HELD = 64, 1 << 20, 1 << 17

# Lower-cased UTF-8: a-z, or U+00C0 to U+00FF, which all start with the byte C3.
_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NO_CAP = 1 << 30


def _typed(run: bytes, at: int) -> bytes:
    word = run.decode()
    return (word[:at] + word[at + 1:]).encode()


def counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", typo: int = TYPO, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, n): partial counts, several rows per word."""
    small_batches(docs.sparkSession)

    def emit(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "_text"):
                for key, body in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist()):
                    if not body:
                        continue
                    seed = zlib.crc32(f"{key or ''}:".encode())
                    for word, n in Counter(_RUN.findall(body.translate(_LOWER))).items():
                        if len(word) < min_chars:
                            continue
                        size = len(word) - word.count(b"\xc3")
                        h = zlib.crc32(word, seed)
                        if h % typo == 0:
                            word, size = _typed(word, h % size), size - 1
                        if size >= min_chars:
                            held[word] += n
                if len(held) > HELD:
                    yield emit(held)
                    held.clear()
        yield emit(held)

    source = docs.select(F.col(f"`{id_col}`").cast("string").alias("_id"), F.col(f"`{text}`").cast("binary").alias("_text"))
    return source.mapInArrow(run, "word string, n bigint")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT, **how) -> DataFrame:
    """(word, n) of all words that occur at least `min_count` times."""
    found = counts(docs, id_col, text, **how).groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the two groups of its next halving.

    Rows agree on `p` first and `q` last code points, the edit lies between. Either it lies behind the first
    half of what is between (child one), or within it (child two, for pairs whose common prefix is below `cap`).
    """
    rest = F.col("m") - F.col("p") - F.col("q")
    half = F.shiftright(rest, 1)
    child = F.explode(F.array(
        F.struct((F.col("p") + half).alias("p"), F.col("q").alias("q"), F.col("cap").alias("cap")),
        F.struct(F.col("p").alias("p"), (F.col("q") + rest - half).alias("q"), (F.col("p") + half).alias("cap")),
    ))
    made = rows.select("word", "n", "longer", "m", child.alias("c")).select("word", "n", "longer", "m", "c.p", "c.q", "c.cap")
    return made.withColumn("key", F.xxhash64("m", "p", "q", "cap", F.expr("substring(word, 1, p)"), F.expr("right(word, q)")))


def groups(vocab: DataFrame, limit: int = GROUP) -> DataFrame:
    """Rows (word, n, longer, m, p, q, cap, key): all near words share at least one key, and count under just one."""
    size = F.char_length("word")
    role = F.explode(F.array(F.struct(size.alias("m"), F.lit(False).alias("longer")), F.struct((size - 1).alias("m"), F.lit(True).alias("longer"))))
    start = vocab.select("word", "n", role.alias("r")).select(
        "word", "n", "r.longer", "r.m", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(_NO_CAP).alias("cap"))
    level, done = _halved(start.where("m > 0")), []
    while True:
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("m") - F.col("p") - F.col("q")).alias("rest"))
        crowded = settled(sizes.where((F.col("size") > limit) & (F.col("rest") > 1)).select("key"))
        found = crowded.count()
        if not found:
            done.append(level)
            break
        if found <= 100_000:
            crowded = F.broadcast(crowded)
        done.append(level.join(crowded, "key", "left_anti"))
        level = _halved(level.join(crowded, "key", "left_semi"))
    made = done[0]
    for more in done[1:]:
        made = made.unionByName(more)
    return made


def _padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points from the left and from the right, padded by 0."""
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros((len(words), width), np.uint32)
    for i, word in enumerate(words):
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        left[i, : len(points)] = points
        right[i, : len(points)] = points[::-1]
    return left, right


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of all rows of a with all rows of b."""
    differ = a[:, None, :] != b[None, :, :]
    return np.where(differ.any(axis=2), differ.argmax(axis=2), a.shape[1])


def near_in_shard(table: pa.Table) -> pa.Table:
    """Per row with near words: how many of them fall in its group, and the best (largest n, then smallest word)."""
    words = np.array(table.column("word").to_pylist(), object)
    n, key, longer, m, p, q, cap = (table.column(c).to_numpy() for c in ("n", "key", "longer", "m", "p", "q", "cap"))
    order = np.lexsort((key, m))
    # Groups of one row, or without a word of the shorter length, have no pairs.
    _, group, size = np.unique(key[order], return_inverse=True, return_counts=True)
    short = np.bincount(group, weights=~longer[order])
    order = order[(size[group] > 1) & (short[group] > 0)]
    words, n, key, longer, m, p, q, cap = (x[order] for x in (words, n, key, longer, m, p, q, cap))
    total = len(words)
    count, none = np.zeros(total, np.int64), total
    rank = np.empty(total, np.int64)
    by_rank = sorted(range(total), key=lambda i: (-n[i], words[i]))
    rank[by_rank] = np.arange(total)
    best = np.full(total, none)
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if total else np.zeros(0, int)
    end = last[np.searchsorted(last, np.arange(total))] + 1
    at = 0
    while at < total:
        width = int(m[min(at + BLOCK, total) - 1]) + 2
        step = min(BLOCK, max(1, isqrt(TILE // width)))
        a = slice(at, min(at + step, total))
        left_a, right_a = _padded(list(words[a]), width)
        for other in range(at, int(end[a.stop - 1]), step):
            b = slice(other, min(other + step, int(end[a.stop - 1])))
            width_b = max(width, int(m[b.stop - 1]) + 2)
            left_b, right_b = (left_a, right_a) if b == a else _padded(list(words[b]), width_b)
            x, y = (left_a, right_a) if width_b == width else _padded(list(words[a]), width_b)
            prefix, suffix = _shared(x, left_b), _shared(y, right_b)
            long = m[a, None] + (longer[a, None] | longer[None, b])
            near = (
                (prefix + suffix >= long - 1) & (key[a, None] == key[None, b]) & ~(longer[a, None] & longer[None, b])
                & (prefix >= p[a, None]) & (suffix >= q[a, None]) & (prefix < cap[a, None]) & (words[a, None] != words[None, b])
            )
            count[a] += near.sum(axis=1)
            best[a] = np.minimum(best[a], np.where(near, rank[None, b], none).min(axis=1))
            if b != a:
                count[b] += near.sum(axis=0)
                best[b] = np.minimum(best[b], np.where(near, rank[a, None], none).min(axis=0))
        at = a.stop
    hit = np.flatnonzero(count)
    top = np.array(by_rank, dtype=np.int64)[best[hit]] if len(hit) else hit
    return pa.table({
        "word": pa.array(words[hit].tolist(), pa.string()), "near": pa.array(count[hit]),
        "best_n": pa.array(n[top].astype(np.int64)), "best": pa.array(words[top].tolist(), pa.string()),
    })


def neighbours(vocab: DataFrame, limit: int = GROUP) -> DataFrame:
    """(word, n_near, best, best_n) of all words that have near words."""
    rows = groups(vocab, limit)
    shards = 4 * vocab.count() // SHARD + 1
    found = rows.withColumn("shard", F.pmod(F.col("key"), F.lit(shards))).groupBy("shard").applyInArrow(
        near_in_shard, "word string, near bigint, best_n bigint, best string")
    # Largest n first, then the smallest word: least of (-n, word).
    least: Column = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), least.alias("b"))
    return merged.select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.minus")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to.

    Doubling: after k rounds a pointer spans 2^k forms. The number of occurrences grows with every form, so
    there are no rings.
    """
    up = stored(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = stored(up.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        up = step.select("word", "root")
        if step.where("_moved").isEmpty():
            return up


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ratio: int = FORM_RATIO, limit: int = GROUP, **how) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the whole vocabulary."""
    vocab = stored(vocabulary(docs, id_col, text, **how))
    joined = vocab.join(neighbours(vocab, limit), "word", "left")
    is_form = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    made = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    found = roots(made.where("form is not null"))
    return made.join(found, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, one scan of the text.

Normalisation lower-cases A-Z and takes words; an item's windows of n words (all its words if it
has fewer) are the patterns. A document word inside any occurrence is hit.

Null, empty and word-free texts have no words, hits or windows. A null item id still contributes
its windows but is not listed; repeated items count once. Repeated documents give repeated rows.
Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import BOOL, LONG, STRING, WORD_BYTES, with_text, words

#: Most pattern characters in one automaton (some 100 bytes of memory each at worst).
MAX_PATTERN_CHARS = 4_000_000
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def compiled(held: dict) -> ahocorasick.Automaton:
    """The automaton of a broadcast {"patterns": ...}, built once in each worker and kept beside them."""
    if "machine" not in held:
        machine = ahocorasick.Automaton()
        for pattern, value in held["patterns"].items():
            machine.add_word(pattern.decode("latin-1"), value)
        machine.make_automaton()
        held["machine"] = machine
    return held["machine"]


def windows(rows: Iterator[tuple[str | None, str | None]], n: int) -> dict[bytes, tuple[int, tuple[str, ...]]]:
    """Window -> (number of words, ids of the items that have it)."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in rows:
        got = words(text.encode() if text is not None else None)
        size = min(n, len(got))
        for i in range(len(got) - size + 1 if got else 0):
            ids = found.setdefault(b" %b " % b" ".join(got[i : i + size]), (size, set()))[1]
            if item is not None:
                ids.add(item)
    return {k: (size, tuple(sorted(ids))) for k, (size, ids) in found.items()}


def decontaminate(
    docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", max_chars: int = MAX_PATTERN_CHARS,
) -> DataFrame:
    """docs + n_words, n_hit, hit_items (sorted ids), hit_spans (code points of the original), contaminated.

    The patterns' size is counted first; beyond `max_chars` the items are dealt into groups of that
    size at most (one item larger than it is a group of its own), each an automaton that the same
    scan goes through.
    """
    pairs = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct()
    size = pairs.agg(F.sum(F.length("t") * n)).first()[0] or 0
    groups = -(-size // max_chars) or 1
    spark = docs.sparkSession
    # One automaton per pass over the driver: a group is bounded by max_chars, and so is each broadcast.
    shipped = []
    for g in range(groups):
        part = pairs.where(F.pmod(F.xxhash64("t"), F.lit(groups)) == g) if groups > 1 else pairs
        shipped.append(spark.sparkContext.broadcast({"patterns": windows(map(tuple, part.toLocalIterator()), n)}))

    def make():
        def work(texts: list[bytes | None]):
            out = [[], [], [], [], []]
            for raw in texts:
                raw = raw or b""
                flat = raw.translate(WORD_BYTES)
                got = flat.split()
                joined = (b" %b " % b" ".join(got)).decode("latin-1")
                ids: set[str] = set()
                marks = None
                for held in shipped:
                    machine = compiled(held.value)
                    if not len(machine):
                        continue
                    for end, (count, names) in machine.iter(joined):
                        if marks is None:
                            gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
                            marks = np.zeros(len(got) + 1, np.int64)
                        last = int(np.searchsorted(gaps, end))
                        marks[last - count] += 1
                        marks[last] -= 1
                        ids.update(names)
                hit = np.cumsum(marks[:-1]) > 0 if marks is not None else np.zeros(0, bool)
                out[0].append(len(got))
                out[1].append(int(hit.sum()))
                out[2].append(sorted(ids))
                out[3].append(_spans(raw, flat, hit) if marks is not None else [])
                out[4].append(bool(hit.any()))
            return out

        return work

    fields = [("n_words", LONG), ("n_hit", LONG), ("hit_items", T.ArrayType(STRING)), ("hit_spans", SPAN), ("contaminated", BOOL)]
    return with_text(docs, text, fields, make)


def _spans(raw: bytes, flat: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as code point offsets of the original text."""
    solid = np.concatenate([[0], (np.frombuffer(flat, np.uint8) != 32).view(np.int8), [0]])
    edge = np.flatnonzero(np.diff(solid))
    start, end = edge[0::2], edge[1::2]
    runs = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[start[a]]), "end": int(chars[end[b - 1]])} for a, b in zip(runs[0::2], runs[1::2])]


def clean(docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text") -> DataFrame:
    """The documents without any occurrence of a benchmark window."""
    return decontaminate(docs, items, n, text).where("not contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated",
    )

"""Substring dedup with suffix automata: word sequences that occur anywhere else are removed.

Reference shards are runs of candidate passages (see `anchors`) of bounded size. Each shard's texts
make one suffix automaton with occurrence counts; the passages are streamed through it, and the
matching statistics, cut at the window length, tell at each word whether the window that ends there
occurs twice or more. Maximal runs of words in such windows are removed, judged on the input.

Every passage is streamed only through the shard that holds all passages of its anchor, where an
equal window must be; sending all automata to all documents would do the work once per shard.

Words lie between ASCII white space and are compared as they are. Null, empty and shorter texts keep
all words. Copies, also of one row, remove each other. Kept words are joined by one space.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.anchors import KEY, keyed, repeated, unframed, with_spans
from gridloom.llm.common import LONG, STRING, with_text

LENGTH, K = 35, 10
#: Words of one reference shard; a word costs some 500 bytes in the automaton.
SHARD_WORDS = 40_000


class SuffixAutomaton:
    """Of several sequences; each state knows how often its strings occur, by weight."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def _state(self, next_: dict, link: int, length: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.len.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """A state for the longest string of p extended by the symbol, taken out of q."""
        nxt, link, length = self.next, self.link, self.len
        clone = self._state(dict(nxt[q]), link[q], length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = clone
            p = link[p]
        return clone

    def add(self, sequence: list, weight: int) -> None:
        nxt, link, length = self.next, self.link, self.len
        last = 0
        for symbol in sequence:
            q = nxt[last].get(symbol)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, symbol, q)
            else:
                new, p = self._state({}, 0, length[last] + 1), last
                while p >= 0 and symbol not in nxt[p]:
                    nxt[p][symbol] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][symbol]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
                last = new
            self.count[last] += weight

    def close(self) -> None:
        """Sum the counts along the suffix links, longest strings first."""
        count, link = self.count, self.link
        for s in sorted(range(1, len(link)), key=self.len.__getitem__, reverse=True):
            count[link[s]] += count[s]

    def occurrences(self, sequence: list, size: int) -> list[int]:
        """Of each run of `size` symbols (0 where the automaton lacks it)."""
        nxt, link, length, count = self.next, self.link, self.len, self.count
        state = matched = 0
        out = []
        for i, symbol in enumerate(sequence):
            while state and symbol not in nxt[state]:
                state = link[state]
                matched = length[state]
            if symbol in nxt[state]:
                state, matched = nxt[state][symbol], matched + 1
            while length[link[state]] >= size if state else False:
                state = link[state]
                matched = length[state]
            if i >= size - 1:
                out.append(count[state] if matched >= size else 0)
        return out


def resolve(bodies: list[bytes], weights: np.ndarray, size: int) -> list[np.ndarray]:
    automaton = SuffixAutomaton()
    contents = [b.split(b" ") for b in bodies]
    for words, n in zip(contents, weights.tolist()):
        automaton.add(words, n)
    automaton.close()
    return [np.array(automaton.occurrences(words, size)) > 1 for words in contents]


def repeated_words(docs: DataFrame, length: int = LENGTH, text: str = "text", **limits: int) -> DataFrame:
    """Per document key: spans of words in windows that occur anywhere else."""
    rows = keyed(docs, text).select(*KEY, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    return repeated(rows, "word", length, min(K, length), resolve, SHARD_WORDS, **limits)


def dedup(docs: DataFrame, length: int = LENGTH, text: str = "text", **limits: int) -> DataFrame:
    """docs + n_words, n_removed, kept_sha256, kept (the kept words, joined by one space)."""
    framed = with_spans(docs, repeated_words(docs, length, text, **limits), text)

    def make():
        def work(parts: list[bytes | None]):
            out = [[], [], [], [], []]
            for part in parts:
                spans, body = unframed(part)
                words = (body or b"").split()
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                joined = b" ".join(kept)
                row = (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode(), None if body is None else body.decode())
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return work

    fields = [("n_words", LONG), ("n_removed", LONG), ("kept_sha256", STRING), ("kept", STRING), (text, STRING)]
    return with_text(framed, "_framed", fields, make).drop("_framed")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")

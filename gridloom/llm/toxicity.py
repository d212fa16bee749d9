"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, strips accents, maps homoglyphs to Latin letters, and digits and signs that
stand between or before letters to the letters they resemble. Entries are whole words or word
beginnings; each weighs its smoothed log-odds among the labelled documents. Word pairs in which an
entry is harmless are exception phrases, matched by the same automaton, and cancel the entry. The
weights of all matches are summed, divided by a power of the number of words, and turned into a score by
a logistic curve; weights and curve are then fitted together to the labels, starting from the log-odds.

Null, empty and word-free texts have no matches and get the score of such a text. Labels that are
null or belong to no document are not used; without both kinds of label every score is the same.
Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import DOUBLE, LONG, STRING, stored, with_text
from gridloom.llm.training import held_out, labelled, minimise, totals

#: Features that a task counts before it passes them on.
MAX_COUNTED = 500_000
#: Bounds on lexicon and exceptions, and with them on what is broadcast.
MAX_ENTRIES = 4_000
#: Least log-odds of an entry.
MIN_ODDS = 1.5
LENGTH_POWER = 0.5
STEPS, RIDGE = 60, 1e-3
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3

# Look-alike letters, then digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g",
    "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

_FOLD = str.maketrans(HOMOGLYPHS)
_SIGN = re.compile(r"(?<![0-9])[013457@$!|](?=[a-z])|(?<=[a-z])[013457@$!|](?=[0-9@$!|]?[a-z])|(?<=[a-z])[013457@$](?![0-9\w])")
_REST = re.compile(r"[^\w]+|_+")
_MARKS = re.compile(r"[̀-ͯ​-‏⁠﻿­]+")


def folded(text: str) -> str:
    """The words of a text after folding, each with one space before and after."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).translate(_FOLD)
    text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {_REST.sub(' ', text).strip()} "


def candidates(text: str) -> set[str]:
    """What could be an entry: ' word ' or ' beginning', in the notation of the automaton."""
    got = set(text.split())
    return {f" {w} " for w in got if len(w) > 2} | {f" {w[:n]}" for w in got for n in PREFIXES if len(w) >= n}


def _count(rows: DataFrame, features) -> DataFrame:
    """feature -> (toxic, clean) documents that have it; summed within each task, MAX_COUNTED features at a time, before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = (Counter(), Counter())

        def parts() -> Iterator[pa.RecordBatch]:
            names = list(totals[0].keys() | totals[1].keys())
            for k in range(0, len(names), 50_000):
                part = names[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array([t[x] for x in part], pa.int64()) for t in totals]], ["feature", "toxic", "clean"])
            for t in totals:
                t.clear()

        for batch in batches:
            for text, label in zip(batch.column("_flat").to_pylist(), batch.column("_label").to_pylist()):
                totals[0 if label else 1].update(features(text))
                if len(totals[0]) + len(totals[1]) > MAX_COUNTED:
                    yield from parts()
        yield from parts()

    made = rows.select("_flat", "_label").mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return made.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def lexicon(rows: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries and weights. An entry must be so one-sided that chance gives few such among all candidates."""
    counts = _count(rows, candidates).where("toxic + clean >= 3").persist()
    n = counts.count()
    share = n_toxic / (n_toxic + n_clean)
    # Log-likelihood ratio against the common share of toxic documents.
    part = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(part / share) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    best = counts.where("toxic > 0").where(part > share).select("*", gain.alias("gain")).where(F.col("gain") >= math.log(max(n, 2)))
    found = {r.feature: (r.toxic, r.clean) for r in best.orderBy(F.desc("gain"), "feature").limit(MAX_ENTRIES).collect()}
    counts.unpersist()
    # A beginning yields to a longer entry that has nearly all its documents; what a beginning still covers goes.
    longer: dict[str, int] = {}
    for entry, (toxic, _) in found.items():
        stem = entry.rstrip()
        for k in range(4, len(stem) + 1):
            if stem[:k] != entry:
                longer[stem[:k]] = max(longer.get(stem[:k], 0), toxic)
    kept = {e: c for e, c in found.items() if e.endswith(" ") or longer.get(e, 0) < 0.9 * c[0]}
    weights = {e: _odds(*c, n_toxic, n_clean) for e, c in kept.items()}
    weights = {e: w for e, w in weights.items() if w >= MIN_ODDS}
    return {
        e: w for e, w in weights.items()
        if not any(weights.get(e.rstrip()[:k], -9) >= w - 0.5 for k in range(4, len(e.rstrip()) + 1) if e.rstrip()[:k] != e)
    }


def automaton(weights: dict[str, float], exceptions: list[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for entry, weight in weights.items():
        machine.add_word(entry, (entry, weight))
    for phrase in exceptions:
        machine.add_word(phrase, (phrase, None))
    machine.make_automaton()
    return machine


def matches(machine: ahocorasick.Automaton, text: str) -> list[tuple[int, str, float]]:
    """(place, entry, weight) of the entries in a folded text that no exception phrase covers."""
    if not len(machine):
        return []
    found, spared = [], []
    for end, (entry, weight) in machine.iter(text):
        start = end + 1 - len(entry)
        if weight is None:
            spared.append((start, end + 1))
        else:
            found.append((start, entry, weight))
    return [m for m in found if not any(a <= m[0] and m[0] + len(m[1]) <= b for a, b in spared)]


def exception_phrases(rows: DataFrame, weights: dict[str, float]) -> list[str]:
    """Pairs of an entry's word with its neighbour that only clean documents have (three at least)."""
    held = rows.sparkSession.sparkContext.broadcast({"weights": weights})

    def pairs(text: str) -> set[str]:
        box = held.value
        if "machine" not in box:
            box["machine"] = automaton(box["weights"], [])
        machine = box["machine"]
        out = set()
        for start, _, _ in matches(machine, text):
            stop = text.index(" ", start + 1)
            after = text.find(" ", stop + 1)
            if after > 0:
                out.add(text[start : after + 1])
            if start:
                out.add(text[text.rfind(" ", 0, start) : stop + 1])
        return out

    harmless = _count(rows, pairs).where("toxic = 0 and clean >= 3").orderBy(F.desc("clean"), "feature").limit(MAX_ENTRIES)
    return [r.feature for r in harmless.collect()]


class Model:
    """Lexicon, exceptions and curve; small and shipped as plain values."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: tuple[float, float]):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve


def _strength(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """docs + n_matches and strength: the length-normalised sum of weights."""
    weights, exceptions = model.weights, model.exceptions

    def make():
        machine = automaton(weights, exceptions)

        def work(texts: list[bytes | None]):
            counts, sums = [], []
            for raw in texts:
                flat = folded(raw.decode()) if raw else " "
                got = matches(machine, flat)
                counts.append(len(got))
                sums.append(sum(m[2] for m in got) / max(flat.count(" ") - 1, 1) ** LENGTH_POWER)
            return [counts, sums]

        return work

    return with_text(docs, text, [("n_matches", LONG), ("strength", DOUBLE)], make)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text") -> Model:
    """On all labelled rows; the driver gets the lexicon, counts and sums."""

    def make():
        return lambda texts: [[folded(raw.decode()) if raw else " " for raw in texts]]

    rows = with_text(labelled(docs, labels, label, text), "_text", [("_flat", STRING)], make)
    rows = stored(rows.select("_flat", F.when(F.col("_label") > 0, 1).otherwise(0).alias("_label")))
    sizes = {r._label: r.n for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, [], (0.0, 0.0))
    weights = lexicon(rows, n_toxic, n_clean)
    exceptions = exception_phrases(rows, weights)
    entries = sorted(weights)
    matched = stored(_matched(rows, weights, exceptions, entries).where(F.size("_entries") > 0).select("_label", "_scale", "_entries"))
    found = {r._label: r.n for r in matched.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    fitted, base = refined(matched, (n_toxic - found.get(1, 0), n_clean - found.get(0, 0)), n_toxic, n_toxic + n_clean, np.array([weights[e] for e in entries]))
    return Model(dict(zip(entries, fitted.tolist())), exceptions, (1.0, base))


def _matched(rows: DataFrame, weights: dict[str, float], exceptions: list[str], entries: list[str]) -> DataFrame:
    """rows + _entries (number of the entry of each match) and _scale (what its weight is multiplied by)."""
    number = {e: k for k, e in enumerate(entries)}

    def make():
        machine = automaton(weights, exceptions)

        def work(texts: list[bytes]):
            found, scale = [], []
            for raw in texts:
                flat = raw.decode()
                found.append([number[m[1]] for m in matches(machine, flat)])
                scale.append(max(flat.count(" ") - 1, 1) ** -LENGTH_POWER)
            return [found, scale]

        return work

    return with_text(rows, "_flat", [("_entries", T.ArrayType(LONG)), ("_scale", DOUBLE)], make)


def _slips(w: np.ndarray):
    """Logistic loss and its gradient; the last weight is the intercept."""

    def work(batch: pa.RecordBatch) -> np.ndarray:
        y, scale = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("_label", "_scale"))
        lists = batch.column("_entries")
        row = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy(zero_copy_only=False))
        entry = lists.flatten().to_numpy(zero_copy_only=False)
        z = np.bincount(row, w[entry] * scale[row], len(y)) + w[-1]
        slip = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        return np.concatenate([[(np.logaddexp(0, z) - y * z).sum()], np.bincount(entry, slip[row] * scale[row], len(w) - 1), [slip.sum()]])

    return work


def refined(matched: DataFrame, others: tuple[int, int], n_toxic: int, n: int, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of least logistic loss, from `start`; a ridge holds them near it.

    `others`: numbers of toxic and clean rows without a match, which are all alike.
    """
    share = n_toxic / n
    first = np.append(start, np.log((share + 1e-3) / (1 - share + 1e-3)))

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        got, away = totals(matched, len(w) + 1, _slips, w), np.append(w[:-1] - start, 0.0)
        value, grad = got[0], got[1:].copy()
        value += others[0] * np.logaddexp(0, -w[-1]) + others[1] * np.logaddexp(0, w[-1])
        grad[-1] += sum(others) / (1 + np.exp(-np.clip(w[-1], -500, 500))) - others[0]
        return float(value + RIDGE / 2 * (away @ away)) / n, (grad + RIDGE * away) / n

    w = minimise(loss, first, STEPS)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs + n_matches, strength, score (0 to 1), predicted."""
    slope, base = model.curve
    made = _strength(docs, model, text)
    return made.withColumn("score", 1 / (1 + F.exp(-(F.col("strength") * slope + base)))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_matches")

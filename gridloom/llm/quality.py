"""Quality: Bradley-Terry ranking from preference pairs, cut at a quantile of the scores.

Each labelled good document is preferred to a bad one; the document score is linear in binned
features, and its weights minimise the logistic loss of score differences over such pairs: all labelled
rows are dealt into blocks, and all pairs within a block count, so the work is linear in the rows. The
cut is the quantile of the training scores at the share of bad labels; a logistic curve through it
maps scores to 0..1 so that the cut lies at the threshold.

Null and empty texts have the features of an empty text. Labels that are null or belong to no
document are not used; without both kinds of label every score is the same, at the threshold.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import DOUBLE, stored, with_text
from gridloom.llm.training import held_out, labelled, logistic_curve, minimise, totals

#: Rows among which all pairs are formed, and how many of a rare label each such block has at least (all, if there are fewer).
BLOCK_ROWS, MIN_RARE = 1024, 32
RIDGE = 1e-4
SCORE_BINS = 1 << 14
THRESHOLD = 0.7
BINS = 6
PRINTABLE = np.r_[10, 32:127]


def features(raw: bytes | None) -> np.ndarray:
    """Numbers that describe form, not topic: shares of characters, word and line shapes, repetition."""
    raw = raw or b""
    size = max(len(raw), 1)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(int(hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum()), 1)
    parts = raw.split()
    n = max(len(parts), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) if parts else np.zeros(1)
    pairs = set(zip(parts, parts[1:]))
    ends = np.bincount(np.fromiter((p[-1] for p in parts), np.int64, len(parts)), minlength=256) if parts else np.zeros(256)
    word_end = ends[48:58].sum() + ends[65:91].sum() + ends[97:123].sum() + ends[128:].sum()
    return np.concatenate([
        hist[PRINTABLE] / size,
        [
            math.log1p(len(raw)), math.log1p(len(parts)), hist[128:].sum() / size, hist[65:91].sum() / letters,
            hist[48:58].sum() / size, (hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()) / size,
            len(set(parts)) / n, len(pairs) / max(len(parts) - 1, 1), len(set(lines)) / max(len(lines), 1),
            math.log1p(len(lines)) - math.log1p(len(parts)), lengths.mean(), lengths.std(), lengths.max(),
            word_end / n, sum(map(bytes.isupper, parts)) / n, sum(map(bytes.istitle, parts)) / n,
            sum(a == b for a, b in zip(parts, parts[1:])) / n, len(zlib.compress(raw, 1)) / size,
        ],
    ])


class Ranking:
    """Bin edges, weights, cut and slope."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, cut: float, slope: float):
        self.edges, self.weights, self.cut, self.slope = edges, weights, cut, slope

    def scores(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges) @ self.weights


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One indicator for each edge of each feature that the value exceeds."""
    return (x[:, :, None] > edges[None]).reshape(len(x), -1).astype(np.float32)


def _blocks(bits: DataFrame, sizes: dict[bool, int]) -> DataFrame:
    """(good, bits, counts): all rows dealt by hash into blocks of about BLOCK_ROWS, the good ones first.

    Of a rare label, rows go to as many blocks as it takes for some MIN_RARE in each, so that every row has opponents.
    """
    n = max(1, -(-sum(sizes.values()) // BLOCK_ROWS))
    copies = {k: min(n, -(-MIN_RARE * n // size)) for k, size in sizes.items()}
    place = F.xxhash64("_bits", "_label")
    turn = F.explode(F.when(F.col("_label") > 0, F.sequence(F.lit(0), F.lit(copies[True] - 1))).otherwise(F.sequence(F.lit(0), F.lit(copies[False] - 1))))
    stride = F.when(F.col("_label") > 0, n // copies[True]).otherwise(n // copies[False])
    dealt = bits.select("*", turn.alias("_turn")).withColumn("_block", F.pmod(place + F.col("_turn") * stride, F.lit(n)))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_label", "_bits"], ascending=False)
        return pd.DataFrame({"good": [int((pdf["_label"] > 0).sum())], "bits": [b"".join(pdf["_bits"])], "counts": [pdf["_n"].to_numpy(float)]})

    made = dealt.select("_block", "_label", "_bits", "_n").groupBy("_block").applyInPandas(join, "good int, bits binary, counts array<double>")
    return stored(made)


def _opened(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(good rows, indicators, counts) of each block."""
    for row in batch.to_pylist():
        count = np.array(row["counts"])
        raw = np.frombuffer(row["bits"], np.uint8).reshape(len(count), -1)
        yield row["good"], np.unpackbits(raw, axis=1, count=size).astype(np.float32), count


def _pair_loss(w: np.ndarray):
    """Number of pairs, their logistic loss and its gradient."""

    def work(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(len(w) + 2)
        for good, x, count in _opened(batch, len(w)):
            s = x @ w
            e = np.exp(np.clip(s[None, good:] - s[:good, None], -60, 60))
            pairs = np.outer(count[:good], count[good:])
            slip = e / (1 + e) * pairs
            out[0] += pairs.sum()
            out[1] += (np.log1p(e) * pairs).sum()
            out[2:] += slip.sum(0) @ x[good:] - slip.sum(1) @ x[:good]
        return out

    return work


def _spread(low: float, high: float):
    """Counts of good and bad rows in SCORE_BINS bins of the score."""

    def make(w: np.ndarray):
        def work(batch: pa.RecordBatch) -> np.ndarray:
            out = np.zeros((2, SCORE_BINS))
            for good, x, count in _opened(batch, len(w)):
                at = ((x @ w - low) / (high - low) * SCORE_BINS).astype(int).clip(0, SCORE_BINS - 1)
                for k, part in enumerate((slice(None, good), slice(good, None))):
                    out[k] += np.bincount(at[part], count[part], SCORE_BINS)
            return out.ravel()

        return work

    return make


def rank(rows: DataFrame, size: int) -> Ranking | None:
    """Fit on all rows (_x, _label): edges, pairs, cut and curve each from sums over all of them.

    A pair is a good and a bad row of one block (see `_blocks`); every row has pairs. Equal indicators count as one row with its number.
    """
    probs = np.linspace(0.02, 0.98, BINS).tolist()
    cuts = rows.agg(*[F.percentile_approx(F.get("_x", F.lit(k)), probs, 2000).alias(f"_{k}") for k in range(size)]).first()
    if cuts[0] is None:
        return None
    edges = np.array(cuts, float)

    def indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            packed = np.packbits(binned(x, edges).astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.array([p.tobytes() for p in packed], pa.binary())], ["_label", "_bits"])

    made = rows.select("_x", F.when(F.col("_label") > 0, 1).otherwise(0).alias("_label")).mapInArrow(indicators, "_label int, _bits binary")
    bits = stored(made.groupBy("_label", "_bits").agg(F.count(F.lit(1)).alias("_n")))
    found = {r._label > 0: (r.rows, r.n) for r in bits.groupBy("_label").agg(F.count(F.lit(1)).alias("rows"), F.sum("_n").alias("n")).collect()}
    if len(found) < 2:
        return None
    blocks = _blocks(bits, {k: v[0] for k, v in found.items()})
    width = edges.size

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        got = totals(blocks, width + 2, _pair_loss, w)
        return got[1] / got[0] + RIDGE / 2 * float(w @ w), got[2:] / got[0] + RIDGE * w

    w = minimise(loss, np.zeros(width))
    low, high = float(w.clip(max=0).sum()), float(w.clip(min=0).sum()) + 1e-9
    # Rows of a rare label are in several blocks: their counts are brought back to the true ones.
    good, bad = totals(blocks, 2 * SCORE_BINS, _spread(low, high), w).reshape(2, -1)
    good, bad = good * found[True][1] / good.sum(), bad * found[False][1] / bad.sum()
    top = low + np.arange(1, SCORE_BINS + 1) * (high - low) / SCORE_BINS
    middle = top - (high - low) / SCORE_BINS / 2
    # Between the ranks on either side of the share of bad labels, to the width of a bin.
    upto, n_bad = np.cumsum(good + bad), bad.sum()
    below, above = middle[np.searchsorted(upto, [n_bad - 0.5, n_bad + 0.5])]
    cut = float(below + (1 - n_bad / upto[-1]) * (above - below))
    y = np.repeat([1.0, 0.0], SCORE_BINS)
    slope = max(logistic_curve(np.tile(middle, 2), y, weight=np.concatenate([good, bad]))[0], 1e-3)
    return Ranking(edges, w, cut, slope)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> Ranking | None:
    """On all labelled rows; the driver gets sums, edges and weights."""

    def make():
        return lambda texts: [[features(t).tolist() for t in texts]]

    rows = with_text(labelled(docs, labels, label, text), "_text", [("_x", T.ArrayType(DOUBLE))], make).select("_x", "_label")
    return rank(stored(rows), len(features(None)))


def score(docs: DataFrame, model: Ranking | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs + rank_score (any number), score (0 to 1), predicted."""
    base = math.log(threshold / (1 - threshold))

    def make():
        def work(texts: list[bytes | None]):
            if model is None:
                return [[0.0] * len(texts)]
            return [model.scores(np.stack([features(t) for t in texts]))]

        return work

    made = with_text(docs, text, [("rank_score", DOUBLE)], make)
    slope, cut = (model.slope, model.cut) if model is not None else (0.0, 0.0)
    curve = 1 / (1 + F.exp(-((F.col("rank_score") - cut) * slope + base)))
    return made.withColumn("score", curve).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Best-fit packing of token sequences, bulk-synchronously on range-sorted documents and gaps.

Pieces of one length are interchangeable, and so are gaps of one size; sorted by length (size), each
is a run, and there are at most `size` runs however many rows there are. A superstep takes the
longest pieces left, sweeps the gaps upward from the successor of that length, gives each gap as many
of them as fit, in the order of rank, and updates the gaps; what finds no gap opens new sequences.
Only runs are swept together. The rows are ranked by a distributed range sort, and each task finds
the sequence and offset of its own ranks in the runs.

A null or empty text has no ids but the end mark, and is packed as such. Repeated rows are packed as
often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ordered, settled, slices, small_batches
from gridloom.llm.tokens import Encoder

SIZE = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as bytes): documents cut into pieces of `size` ids."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"][: int(keep_ids)]]
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)  # of one task, so that no worker holds its cache any longer
        mark = np.array([END_ID], "<u4").tobytes()
        step = size * 4
        for batch in batches:
            for part in slices(batch, "_text"):
                row, at, start, length, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(encoder.encode(part.column("_text").to_pylist())):
                    ids += mark
                    for k, a in enumerate(range(0, len(ids), step)):
                        own = ids[a : a + step]
                        row.append(i)
                        at.append(k)
                        start.append(a // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if keep_ids:
                            kept.append(own)
                cols = [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(at, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(kept, pa.binary())][: int(keep_ids)]], names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def supersteps(counts: dict[int, int], size: int = SIZE) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset), by descending length and rank.

    counts: pieces of each length. Its size and that of the result depend on `size` alone: a gap that
    takes pieces of a length shrinks below it and so by half at least, which happens to a run at
    most log2(size) times, and a superstep splits one run at most.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    plan, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for gap in sorted(g for g in gaps if g >= length):
            fits, runs, still = gap // length, gaps.pop(gap), []
            for first, n in runs:
                full = min(n, left // fits)
                if full:
                    plan.append((length, rank, first, fits, size - gap))
                    gaps[gap - fits * length].append((first, full))
                    rank, left = rank + full * fits, left - full * fits
                if full < n and left:
                    if left < fits:
                        plan.append((length, rank, first + full, fits, size - gap))
                        gaps[gap - left * length].append((first + full, 1))
                        full, rank, left = full + 1, rank + left, 0
                if full < n:
                    still.append((first + full, n - full))
            if still:
                gaps[gap] += still
            if not left:
                break
        if left:
            fits = size // length
            plan.append((length, rank, opened, fits, 0))
            full, rest = divmod(left, fits)
            if full:
                gaps[size - fits * length].append((opened, full))
            if rest:
                gaps[size - rest * length].append((opened + full, 1))
            opened += full + (rest > 0)
    return np.array(plan, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """The pieces with their sequence_id and offset in it."""
    cut = settled(pieces(docs, path or tokenizer_path(), size, keep_ids))
    counts = {int(r.length): r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = supersteps(counts, size)
    lengths = sorted(counts, reverse=True)
    starts = np.concatenate([[0], np.cumsum([counts[x] for x in lengths])]).astype(np.int64)
    first = np.zeros(size + 1, np.int64)
    first[lengths] = starts[:-1]
    # Places of the plan in the order of all pieces: ascending, as both go by length and rank.
    places = first[plan[:, 0]] + plan[:, 1]
    ranked = ordered(cut, [F.desc("length"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields) + ", sequence_id bigint, offset bigint"
    shipped = docs.sparkSession.sparkContext.broadcast((plan, places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, places = shipped.value
        for batch in batches:
            index = batch.column("row_index").to_numpy()
            step = np.searchsorted(places, index, "right") - 1
            nth = index - places[step]
            sequence = plan[step, 2] + nth // plan[step, 3]
            offset = plan[step, 4] + nth % plan[step, 3] * plan[step, 0]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

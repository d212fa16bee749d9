"""Shared pieces: text columns in tasks, stable materialisation, global order, word tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, DOUBLE, STRING, BOOL, BINARY = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.BinaryType()
SLICE_BYTES = 2 << 20
U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset (local runs)."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gridloom-")
        sc.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table: rows and partitions stay as they are even if executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like `settled`, as compressed Parquet: for tables that carry texts or are read more than once."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows per Arrow batch where the session has Spark's default of 10,000: texts are long, and batches are held by JVM and worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def without(df: DataFrame, names: list[str]) -> DataFrame:
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def with_text(docs: DataFrame, text: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable]) -> DataFrame:
    """Add columns computed from the whole text of each row, in slices of about SLICE_BYTES.

    `make()` runs once per task and gives a function from a list of UTF-8 byte strings (None for
    null) to one list or array per field.
    """
    small_batches(docs.sparkSession)
    keep = without(docs, [n for n, _ in fields])
    schema = T.StructType([*keep.schema.fields, *[T.StructField(n, t) for n, t in fields]])
    # The text may itself be replaced, so it travels under a name of its own.
    source = docs.select(*[F.col(f"`{c}`") for c in keep.columns], F.col(f"`{text}`").cast("binary").alias("_llm_text"))
    types = [_arrow(t) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, "_llm_text"):
                made = work(part.column("_llm_text").to_pylist())
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                new = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)


def pressed(df: DataFrame, text: str) -> DataFrame:
    """df with its text compressed, as `_z`, for a shuffle on the way."""

    def make():
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        return lambda texts: [[None if t is None else press.compress(t) for t in texts]]

    return without(with_text(df, text, [("_z", BINARY)], make), [text])


def unpressed(df: DataFrame, text: str) -> DataFrame:
    """The text of a `pressed` table again, as its last column."""

    def make():
        import zstandard

        press = zstandard.ZstdDecompressor()
        return lambda parts: [[None if z is None else press.decompress(z).decode() for z in parts]]

    return with_text(df, "_z", [(text, STRING)], make).drop("_z")


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `size` bytes of the column; one row at least."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    if not len(sizes):
        return
    group = (np.cumsum(sizes) - 1).clip(0) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in t.fields])
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
    }[t.simpleString()]


def ordered(df: DataFrame, by: list[Column], index: str = "row_index") -> DataFrame:
    """A global 0-based position in the order of `by`, without bringing rows to one task.

    Range partitions are sorted and settled; one count per partition comes to the driver and goes
    back as a table of starting positions. Ties keep an arbitrary but settled order.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = settled(df.repartitionByRange(n, *by).sortWithinPartitions(*by))
    place = F.monotonically_increasing_id()
    rows = rows.select("*", F.shiftright(place, 33).cast("int").alias("_pid"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    counts = dict(rows.groupBy("_pid").count().collect())
    starts, total = [], 0
    for pid in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(pid, 0)
    start = F.element_at(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), F.col("_pid") + 1)
    return rows.withColumn(index, start + F.col("_at")).drop("_pid", "_at")


def _table(keep: Callable[[int], int]) -> bytes:
    return bytes(keep(i) for i in range(256))


#: Lower-cases A-Z and blanks every ASCII byte that is neither letter nor digit.
WORD_BYTES = _table(lambda b: b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and any other characters."""
    return text.translate(WORD_BYTES).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def drawn(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 32)) * U64(0x9E3779B97F4A7C15))


_BYTE_KEYS = drawn(1, 64 * 256).reshape(64, 256)


def word_hashes(texts: list[bytes | None], table: bytes | None = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of many texts at once: (hash, start byte, end byte, first word of each text).

    Byte offsets count from the start of the word's own text. With table None, words are what is
    left between ASCII white space.
    """
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    if table is not None:
        joined = joined.translate(table)
    raw = np.frombuffer(joined, np.uint8)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, begin)
    if not len(start):
        return np.zeros(0, U64), start, end, first
    spot = np.flatnonzero(inside)
    length = end - start
    at = np.arange(len(spot)) - np.repeat(np.cumsum(length) - length, length)
    keys = _BYTE_KEYS[at & 63, raw[spot]]
    with np.errstate(over="ignore"):
        if length.max() > 64:
            keys = keys * ((at >> 6).astype(U64) * U64(2) + U64(1))
        value = mixed(np.add.reduceat(keys, np.cumsum(length) - length) + length.astype(U64))
    base = np.repeat(begin[:-1], np.diff(first))
    return value, start - base, end - base, first


def sha256_hex(parts: list[bytes]) -> list[str]:
    import hashlib

    return [hashlib.sha256(p).hexdigest() for p in parts]

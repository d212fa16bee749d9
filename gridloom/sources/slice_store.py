"""Parquet store of 2D slices: one row per slice, partitioned by run and variable, with a manifest.

Files hold disjoint ranges of iterations, in order, and the manifest (`_manifest` inside the store, one row per file)
says which. So a lookup opens the files of its iterations only, and slices come in order without sorting arrays.
Files that arrive later (streamed appends) count everywhere; `refresh` adds them to the manifest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from contextlib import nullcontext
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators.skew import is_small, sized
from gridloom.schema import FIELD_SLICE
from gridloom.sources.scratch import written

#: Bytes of arrays, before compression, that one file holds (about).
FILE_BYTES = 128 << 20
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "run string, variable string, file string, lo bigint, hi bigint, n bigint"
#: Names of the gzip levels 1 to 9 in the Hadoop setting.
_GZIP = ("BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION")


def write(
    slices: DataFrame, path: str, *, compression_level: int | None = 4, dtype: str = "float64", mode: str = "overwrite",
    file_bytes: int = FILE_BYTES, staged: bool = True,
) -> None:
    """Write slices in order of run, variable and iteration; level 0 or None means uncompressed, float32 halves the arrays.

    The order is made by ranges, for which the slices are read three times (size, sample, write). `staged` writes them
    once as they come before that, so that what makes them runs once; leave it out for slices that are cheap to make.
    """
    if dtype not in ("float64", "float32"):
        raise ValueError(f"dtype must be float64 or float32, not {dtype!r}")
    if compression_level is not None and not 0 <= compression_level <= 9:
        raise ValueError(f"compression_level must be 0 to 9 or None, not {compression_level!r}")
    kind, width = ("array<double>", 8) if dtype == "float64" else ("array<float>", 4)
    spark = slices.sparkSession
    with written(slices, "slices") if staged else nullcontext(slices) as rows:
        points = rows.agg(F.sum(F.coalesce(F.col("nx").cast("bigint") * F.col("ny"), F.lit(1)))).first()[0] or 0
        order = ("run", "variable", "iteration")
        writer = (
            rows.withColumn("data", F.col("data").cast(kind))
            .repartitionByRange(int(points * width // file_bytes) + 1, *order).sortWithinPartitions(*order)
            .write.mode(mode).partitionBy("run", "variable")
        )
        if compression_level:
            writer = writer.option("compression", "gzip").option("zlib.compress.level", _GZIP[compression_level - 1])
        else:
            writer = writer.option("compression", "uncompressed")
        writer.parquet(path)
    refresh(spark, path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "false").parquet(path)


def _slices(stored: DataFrame) -> DataFrame:
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FIELD_SLICE if f.name in stored.columns])


def read(spark: SparkSession, path: str) -> DataFrame:
    """All slices; `data` comes back as doubles. Filters on run, variable and iteration reach the scan."""
    return _slices(_stored(spark, path))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def _ranges(stored: DataFrame) -> DataFrame:
    """Manifest rows of a table's files; of the slices only `iteration` is read."""
    file = F.col("_metadata.file_path").alias("file")
    return stored.select(F.col("run").cast("string").alias("run"), F.col("variable").cast("string").alias("variable"), file, "iteration").groupBy(
        "run", "variable", "file").agg(F.min("iteration").alias("lo"), F.max("iteration").alias("hi"), F.count(F.lit(1)).alias("n"))


def _of(rows: DataFrame, name: str | None, run: str | None) -> DataFrame:
    rows = rows if name is None else rows.filter(F.col("variable") == name)
    return rows if run is None else rows.filter(F.col("run") == run)


def manifest(spark: SparkSession, path: str, name: str | None = None, run: str | None = None) -> DataFrame:
    """(run, variable, file, lo, hi, n) of every file, also of those that no manifest lists yet."""
    listed = _of(_listed(spark, path), name, run)
    try:
        now = _of(_stored(spark, path), name, run)
    except AnalysisException as empty:
        if empty.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return listed
    new = _ranges(now).join(sized(listed.select("file")), "file", "left_anti")
    return listed.unionByName(new.select(*listed.columns))


def refresh(spark: SparkSession, path: str) -> None:
    """List files that came since the manifest was written."""
    listed = _listed(spark, path).select("file")
    new = manifest(spark, path).join(listed, "file", "left_anti").select("run", "variable", "file", "lo", "hi", "n")
    new.repartitionByRange("run", "variable", "lo").sortWithinPartitions("run", "variable", "lo").write.mode("append").parquet(f"{path.rstrip('/')}/{MANIFEST}")


def variable(spark: SparkSession, path: str, name: str, run: str | None = None) -> DataFrame:
    return _of(read(spark, path), name, run)


def _open(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    # Names in the manifest are URIs.
    return spark.read.option("basePath", path).parquet(*map(unquote, files))


def lookup(spark: SparkSession, path: str, name: str, iterations: Sequence[int], run: str | None = None) -> DataFrame:
    """The stored slices of some iterations, from the files whose ranges hold them."""
    wanted = sorted(set(iterations))
    listed = _of(_listed(spark, path), name, run)
    inside = F.exists(F.array(*map(F.lit, wanted)).cast("array<bigint>"), lambda i: (i >= F.col("lo")) & (i <= F.col("hi")))
    files = [r["file"] for r in listed.filter(inside).select("file").collect()] if wanted else []
    rows = _of(_slices(_open(spark, path, files)), name, run) if files else variable(spark, path, name, run).filter("false")
    return rows.filter(F.col("iteration").isin(wanted))


def at_iteration(spark: SparkSession, path: str, name: str, iteration: int, run: str | None = None) -> Row:
    """The one slice of an iteration; KeyError when it is not stored."""
    hit = lookup(spark, path, name, [iteration], run).limit(1).collect()
    # Not in a listed file: it may have come since.
    hit = hit or variable(spark, path, name, run).filter(F.col("iteration") == iteration).limit(1).collect()
    if not hit:
        raise KeyError(f"iteration {iteration} of {name} is not stored")
    return hit[0]


def iterate(spark: SparkSession, path: str, name: str, run: str | None = None) -> Iterator[Row]:
    """Slices in iteration order (then run), fetched one partition at a time.

    Files are in order themselves, and a file's splits come in order. So one file after the other is read; only
    where ranges overlap (several runs, later appends) are files read side by side and merged.
    """
    files = manifest(spark, path, name, run).orderBy("lo", "run", "file").toLocalIterator()
    waiting = next(files, None)
    open_now: list[tuple[int, str, str, int, Row, Iterator[Row]]] = []
    count = 0

    def push(file: str, at: int, rows: Iterator[Row]) -> None:
        row = next(rows, None)
        if row is not None:
            heapq.heappush(open_now, (row["iteration"], row["run"] or "", file, at, row, rows))

    while waiting or open_now:
        while waiting and (not open_now or waiting["lo"] <= open_now[0][0]):
            count += 1
            own = _of(_slices(_open(spark, path, [waiting["file"]])), name, run)
            push(waiting["file"], count, own.toLocalIterator())
            waiting = next(files, None)
        if open_now:
            _, _, file, at, row, rows = heapq.heappop(open_now)
            yield row
            push(file, at, rows)


def numbered(spark: SparkSession, path: str, name: str | None = None, run: str | None = None, out: str = "position") -> DataFrame:
    """Slices with their place in the order of iterations within run and variable, by the places of files and of rows in files.

    Needs files with disjoint ranges, as `write` leaves them (an error otherwise).
    """
    within = W.partitionBy("run", "variable").orderBy("lo", "file")
    files = manifest(spark, path, name, run).select(
        "run", "variable", "file", (F.sum("n").over(within) - F.col("n")).alias("_before"),
        (F.lag("hi").over(within) < F.col("lo")).alias("_apart"))
    if not files.filter("not _apart").isEmpty():
        raise ValueError("the files of the store overlap; write it anew to number its slices")
    place = files.select("file", "_before")
    stored = _of(_stored(spark, path), name, run)
    rows = _slices_with(stored).join(F.broadcast(place) if is_small(place) else place, "file")
    return rows.withColumn(out, F.col("_before") + F.col("_row")).drop("file", "_before", "_row")


def _slices_with(stored: DataFrame) -> DataFrame:
    """Slices with their file and their row in it."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in FIELD_SLICE if f.name in stored.columns]
    return stored.select(*fields, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row"))


def iteration_index(slices: DataFrame) -> DataFrame:
    """(run, variable, iteration, time) without touching the arrays."""
    return slices.select("run", "variable", "iteration", "time")

"""File index of a simulation directory, walked in parallel, one level per stage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.constants import DEFAULT_SCAN_EXCLUDED_DIRS
from gridloom.functions import names
from gridloom.functions.names import matches_glob

_STATE = "path string, is_dir boolean, depth int, open boolean"


def walk(
    spark: SparkSession,
    root: str,
    *,
    exclude_dirs: Iterable[str] = (),
    exclude_files: Sequence[str] = (),
    max_depth: int = 8,
    parallelism: int | None = None,
) -> DataFrame:
    """Files and directories under `root` in `schema.FILE_INDEX`.

    Symbolic links are not followed or listed, directories with an excluded
    name are not entered, files matching an excluded glob are dropped, and
    directories at `max_depth` are listed themselves but not entered. Each
    level spreads its open directories over all tasks by path hash, so one deep
    subtree does not end up in one task, and every directory is read once.
    """
    banned = frozenset(DEFAULT_SCAN_EXCLUDED_DIRS) | frozenset(exclude_dirs)
    globs = list(exclude_files)
    n = parallelism or spark.sparkContext.defaultParallelism

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, is_dir, depth, is_open in batch.itertuples(index=False):
                out.append((path, is_dir, depth, False))
                if not is_open:
                    continue
                try:
                    entries = list(os.scandir(path))
                except OSError:
                    continue
                for e in entries:
                    try:
                        file, folder = e.is_file(follow_symlinks=False), e.is_dir(follow_symlinks=False)
                    except OSError:
                        continue
                    if file and not matches_glob(e.name, globs):
                        out.append((e.path, False, depth + 1, False))
                    elif folder and e.name not in banned:
                        out.append((e.path, True, depth + 1, True))
            yield pd.DataFrame(out, columns=["path", "is_dir", "depth", "open"])

    top = os.path.abspath(os.path.expanduser(root))
    found = spark.createDataFrame([(top, True, 0, True)], _STATE)
    for _ in range(max_depth):
        found = found.repartition(n, "path").mapInPandas(expand, _STATE)
    return describe(found)


def extension(name: Column | str) -> Column:
    """Last dotted suffix with its dot; leading dots do not start one."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, r"^\.*[^.].*?(\.[^.]*)$", 1)


def describe(paths: DataFrame) -> DataFrame:
    name = names.basename("path")
    return paths.select(
        "path", name.alias("name"), extension(name).alias("ext"),
        F.regexp_replace("path", r"/[^/]*$", "").alias("parent"), "depth", "is_dir",
    )


def by_extension(index: DataFrame) -> dict[str, DataFrame]:
    """Log, error and parameter files of an index."""
    files = index.filter(~F.col("is_dir"))
    return {kind: files.filter(F.col("ext") == ext) for kind, ext in (("log", ".out"), ("err", ".err"), ("par", ".par"))}


def open_index(spark: SparkSession, root: str, cache: str | None = None, reuse: bool = False, **walk_options) -> DataFrame:
    """A saved index when `reuse` is set, otherwise a fresh walk, saved to `cache` if given.

    A failing save only warns. A reused index of another root warns too.
    """
    if reuse:
        if not cache:
            raise ValueError("reuse needs the path of a saved index")
        index = spark.read.parquet(cache)
        top = os.path.abspath(os.path.expanduser(root))
        if not index.filter((F.col("depth") == 0) & (F.col("path") == top)).limit(1).count():
            print(f"WARNING: the saved index at {cache} was not made for {top}")
        return index
    index = walk(spark, root, **walk_options)
    if cache:
        try:
            index.write.mode("overwrite").parquet(cache)
            return spark.read.parquet(cache)
        except Exception as exc:  # the cache is a convenience
            print(f"WARNING: could not save the file index to {cache}: {exc}")
    return index


def find_series(index: DataFrame) -> DataFrame:
    """openPMD series (files or directories) of an index, in path order."""
    return index.filter(names.is_iteration_series("path")).orderBy("path")

"""openPMD series through `openpmd_api`, and resampled HDF5 stacks through `h5py`.

Both are read in two steps. An index step lists what is stored without loading
arrays; it is an ordinary DataFrame, so filters on variable, iteration, plane or
footprint drop work before the second step loads the arrays of what is left,
one row at a time and spread over all tasks. The libraries are only needed on
the executors and are imported there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.schema import AMR_CHUNK, FIELD_SLICE

_INDEX = T.StructType([f for f in AMR_CHUNK if f.name != "data"])


def _require(module: str, hint: str):
    try:
        return __import__(module)
    except ImportError as exc:
        raise RuntimeError(f"reading this source needs the Python package {hint} on every executor") from exc


def _time_of(it) -> float | None:
    """Iteration time, else its attribute, else that of the first mesh or its first component."""
    tries = [lambda: it.time, lambda: it.get_attribute("time")]
    for name in it.meshes:
        mesh = it.meshes[name]
        tries += [lambda m=mesh: m.get_attribute("time"), lambda m=mesh: m[next(iter(m))].get_attribute("time")]
    for get in tries:
        try:
            return float(get())
        except (AttributeError, TypeError, KeyError, StopIteration, RuntimeError):
            continue
    return None


def _index_series(path: str, which: str) -> Iterator[tuple]:
    io = _require("openpmd_api", "openpmd-api")
    series = io.Series(path, io.Access.read_only)
    try:
        its = list(series.iterations)
        picked = its if which == "all" else its[:1] if which == "first" else its[-1:]
        for number in picked:
            it = series.iterations[number]
            time = _time_of(it)
            for seq, name in enumerate(sorted(it.meshes)):
                mesh = it.meshes[name]
                for comp in mesh:
                    record = mesh[comp]
                    fixed = (
                        [int(s) for s in record.shape],
                        [float(v) for v in mesh.get_attribute("gridGlobalOffset")],
                        [float(v) for v in mesh.get_attribute("gridSpacing")],
                        [float(v) for v in record.position],
                    )
                    for k, ch in enumerate(record.available_chunks()):
                        yield (
                            path, int(number), time, name, str(comp), seq, k, fixed[0],
                            [int(v) for v in ch.offset], [int(v) for v in ch.extent], *fixed[1:],
                        )
    finally:
        series.close()


def chunk_index(spark: SparkSession, paths: DataFrame | Sequence[str], which: str = "first") -> DataFrame:
    """Written chunks of openPMD series without their data (`schema.AMR_CHUNK` minus data).

    `which` picks the first (plotting), the last (inspection) or all iterations of a series.
    """
    if which not in ("first", "last", "all"):
        raise ValueError("which must be first, last or all")
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    columns = _INDEX.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows = list(_index_series(path, which))
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    n = spark.sparkContext.defaultParallelism
    return paths.select("path").repartition(n, "path").mapInPandas(run, _INDEX)


def load_chunks(index: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Add `data` to chunk index rows, loading only the written part of cell-centred axes."""
    from gridloom.operators.amr import clip_chunks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        io = _require("openpmd_api", "openpmd-api")
        for batch in batches:
            for path, part in batch.groupby("series", sort=False):
                series = io.Series(path, io.Access.read_only)
                try:
                    for _, row in part.iterrows():
                        record = series.iterations[int(row["iteration"])].meshes[row["mesh_name"]][row["component"]]
                        raw = record.load_chunk([int(v) for v in row["off"]], [int(v) for v in row["ext"]])
                        series.flush()
                        one = row.to_frame().T
                        one["data"] = [np.asarray(raw, dtype=float).ravel()]
                        yield one[AMR_CHUNK.fieldNames()]
                finally:
                    series.close()

    n = parallelism or index.sparkSession.sparkContext.defaultParallelism
    return (
        clip_chunks(index).drop("stored")
        .repartition(n, "series", "iteration", "mesh_name", "component", "chunk_id")
        .mapInPandas(run, AMR_CHUNK)
    )


def intersecting(index: DataFrame, x_min: float, x_max: float, y_min: float, y_max: float) -> DataFrame:
    """2D chunks whose cell footprint touches a box: the filter that saves most of the reading."""
    off, ext, gap = (lambda d, c=c: F.get(c, F.lit(d)) for c in ("off", "ext", "spacing"))

    def bounds(d: int):
        a = F.get("grid_offset", F.lit(d)) + (off(d) + F.get("position", F.lit(d))) * gap(d)
        b = a + (ext(d) - 1) * gap(d)
        half = F.abs(gap(d)) / 2
        return F.least(a, b) - half, F.greatest(a, b) + half

    (y0, y1), (x0, x1) = bounds(0), bounds(1)
    return index.filter((x1 >= x_min) & (x0 <= x_max) & (y1 >= y_min) & (y0 <= y_max))


def read_slice_files(spark: SparkSession, run: str, files: dict[str, str], plane: str = "xy") -> DataFrame:
    """Resampled HDF5 stacks, {variable: path}, as slice rows; arrays are loaded slice by slice."""
    index = T.StructType([
        T.StructField("variable", T.StringType()), T.StructField("path", T.StringType()),
        T.StructField("k", T.LongType()), T.StructField("iteration", T.LongType()), T.StructField("time", T.DoubleType()),
    ])

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h5py = _require("h5py", "h5py")
        for batch in batches:
            for variable, path in batch.itertuples(index=False):
                with h5py.File(path, "r") as f:
                    its, times = f["iterations"][:], f["times"][:]
                yield pd.DataFrame({
                    "variable": variable, "path": path, "k": np.arange(len(its)), "iteration": its, "time": times,
                })

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h5py = _require("h5py", "h5py")
        for batch in batches:
            for path, part in batch.groupby("path", sort=False):
                with h5py.File(path, "r") as f:
                    for row in part.itertuples(index=False):
                        data = np.asarray(f["data"][int(row.k)], dtype=float)
                        yield pd.DataFrame([{
                            "run": run, "variable": row.variable, "plane": plane, "iteration": row.iteration,
                            "time": row.time, "nx": data.shape[0], "ny": data.shape[1], "data": data.ravel(),
                        }])[FIELD_SLICE.fieldNames()]

    n = spark.sparkContext.defaultParallelism
    return (
        spark.createDataFrame(list(files.items()), "variable string, path string")
        .repartition(n, "path").mapInPandas(listing, index)
        .repartition(n, "path", "k").mapInPandas(load, FIELD_SLICE)
    )

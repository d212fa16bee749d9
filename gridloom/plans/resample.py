"""Resampling: simulation output to a store of slices on one regular grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import names
from gridloom.functions.grid import grid_point
from gridloom.operators import amr
from gridloom.operators.ordered import iteration_select
from gridloom.operators.painting import composite_slices
from gridloom.operators.skew import sized
from gridloom.plans.config import ResampleConfig
from gridloom.plans.tasks import requested_variables, skipped_variables
from gridloom.schema import FIELD_META
from gridloom.sources import openpmd, slice_store, walk


def select_iterations(index: DataFrame, config: ResampleConfig, keys: tuple[str, ...] = ("run", "variable")) -> DataFrame:
    """Iterations to resample per requested variable: closed range first, then stride."""
    wanted = requested_variables(index, config.variables).drop("seq")
    return iteration_select(
        wanted, keys, it_min=config.iteration_min, it_max=config.iteration_max, stride=config.iteration_stride
    )


def report_skipped(index: DataFrame, config: ResampleConfig) -> list[str]:
    """Requested variables without data, in configuration order; an error when none has any.

    The list cannot be longer than the configuration.
    """
    gone = [r["variable"] for r in skipped_variables(index, config.variables).orderBy("seq").collect()]
    for name in gone:
        print(f"WARNING: no data for {name}, skipped")
    if len(gone) == len(config.variables):
        raise ValueError("none of the requested variables has data")
    return gone


def in_plane(chunks: DataFrame, plane: str) -> DataFrame:
    """Chunks of the plane, by the tag of their mesh names; untagged ones belong to any.

    Adds `plane`: the plane's name at elevation 0 or without a tag, else the whole tag, so that
    cuts at several elevations stay apart.
    """
    tag = names.plane_tag("plane_tag")
    own = chunks.withColumn("_tag", tag).filter(F.col("_tag").isNull() | (F.col("_tag.plane") == plane))
    apart = F.col("_tag").isNotNull() & (F.col("_tag.elevation") != 0)
    return own.withColumn("plane", F.when(apart, F.col("plane_tag")).otherwise(F.lit(plane))).drop("_tag")


def resample(chunks: DataFrame, config: ResampleConfig, run: str) -> DataFrame:
    """Slices of `chunks` (labelled, in `schema.AMR_CHUNK`) on the configured grid, finest level on top.

    Only chunks of the configured plane count. Iterations are chosen on metadata
    first and joined back, so arrays of other iterations are not touched. Where
    several series cover an iteration, they are painted in one fixed order.
    """
    lo, hi = config.grid.bounds()
    nx, ny = (int(v) for v in config.grid.resolution)
    labelled = in_plane(chunks, config.plane).withColumn("run", F.lit(run)).withColumn("variable", F.col("label"))
    index = labelled.select("run", "variable", "iteration", "time").groupBy("run", "variable", "iteration").agg(
        F.min("time").alias("time")
    )
    chosen = select_iterations(index, config)
    picked = labelled.drop("time").join(sized(chosen), ["run", "variable", "iteration"])
    keys = ["run", "variable", "plane", "iteration", "time"]
    canvas = composite_slices(
        picked, nx=nx, ny=ny, method=config.method, extent=amr.Extent(lo[0], hi[0], lo[1], hi[1]), keys=keys
    )
    return canvas.select(
        "run", "variable", "plane", "iteration", "time", "nx", "ny", "data"
    )


def axes(spark: SparkSession, config: ResampleConfig) -> DataFrame:
    """Coordinates (axis, k, value) of the output grid."""
    lo, hi = config.grid.bounds()
    parts = []
    for axis, a, b, n in zip("xy", lo, hi, config.grid.resolution):
        parts.append(
            spark.range(int(n)).select(
                F.lit(axis).alias("axis"), F.col("id").alias("k"),
                grid_point(F.col("id"), F.lit(float(a)), F.lit(float(b)), int(n)).alias("value"),
            )
        )
    return parts[0].unionByName(parts[1])


def field_meta(spark: SparkSession, config: ResampleConfig) -> DataFrame:
    rows = [
        (v, config.label, config.plane, config.simdir, config.interp_order, [int(r) for r in config.grid.resolution], config.backend)
        for v in config.variables
    ]
    return spark.createDataFrame(rows, FIELD_META)


def run(spark: SparkSession, config: ResampleConfig) -> str:
    """Whole step: walk, index, choose, load only what the grid needs, resample, write. Returns the store path."""
    index = walk.open_index(
        spark, config.simdir, config.index_path, config.index_reuse,
        exclude_dirs=config.exclude_dirs, exclude_files=config.exclude_files, max_depth=config.scan_max_depth,
    )
    series = walk.find_series(index)
    chunks = in_plane(amr.labelled(openpmd.chunk_index(spark, series, which="all")), config.plane).drop("plane")
    report_skipped(chunks.select(F.col("label").alias("variable")), config)
    lo, hi = config.grid.bounds()
    needed = openpmd.intersecting(
        chunks.filter(F.col("label").isin(list(config.variables))), lo[0], hi[0], lo[1], hi[1]
    )
    # Choose iterations before the arrays are loaded, not after.
    found = chunks.select(
        F.lit(config.label).alias("run"), F.col("label").alias("variable"), "iteration", "time"
    ).groupBy("run", "variable", "iteration").agg(F.min("time").alias("time"))
    chosen = select_iterations(found, config).select(F.col("variable").alias("label"), "iteration")
    needed = needed.join(sized(chosen), ["label", "iteration"], "left_semi")
    loaded = amr.labelled(openpmd.load_chunks(needed))
    # Range and stride are already applied.
    plain = ResampleConfig(**{**config.__dict__, "iteration_stride": 1, "iteration_min": None, "iteration_max": None})
    out = f"{config.output_dir.rstrip('/')}/{config.label}"
    slice_store.write(
        resample(loaded, plain, config.label), out, compression_level=config.compression_level, dtype=config.dtype
    )
    field_meta(spark, config).write.mode("overwrite").parquet(out + "__meta")
    return out

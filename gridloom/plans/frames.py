"""Movie frames: data preparation in Spark, drawing (optional) one frame per task call."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import names
from gridloom.functions.scalars import since_merger
from gridloom.operators import contours, fields
from gridloom.operators.ordered import frame_select


def prepare(
    slices: DataFrame,
    variables: Mapping[str, str],
    panel: Callable[[dict[str, Column]], Column],
    settings: Mapping[str, Any],
    *,
    title: str,
    ref: str,
    keys: Sequence[str] = ("run",),
) -> DataFrame:
    """Selected frames with panel data, title and file name.

    `panel` maps {alias: array column} to an array column, built from array
    functions such as `zip_with`; `ref` names the alias whose time and iteration
    the title shows. Frames are selected by index before panels are computed.
    """
    frames = fields.align_frames(slices, variables, keys)
    frames = frame_select(frames, settings["FRAME_START"], settings["FRAME_STOP"], settings["FRAME_STRIDE"], idx="frame_idx")
    t_raw = F.col(f"{ref}.time")
    text = names.title(
        title, t=since_merger(t_raw, F.lit(float(settings["T_MERGE"])), settings["MILLIS"]),
        t_raw=t_raw, it=F.col(f"{ref}.iteration"), idx=F.col("frame_idx"),
    )
    file = F.concat(
        F.lit(settings["OUT_PREFIX"] + "_"), names.zero_padded("seq", settings["ZFILL"]), F.lit("." + settings["OUT_EXT"])
    )
    data = panel({alias: F.col(f"{alias}.data") for alias in variables})
    return frames.select(
        *keys, "frame_idx", "seq", F.col(f"{ref}.iteration").alias("iteration"), t_raw.alias("time"),
        text.alias("title"), file.alias("file"), data.alias("data"),
    )


@dataclass(frozen=True)
class Contour:
    """Lines of `data` (built from the fields' arrays) at `levels`, on the grid of field `ref`."""

    data: Callable[[dict[str, Column]], Column]
    ref: str
    levels: Sequence[float]


@dataclass(frozen=True)
class Panel:
    """One plot of a frame; `ref` names the field whose iteration and time its title shows, less `time_offset`."""

    data: Callable[[dict[str, Column]], Column]
    ref: str
    title: str
    time_offset: float = 0.0
    contours: Sequence[Contour] = ()


@dataclass(frozen=True)
class FieldGrid:
    """Points along y, first coordinates and steps of a field's slices."""

    ny: int
    x: tuple[float, float]
    y: tuple[float, float]


def panels(
    slices: DataFrame, variables: Mapping[str, str], specs: Sequence[Panel], settings: Mapping[str, Any], *, keys: Sequence[str] = ("run",),
) -> DataFrame:
    """Rows (keys, frame_idx, seq, panel, row, col, iteration, time, title, file, data, contours), one per panel and frame.

    Panels fill the rows of the figure one after another; those beyond FIG_ROWS x FIG_COLS are left out. All of them, and the
    fields of their contours, share one alignment, so a frame exists if every field has it. `contours` holds the arrays of the
    panel's contours in their order, for `panel_lines`.
    """
    cols = settings["FIG_COLS"]
    frames = fields.align_frames(slices, variables, keys)
    frames = frame_select(frames, settings["FRAME_START"], settings["FRAME_STOP"], settings["FRAME_STRIDE"], idx="frame_idx")
    arrays = {alias: F.col(f"{alias}.data") for alias in variables}
    made = []
    for k, spec in enumerate(specs[: settings["FIG_ROWS"] * cols]):
        t_raw, it = F.col(f"{spec.ref}.time"), F.col(f"{spec.ref}.iteration")
        text = names.title(
            spec.title, t=since_merger(t_raw, F.lit(float(spec.time_offset)), settings["MILLIS"]), t_raw=t_raw, it=it, idx=F.col("frame_idx"),
        )
        lines = F.array(*[c.data(arrays).cast("array<double>") for c in spec.contours]).cast("array<array<double>>")
        made.append(F.struct(
            F.lit(k).alias("panel"), F.lit(k // cols).alias("row"), F.lit(k % cols).alias("col"), it.alias("iteration"), t_raw.alias("time"),
            text.alias("title"), spec.data(arrays).cast("array<double>").alias("data"), lines.alias("contours"),
        ))
    file = F.concat(F.lit(settings["OUT_PREFIX"] + "_"), names.zero_padded("seq", settings["ZFILL"]), F.lit("." + settings["OUT_EXT"]))
    return frames.select(*keys, "frame_idx", "seq", file.alias("file"), F.inline(F.array(*made)))


def panel_lines(
    made: DataFrame, specs: Sequence[Panel], grids: Mapping[str, FieldGrid], settings: Mapping[str, Any], *, keys: Sequence[str] = ("run",),
) -> DataFrame:
    """Contour points of the rows of `panels`, in kilometres: (keys, frame_idx, panel, contour, level, line, closed, pos, edge, x, y)."""
    scale = settings["MSUN_TO_KM"]
    flat = made.select(*keys, "frame_idx", "panel", F.posexplode("contours").alias("contour", "data"))

    def pick(of: Callable[[Contour], Any], kind: str) -> Column:
        known = F.lit(None).cast(kind)
        for p, spec in enumerate(specs):
            for c, contour in enumerate(spec.contours):
                known = F.when((F.col("panel") == p) & (F.col("contour") == c), F.lit(of(contour)).cast(kind)).otherwise(known)
        return known

    rows = flat.withColumns({"_ny": pick(lambda c: grids[c.ref].ny, "int"), "_levels": pick(lambda c: contour_levels(c.levels), "array<double>")})
    return contours.lines(
        rows, [*keys, "frame_idx", "panel", "contour"], F.col("_levels"), ny="_ny",
        x=tuple(pick(lambda c, k=k: grids[c.ref].x[k] * scale, "double") for k in (0, 1)),
        y=tuple(pick(lambda c, k=k: grids[c.ref].y[k] * scale, "double") for k in (0, 1)),
    )


def contour_levels(levels: Sequence[float]) -> list[float]:
    return sorted(float(v) for v in levels)


def render(frames: DataFrame, nx: int, ny: int, x: tuple[float, float], y: tuple[float, float], settings: Mapping[str, Any]) -> DataFrame:
    """Draw every frame where its row lives and return the files written. Needs matplotlib on the executors."""
    out_dir, scale, dpi = settings["OUT_DIR"], settings["MSUN_TO_KM"], settings["DPI"]
    size, font = tuple(settings["FIGSIZE"]), settings["FONT_SIZE"]
    xlim, ylim, levels = settings["XLIM"], settings["YLIM"], contour_levels(settings["RHO_LEVELS"])

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import matplotlib
        except ImportError as exc:
            raise RuntimeError("drawing frames needs matplotlib on every executor") from exc
        matplotlib.use("Agg")
        from matplotlib import pyplot as plt

        os.makedirs(out_dir, exist_ok=True)
        gx, gy = np.linspace(*x, nx) * scale, np.linspace(*y, ny) * scale
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                fig, ax = plt.subplots(figsize=size)
                grid = np.asarray(row.data, dtype=float).reshape(nx, ny)
                mesh = ax.pcolormesh(gx, gy, grid.T, shading="nearest", rasterized=True)
                if levels:
                    ax.contour(gx, gy, grid.T, levels)
                ax.set_title(row.title, fontsize=font)
                if xlim:
                    ax.set_xlim(*xlim)
                if ylim:
                    ax.set_ylim(*ylim)
                fig.colorbar(mesh, ax=ax)
                path = os.path.join(out_dir, row.file)
                fig.savefig(path, dpi=dpi)
                plt.close(fig)
                done.append(path)
            yield pd.DataFrame({"path": done})

    return frames.select("title", "file", "data").mapInPandas(draw, "path string")


def assemble_movie(settings: Mapping[str, Any]) -> str | None:
    """Join the numbered frames with ffmpeg, even-sized; without ffmpeg warn and return None."""
    tool = shutil.which("ffmpeg")
    if tool is None:
        print("WARNING: ffmpeg not found, frames are kept but no movie is made")
        return None
    out = os.path.join(settings["OUT_DIR"], settings["MOVIE_NAME"])
    pattern = os.path.join(settings["OUT_DIR"], f"{settings['OUT_PREFIX']}_%0{settings['ZFILL']}d.png")
    subprocess.run(
        [tool, "-y", "-framerate", str(settings["FRAMERATE"]), "-i", pattern,
         "-vf", "scale=trunc(iw/2)*2:trunc(ih/2)*2", "-pix_fmt", "yuv420p", out],
        check=True,
    )
    return out


def movie_from_files(files: Sequence[str], out: str, fps: int = 12) -> str | None:
    """Movie of explicit files; falls back to an animated GIF when the video writer fails."""
    try:
        import imageio.v2 as imageio
    except ImportError:
        print("WARNING: imageio not found, no movie is made")
        return None
    if not files:
        return None
    images = [imageio.imread(f) for f in files]
    for target in (out, os.path.splitext(out)[0] + ".gif"):
        try:
            imageio.mimsave(target, images, fps=fps)
            return target
        except Exception as exc:  # next format
            print(f"WARNING: could not write {target}: {exc}")
    return None

"""Compositing of 2D chunks straight to slices.

Values and their order are those of `amr.composite_plane`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import amr, canvas


def composite_slices(
    chunks: DataFrame, *, nx: int, ny: int, method: str, extent: amr.Extent, keys: Sequence[str],
) -> DataFrame:
    """Slices (keys, nx, ny, data), x first, of the canvases of 2D chunks; NaN where nothing was written."""
    made = canvas.painted(amr.plane_patches(chunks, extent, keys), keys, nx, ny, method, x_first=True)
    return made.select(*keys, F.lit(nx).alias("nx"), F.lit(ny).alias("ny"), "data")

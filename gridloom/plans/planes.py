"""From series paths to canvases with colour limits: 2D planes and cuts of 3D data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import names
from gridloom.operators import amr, fields
from gridloom.operators.skew import sized


@dataclass(frozen=True)
class Recipe:
    """A panel built from several source variables: {alias: variable} and how to combine them."""

    variables: Mapping[str, str]
    combine: Callable[[dict[str, Column]], Column] | None = None
    label: str | None = None


def select_series(
    paths: DataFrame, *, tag: str | None = None, plane: str | None = None,
    normal_axis: str | None = None, elevation: float | None = None,
) -> DataFrame:
    """Series of the wanted plane, decided from the path before anything is opened."""
    keep = names.plane_matches("path", tag=tag, plane=plane, normal_axis=normal_axis, elevation=elevation)
    return paths.filter(names.is_iteration_series("path") & keep)


def select_variable(chunks: DataFrame, variable: str | None) -> DataFrame:
    """Labelled chunks whose mesh, component, group or tag contains `variable`."""
    parsed = names.with_mesh(chunks)
    hit = parsed.filter(names.matches_variable(variable, "mesh_name", "component", "_m")).select(*chunks.columns)
    return amr.labelled(hit)


def first_iteration(chunks: DataFrame, last: bool = False) -> DataFrame:
    """Chunks of each series' first (or last) iteration."""
    pick = (F.max if last else F.min)("iteration").alias("iteration")
    ends = chunks.groupBy("series").agg(pick)
    return chunks.join(sized(ends), ["series", "iteration"], "left_semi")


def render_planes(
    chunks: DataFrame, variable: str | None = None, *, nx: int = 1024, ny: int = 1024, method: str = "linear",
    extent: amr.Extent | None = None,
) -> DataFrame:
    """Canvases (series, iteration, label, j, i, y, x, v) of all matching variables."""
    return amr.composite_plane(select_variable(first_iteration(chunks), variable), nx=nx, ny=ny, method=method, extent=extent)


def render_slices(
    chunks: DataFrame, variable: str | None = None, *, axes: Sequence[str] = ("xy",), at: float = 0.0,
    n: int = 1024, method: str = "nearest", all_variables: bool = False,
) -> DataFrame:
    """Canvases of one cut per axis; without `all_variables` only each series' first label is cut."""
    found = select_variable(first_iteration(chunks), variable)
    if not all_variables:
        first = found.groupBy("series").agg(F.min("label").alias("label"))
        found = found.join(sized(first), ["series", "label"], "left_semi")
    parts = [amr.composite_slice(found, a, at, n=n, method=method).withColumn("axis", F.lit(a)) for a in axes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def render_recipe(chunks: DataFrame, recipe: Recipe, **options) -> DataFrame:
    """Canvas of a recipe; each source variable must resolve to a single label."""
    data = first_iteration(chunks)
    chosen = {alias: amr.select_label(select_variable(data, v), v) for alias, v in recipe.variables.items()}
    label = recipe.label or next(iter(chosen.values()))
    return amr.composite_recipe(amr.labelled(data), chosen, recipe.combine, **options).withColumn("label", F.lit(label))


def limits(canvas: DataFrame, *, log: bool = False, vmin: float | None = None, vmax: float | None = None) -> DataFrame:
    return fields.colour_limits(canvas, ["series", "iteration", "label"], "v", log=log, vmin=vmin, vmax=vmax)


def output_name(path: Column | str, iteration: Column | str) -> Column:
    """`<series>_it00000042` with unsafe characters replaced."""
    return F.concat(names.safe_name(names.basename(path)), F.lit("_it"), names.zero_padded(iteration, 8))

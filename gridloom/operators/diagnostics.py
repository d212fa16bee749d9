"""Metadata reports over series paths and mesh names; no field data is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import names
from gridloom.operators.amr import labelled


def series_kinds(paths: DataFrame, path: str = "path") -> DataFrame:
    """Number of 2D (tagged) and 3D series."""
    kind = F.when(names.plane_tag(names.basename(path)).isNotNull(), "2D").otherwise("3D")
    return paths.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_series"))


def series_preview(paths: DataFrame, limit: int = 8, path: str = "path") -> DataFrame:
    """The first paths of each kind in path order, with tag and elevation."""
    base = names.basename(path)
    tagged = paths.select(F.col(path).alias("path"), names.plane_tag(base).alias("_t"), base.alias("name")).select(
        F.when(F.col("_t").isNotNull(), "2D").otherwise("3D").alias("kind"),
        "path", "name", F.col("_t.tag").alias("tag"), F.col("_t.elevation").alias("elevation"),
    )
    firsts = [tagged.filter(F.col("kind") == k).orderBy("path").limit(limit) for k in ("2D", "3D")]
    return firsts[0].unionByName(firsts[1])


def mesh_report(meshes: DataFrame, keys: Sequence[str], variable: str | None = None) -> DataFrame:
    """Mesh counts per group: all, parseable, percent parseable, matching `variable`.

    `meshes` has one row per (keys, mesh_name, component).
    """
    parsed = names.with_mesh(meshes, keep_unparsed=True)
    per_mesh = parsed.groupBy(*keys, "mesh_name").agg(
        F.max(F.col("_m").isNotNull()).alias("_ok"),
        F.max(names.matches_variable(variable, "mesh_name", "component", "_m")).alias("_hit"),
    )
    ok = F.count_if("_ok")
    return per_mesh.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mesh_count"),
        ok.alias("recognized_count"),
        (100 * ok / F.count(F.lit(1))).alias("pct_recognized"),
        F.count_if("_hit").alias("match_count"),
    )


def unrecognised(meshes: DataFrame, limit: int | None = None) -> DataFrame:
    out = meshes.filter(names.mesh_name("mesh_name").isNull()).select("mesh_name").distinct()
    return out if limit is None else out.orderBy("mesh_name").limit(limit)


def distinct_tags(meshes: DataFrame, limit: int | None = None) -> DataFrame:
    """Plane tags found in mesh names, with what they mean, in tag order."""
    tags = (
        names.with_mesh(meshes.select("mesh_name").distinct())
        .filter("_m.plane is not null")
        .select("_m.plane.tag", "_m.plane.plane", "_m.plane.normal_axis", "_m.plane.elevation")
        .distinct()
    )
    return tags if limit is None else tags.orderBy("tag").limit(limit)


def distinct_centerings(meshes: DataFrame) -> DataFrame:
    return (
        names.with_mesh(meshes.select("mesh_name").distinct())
        .select("_m.centering").filter("centering is not null").distinct()
    )


def mesh_groups(chunks: DataFrame, keys: Sequence[str] = ("series", "iteration")) -> DataFrame:
    """Distinct (label, level, patch, mesh_name, component), the grouping compositing follows."""
    return labelled(chunks).select(*keys, "label", "level", "patch", "mesh_name", "component").distinct()


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """True when two tables hold the same rows, duplicates counted."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

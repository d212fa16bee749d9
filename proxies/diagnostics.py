"""Metadata reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import amr, diagnostics
from proxies import tables as tb
from proxies.names import ELEVATION_SQL, NAMES_SQL, PARSED_SQL, RX, mesh_names, series_paths
from proxies.registry import query


@query(f"""with {NAMES_SQL} select case when tag0 = 'volume' then '3D' else '2D' end as kind, count(*) as n_series from nm group by 1""")
def series_kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.series_kinds(series_paths(spark, sf))


@query(f"""with {NAMES_SQL}, p as (select id, tag0, '/data/run7/sim.' || tag0 || '.it' || lpad(id::varchar, 8, '0') || '.bp5' as path from nm),
 r as (select *, row_number() over (partition by tag0 = 'volume' order by path) as rn from p)
select case when tag0 = 'volume' then '3D' else '2D' end as kind, path, case when tag0 <> 'volume' then tag0 end as tag from r where rn <= 8""")
def series_preview(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.series_preview(series_paths(spark, sf)).select("kind", "path", "tag")


@query(f"""with {PARSED_SQL}, s as (select distinct tag as s from pg where tag is not null)
select s as tag, regexp_extract(s, {RX}, 1) as plane, regexp_extract(s, {RX}, 2) as normal_axis, round({ELEVATION_SQL}, 9) as elevation from s""")
def distinct_tags(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.distinct_tags(mesh_names(spark, sf)).withColumn("elevation", F.round("elevation", 9))


@query(f"with {PARSED_SQL} select distinct centering from pg where centering is not null")
def distinct_centerings(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.distinct_centerings(mesh_names(spark, sf))


@query(f"""with {NAMES_SQL}, d as (select tag0, mesh_name, max(contains(lower(mesh_name), 'rho') or contains(lower(component), 'rho')) as hit,
   bool_and(id % 11 <> 5) as ok from mn group by all)
select tag0, count(*) as mesh_count, count_if(ok)::bigint as recognized_count, 100.0::double * count_if(ok) / count(*) as pct_recognized,
  count_if(hit)::bigint as match_count from d group by tag0""")
def mesh_report(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.mesh_report(mesh_names(spark, sf), ["tag0"], "rho")


@query(f"with {NAMES_SQL} select distinct mesh_name from mn where id % 11 = 5")
def unrecognised_names(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.unrecognised(mesh_names(spark, sf), None)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return amr.labelled(tb.chunks(spark, sf))


@query(f"""with {tb.CHUNKS} select chunk_id, iteration, label, level::int as level, patch::int as patch, ny::bigint as ny, nx::bigint as nx from ch""")
def chunk_clip(spark: SparkSession, sf: str) -> DataFrame:
    return amr.clip_chunks(labelled(spark, sf)).select(
        F.col("chunk_id").cast("bigint").alias("chunk_id"), "iteration", "label", "level", "patch",
        F.col("ext")[0].alias("ny"), F.col("ext")[1].alias("nx"),
    )


@query(f"""with {tb.CHUNKS} select iteration, label, level::int as level, patch::int as patch, 1024::bigint as declared_points,
  sum(ny * nx)::bigint as actual_points, count(*) as n_chunks, round(100 * (1 - sum(ny * nx) / 1024::double), 6) as pct_unwritten from ch group by all""")
def chunk_sparsity(spark: SparkSession, sf: str) -> DataFrame:
    return amr.sparsity(labelled(spark, sf)).select(
        "iteration", "label", "level", "patch", "declared_points", "actual_points", "n_chunks",
        F.round("pct_unwritten", 6).alias("pct_unwritten"),
    )


@query(f"""with {tb.CHUNKS}, r as (select *, row_number() over w - 1 as idx, count(*) over (partition by iteration, label, level, patch) as n
   from ch window w as (partition by iteration, label, level, patch order by chunk_id))
select iteration, label, level::int as level, chunk_id, idx, n as n_chunks, (ny * nx)::bigint as points from r where n <= 5 or idx < 2 or idx >= n - 2""")
def chunk_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = amr.chunk_listing(tb.chunks(spark, sf).select("series", "iteration", "time", "mesh_name", "component", "mesh_seq", "chunk_id", "shape", "off", "ext", "position"))
    return amr.labelled(rows).select(
        "iteration", "label", "level", F.col("chunk_id").cast("bigint").alias("chunk_id"), "idx", "n_chunks", "points"
    )


@query(f"""with {tb.CHUNKS} select distinct iteration, label, level::int as level, patch::int as patch from ch""")
def mesh_groups(spark: SparkSession, sf: str) -> DataFrame:
    return diagnostics.mesh_groups(tb.chunks(spark, sf)).select("iteration", "label", "level", "patch")


@query(f"""with {tb.CHUNKS}, lo as (select iteration, label, min(level) as l0 from ch group by all)
select ch.iteration, ch.label, min(x0) as x_min, max(x0 + nx * sp) as x_max, min(y0) as y_min, max(y0 + ny * sp) as y_max
from ch join lo on lo.iteration = ch.iteration and lo.label = ch.label and level = l0 group by all""")
def coarsest_extent(spark: SparkSession, sf: str) -> DataFrame:
    return amr.plane_extents(labelled(spark, sf)).drop("series")


@query(f"""with {tb.CHUNKS} select chunk_id, k::bigint as k, y0 + (k - 0.5::double) * sp as y_edge from ch, range(9) t(k) where k <= ny""")
def chunk_edges(spark: SparkSession, sf: str) -> DataFrame:
    return amr.chunk_edges(labelled(spark, sf)).select(
        F.col("chunk_id").cast("bigint").alias("chunk_id"), F.posexplode("y_edges").alias("k", "y_edge")
    ).withColumn("k", F.col("k").cast("bigint"))


@query(f"with {tb.CHUNKS} select iteration, min(list_min(data)) as vmin, max(list_max(data)) as vmax from ch group by 1")
def shared_colour_scale(spark: SparkSession, sf: str) -> DataFrame:
    return amr.shared_colour_scale(tb.chunks(spark, sf)).drop("series")

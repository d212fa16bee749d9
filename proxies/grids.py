"""Slices, canvases and profiles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.scalars import (
    finite_or_null, rotation_rate, safe_divide, safe_divide_arrays,
)
from gridloom.operators import amr, boxes, fields, ordered, series
from gridloom.operators.painting import composite_slices
from proxies import tables as tb
from proxies.diagnostics import labelled
from proxies.registry import query

CELLS_SQL = f"{tb.SLICES}, cl as (select * exclude (data), k // 8 as i, k % 8 as j, data[k + 1] as v from sl, range(64) t(k))"


@query(f"with {CELLS_SQL} select run, variable, iteration, i, j, v from cl")
def field_cells(spark: SparkSession, sf: str) -> DataFrame:
    return fields.cells(tb.slices(spark, sf)).select(
        "run", "variable", "iteration", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), "v"
    )


@query(f"""with {tb.SLICES}, x as (select *, row_number() over (partition by run, variable order by iteration) - 1 as k from sl),
 pr as (select a.run, a.k, a.iteration as it_rho, b.iteration as it_press, a.data as da, b.data as db
        from x a join x b on a.run = b.run and a.k = b.k and a.variable = 'rho' and b.variable = 'press')
select run, k as frame_idx, it_rho, it_press, q as pos, da[q + 1] / db[q + 1] as ratio from pr, range(64) t(q)""")
def frame_align_ratio(spark: SparkSession, sf: str) -> DataFrame:
    frames = fields.align_frames(tb.slices(spark, sf), {"rho": "rho", "press": "press"})
    return fields.derived(frames, "ratio", "rho", "press").select(
        "run", "frame_idx", F.col("rho.iteration").alias("it_rho"), F.col("press.iteration").alias("it_press"),
        F.posexplode("ratio").alias("pos", "ratio"),
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"""with {tb.SLICES}, c as (select run, variable, count(*) as n from sl group by all)
select run, min(n) as n_frames from c group by run""")
def frame_count(spark: SparkSession, sf: str) -> DataFrame:
    return fields.frame_count(tb.slices(spark, sf))


@query("""with c as (select vec_id, k, embedding[k + 1]::double as n, round(embedding[k + 1]::double * 8) as d
   from embeddings, range(64) t(k))
select vec_id, k as pos, d = 0 as bad, case when d <> 0 then n / d end as ratio from c""")
def safe_divide_field(spark: SparkSession, sf: str) -> DataFrame:
    data = F.col("embedding").cast("array<double>")
    den = F.transform(data, lambda v: F.round(v * 8))
    return (
        tb.read(spark, sf, "embeddings")
        .select("vec_id", F.posexplode(safe_divide_arrays(data, den)).alias("pos", "r"))
        .select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.isnan("r").alias("bad"), finite_or_null("r").alias("ratio"))
    )


@query(f"with {tb.SLICES} select run, variable, iteration, list_max(data) as v_max, list_min(data) as v_min from sl")
def field_max_min(spark: SparkSession, sf: str) -> DataFrame:
    return fields.slice_extrema(tb.slices(spark, sf)).select("run", "variable", "iteration", "v_max", "v_min")


@query(f"with {CELLS_SQL} select run, variable, max(v) as v_max, min(v) as v_min from cl group by all")
def grid_reduction(spark: SparkSession, sf: str) -> DataFrame:
    return series.reduce_grid(fields.cells(tb.slices(spark, sf)), ["run", "variable"], "v")


@query(f"""with {CELLS_SQL}, a as (select iteration, false as log, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.99) as hi from cl group by all
 union all select iteration, true, quantile_cont(v, 0.01), quantile_cont(v, 0.99) from cl where v > 0 group by all)
select iteration, log, round(lo, 9) as vmin, round(case when lo = hi then (case when lo <> 0 then lo * 1.01::double else 1 end) else hi end, 9) as vmax,
  log and lo > 0 as log_norm from a""")
def color_limits_p1_p99(spark: SparkSession, sf: str) -> DataFrame:
    cells = fields.cells(tb.slices(spark, sf))
    both = [
        fields.colour_limits(cells, ["iteration"], "v", log=log).select(
            "iteration", F.lit(log).alias("log"), F.round("vmin", 9).alias("vmin"), F.round("vmax", 9).alias("vmax"), "log_norm"
        )
        for log in (False, True)
    ]
    return both[0].unionByName(both[1])


@query("""select vec_id, sum(case when round(e * 8) = 0 then 1 else 0 end)::bigint as n_nan
from (select vec_id, unnest(embedding)::double as e from embeddings) group by 1""")
def nan_pixel_count(spark: SparkSession, sf: str) -> DataFrame:
    data = F.col("embedding").cast("array<double>")
    ratio = safe_divide_arrays(data, F.transform(data, lambda v: F.round(v * 8)))
    return tb.read(spark, sf, "embeddings").select("vec_id", fields.nan_count(ratio).alias("n_nan"))


@query(f"""with {tb.CHUNKS} select chunk_id, q // 8 as j, q % 8 as i, y0 + (q // 8) * sp as y, x0 + (q % 8) * sp as x, data[q + 1] as v
from ch, range(64) t(q) where q // 8 < ny and q % 8 < nx""")
def world_coords(spark: SparkSession, sf: str) -> DataFrame:
    c = amr.clip_chunks(labelled(spark, sf))
    y, x = amr.axis_2d(0), amr.axis_2d(1)
    return (
        c.select("chunk_id", "ext", y.first.alias("y0"), x.first.alias("x0"), y.step.alias("sp"), F.posexplode("data").alias("q", "v"))
        .withColumns({"j": F.expr("q div 8"), "i": F.expr("cast(q % 8 as bigint)")})
        .filter("j < ext[0] and i < ext[1]")
        .select(
            F.col("chunk_id").cast("bigint").alias("chunk_id"), "j", "i",
            (F.col("y0") + F.col("j") * F.col("sp")).alias("y"), (F.col("x0") + F.col("i") * F.col("sp")).alias("x"), "v",
        )
    )


def _writes_sql(n: int, linear: bool, extent: str, width: int = 8) -> str:
    """SQL for all finite canvas writes; `extent` defines ext(iteration, label, x_min, x_max, y_min, y_max)."""
    def point(i: str, a: str) -> str:
        return f"case when {i} = {n - 1} then {a}_max else {a}_min + {i} * (({a}_max - {a}_min) / {n - 1}) end"

    def near(a: str) -> str:
        # First index whose centre is at or past the point; one back only if strictly closer.
        k = f"least(n{a} - 1, greatest(0, ceil(({a} - {a}0) / sp)))"
        return f"(case when {k} > 0 and abs({a} - ({a}0 + ({k} - 1) * sp)) < abs({a} - ({a}0 + {k} * sp)) then {k} - 1 else {k} end)::bigint"

    def low(a: str) -> str:
        return f"least(n{a} - 2, greatest(0, floor(({a} - {a}0) / sp)))::bigint"

    def at(j: str, i: str) -> str:
        return f"data[({j}) * {width} + ({i}) + 1]"

    wy, wx = "((y - (y0 + jy * sp)) / ((y0 + (jy + 1) * sp) - (y0 + jy * sp)))", "((x - (x0 + ix * sp)) / ((x0 + (ix + 1) * sp) - (x0 + ix * sp)))"
    lin = (
        f"{at('jy', 'ix')} * (1 - {wy}) * (1 - {wx}) + {at('jy', 'ix + 1')} * (1 - {wy}) * {wx}"
        f" + {at('jy + 1', 'ix')} * {wy} * (1 - {wx}) + {at('jy + 1', 'ix + 1')} * {wy} * {wx}"
    )
    hull = "y >= y0 and y <= y0 + (ny - 1) * sp and x >= x0 and x <= x0 + (nx - 1) * sp and ny > 1 and nx > 1"
    nearest = at("jn", "inn")
    value = f"case when {hull} then {lin} else {nearest} end" if linear else nearest
    return f"""{extent},
 py as (select ch.*, x_min, x_max, y_min, y_max, j, {point('j', 'y')} as y from ch join ext on ch.iteration = ext.iteration and ch.label = ext.label, range({n}) t(j)),
 qy as (select * from py where y >= y0 - (case when ny > 1 then sp / 2 else 0 end) and y <= y0 + (ny - 1) * sp + (case when ny > 1 then sp / 2 else 0 end)),
 px as (select *, {point('i', 'x')} as x from qy, range({n}) t(i)),
 qx as (select * from px where x >= x0 - (case when nx > 1 then sp / 2 else 0 end) and x <= x0 + (nx - 1) * sp + (case when nx > 1 then sp / 2 else 0 end)),
 ix as (select *, {near('y')} as jn, {near('x')} as inn, {low('y')} as jy, {low('x')} as ix from qx),
 wr as (select iteration, label, chunk_id, prio, j, i, y, x, {value} as v from ix),
 cv as (select iteration, label, j, i, arg_max(v, prio) as v from wr where v is not null and isfinite(v) group by all)"""


AUTO = """lo as (select iteration, label, min(level) as l0 from ch group by all),
 ext as (select ch.iteration, ch.label, min(x0) as x_min, max(x0 + nx * sp) as x_max, min(y0) as y_min, max(y0 + ny * sp) as y_max
   from ch join lo on lo.iteration = ch.iteration and lo.label = ch.label and level = l0 group by all)"""
FIXED = """ext as (select distinct iteration, label, 0::double as x_min, 33::double as x_max, 0::double as y_min, 33::double as y_max from ch)"""


def _canvas(df: DataFrame) -> DataFrame:
    return df.select(
        "iteration", "label", F.col("j").cast("bigint").alias("j"), F.col("i").cast("bigint").alias("i"), F.round("v", 9).alias("v")
    )


@query(f"with {tb.CHUNKS}, {_writes_sql(64, False, AUTO)} select iteration, label, j, i, round(v, 9) as v from cv")
def amr_composite_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _canvas(amr.composite_plane(labelled(spark, sf), nx=64, ny=64, method="nearest", dense=False))


@query(f"with {tb.CHUNKS}, {_writes_sql(64, True, AUTO)} select iteration, label, j, i, round(v, 9) as v from cv")
def amr_composite_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _canvas(amr.composite_plane(labelled(spark, sf), nx=64, ny=64, method="linear", dense=False))


@query(f"""with {tb.CHUNKS}, {_writes_sql(48, True, FIXED)}
select e.iteration, e.label, j.j, i.i, round(cv.v, 9) as v, cv.v is null as unwritten
from (select distinct iteration, label from ch) e cross join range(48) j(j) cross join range(48) i(i)
left join cv on cv.iteration = e.iteration and cv.label = e.label and cv.j = j.j and cv.i = i.i""")
def bilinear_resample(spark: SparkSession, sf: str) -> DataFrame:
    canvas = amr.composite_plane(labelled(spark, sf), nx=48, ny=48, method="linear", extent=amr.Extent(0, 33, 0, 33))
    return _canvas(canvas).withColumns({"unwritten": F.isnan("v"), "v": finite_or_null("v")})


@query(f"""with {tb.CHUNKS}, {_writes_sql(48, True, FIXED)}
select e.iteration, e.label, j.j, i.i, round(cv.v, 9) as v
from (select distinct iteration, label from ch) e cross join range(48) j(j) cross join range(48) i(i)
left join cv on cv.iteration = e.iteration and cv.label = e.label and cv.j = j.j and cv.i = i.i""")
def resample_slices(spark: SparkSession, sf: str) -> DataFrame:
    """The same grid as whole slices, x first, with their unwritten points."""
    out = composite_slices(
        labelled(spark, sf), nx=48, ny=48, method="linear", extent=amr.Extent(0, 33, 0, 33), keys=["iteration", "label"]
    )
    return out.select("iteration", "label", F.posexplode("data").alias("q", "v")).select(
        "iteration", "label", F.expr("cast(q % 48 as bigint)").alias("j"), F.expr("q div 48").alias("i"),
        F.round(finite_or_null("v"), 9).alias("v"),
    )


@query(f"with {tb.CHUNKS}, {_writes_sql(48, False, FIXED)} select iteration, label, j, i, round(v, 9) as v from cv")
def nearest_resample(spark: SparkSession, sf: str) -> DataFrame:
    canvas = amr.composite_plane(
        labelled(spark, sf), nx=48, ny=48, method="nearest", extent=amr.Extent(0, 33, 0, 33), dense=False
    )
    return _canvas(canvas)


RECIPE_EXT = """lead as (select * from ch where label = 'hydrobasex_rho'), lo as (select iteration, min(level) as l0 from lead group by 1),
 e1 as (select lead.iteration, min(x0) as x_min, max(x0 + nx * sp) as x_max, min(y0) as y_min, max(y0 + ny * sp) as y_max
   from lead join lo on lo.iteration = lead.iteration and level = l0 group by all),
 ext as (select e1.*, l.label from e1 cross join (select distinct label from ch) l)"""


@query(f"""with {tb.CHUNKS}, {_writes_sql(64, True, RECIPE_EXT)},
 d as (select a.iteration, a.j, a.i, a.v / b.v as v from cv a join cv b on a.iteration = b.iteration and a.j = b.j and a.i = b.i
   and a.label = 'hydrobasex_rho' and b.label = 'hydrobasex_press' where b.v <> 0)
select iteration, j, i, round(v, 6) as v from d""")
def recipe_combine(spark: SparkSession, sf: str) -> DataFrame:
    out = amr.composite_recipe(
        labelled(spark, sf), {"rho": "hydrobasex_rho", "p": "hydrobasex_press"},
        lambda v: safe_divide(v["rho"], v["p"]), nx=64, ny=64,
    )
    return out.select(
        "iteration", F.col("j").cast("bigint").alias("j"), F.col("i").cast("bigint").alias("i"), F.round("v", 6).alias("v")
    ).filter(~F.isnan("v"))


@query(f"""with {tb.CHUNKS}, c as (select iteration, label, level, patch, chunk_id, oy + q // 8 as gj, ox + q % 8 as gi, data[q + 1] as v
   from ch, range(64) t(q) where q // 8 < ny and q % 8 < nx)
select iteration, label, level::int as level, patch::int as patch, gj, gi, arg_max(v, chunk_id) as v from c group by all""")
def mesh_assemble(spark: SparkSession, sf: str) -> DataFrame:
    full = amr.assemble(tb.chunks(spark, sf))
    return amr.labelled(full).select("iteration", "label", "level", "patch", "gj", "gi", "v").filter(~F.isnan("v"))


def chunks_3d(spark: SparkSession, sf: str) -> DataFrame:
    """The same arrays read as 4 x 4 x 4 chunks (z, y, x)."""
    return tb.read(spark, sf, "embeddings").selectExpr(
        "'sim' as series", "vec_id % 5 as iteration", "vec_id * 0.25D as time",
        "format_string('hydrobasex_rho_patch%02d_lev%02d', vec_id % 4, label % 3) as mesh_name", "'scalar' as component",
        "0 as mesh_seq", "cast(vec_id as int) as chunk_id", "array(64L, 64L, 64L) as shape",
        "array(vec_id % 5, (vec_id * 5) % 13, (vec_id * 3) % 13) as off", "array(4L, 4L, 4L) as ext",
        "array(-2D, 0D, 0D) as grid_offset",
        "array(1D / pow(2D, label % 3), 1D / pow(2D, label % 3), 1D / pow(2D, label % 3)) as spacing",
        "array(0D, 0D, 0D) as position", "cast(embedding as array<double>) as data",
    )


def _box(full: DataFrame, *index: str) -> DataFrame:
    return amr.labelled(full).select(
        "iteration", "label", "level", "patch", *index, finite_or_null("v").alias("v"), F.isnan("v").alias("unwritten")
    )


@query(f"""with {tb.CHUNKS}, c as (select iteration, label, level, patch, chunk_id, oy + q // 8 as gj, ox + q % 8 as gi, data[q + 1] as v
   from ch, range(64) t(q) where q // 8 < ny and q % 8 < nx),
 w as (select iteration, label, level, patch, gj, gi, arg_max(v, chunk_id) as v from c group by all),
 b as (select iteration, label, level, patch, min(gj) as j0, max(gj) as j1, min(gi) as i0, max(gi) as i1 from c group by all),
 r as (select *, unnest(range(j0, j1 + 1)) as gj from b), g as (select *, unnest(range(i0, i1 + 1)) as gi from r)
select g.iteration, g.label, g.level::int as level, g.patch::int as patch, g.gj, g.gi, w.v, w.v is null as unwritten
from g left join w on w.iteration = g.iteration and w.label = g.label and w.level = g.level and w.patch = g.patch and w.gj = g.gj and w.gi = g.gi""")
def mesh_assemble_box(spark: SparkSession, sf: str) -> DataFrame:
    """The whole bounding boxes, with their unwritten points."""
    return _box(amr.assemble(tb.chunks(spark, sf)), "gj", "gi")


@query("""with c as (select vec_id % 5 as iteration, label % 3 as level, vec_id % 4 as patch, vec_id, vec_id % 5 + q // 16 as gk,
   (vec_id * 5) % 13 + (q // 4) % 4 as gj, (vec_id * 3) % 13 + q % 4 as gi, embedding[q + 1]::double as v from embeddings, range(64) t(q)),
 w as (select iteration, level, patch, gk, gj, gi, arg_max(v, vec_id) as v from c group by all),
 b as (select iteration, level, patch, min(gk) as k0, max(gk) as k1, min(gj) as j0, max(gj) as j1, min(gi) as i0, max(gi) as i1 from c group by all),
 s as (select *, unnest(range(k0, k1 + 1)) as gk from b), r as (select *, unnest(range(j0, j1 + 1)) as gj from s),
 g as (select *, unnest(range(i0, i1 + 1)) as gi from r)
select g.iteration, 'hydrobasex_rho' as label, g.level::int as level, g.patch::int as patch, g.gk, g.gj, g.gi, w.v, w.v is null as unwritten
from g left join w on w.iteration = g.iteration and w.level = g.level and w.patch = g.patch and w.gk = g.gk and w.gj = g.gj and w.gi = g.gi""")
def mesh_assemble_3d(spark: SparkSession, sf: str) -> DataFrame:
    return _box(amr.assemble(chunks_3d(spark, sf)), "gk", "gj", "gi")


@query(f"""with {tb.CHUNKS}, pt as (select distinct iteration, label, level, patch, oy + q // 8 as gj, ox + q % 8 as gi from ch, range(64) t(q) where q // 8 < ny and q % 8 < nx)
select iteration, label, level::int as level, patch::int as patch, count(*) as written_points,
  ((max(gj) - min(gj) + 1) * (max(gi) - min(gi) + 1))::bigint as box_points from pt group by all""")
def written_volume_union(spark: SparkSession, sf: str) -> DataFrame:
    """Points written by at least one chunk, however many overlap there."""
    keys = ["iteration", "label", "level", "patch"]
    return boxes.union_volume(boxes.bounds(amr.clip_chunks(labelled(spark, sf)), keys, 2), keys)


@query("""with c as (select vec_id % 5 as iteration, label % 3 as level, vec_id % 4 as patch, vec_id % 5 + q // 16 as gk,
   (vec_id * 5) % 13 + (q // 4) % 4 as gj, (vec_id * 3) % 13 + q % 4 as gi from embeddings, range(64) t(q)),
 b as (select iteration, level, patch, min(gk) as k0, max(gk) as k1, min(gj) as j0, max(gj) as j1, min(gi) as i0, max(gi) as i1 from c group by all),
 s as (select *, unnest(range(k0, k1 + 1)) as gk from b), r as (select *, unnest(range(j0, j1 + 1)) as gj from s),
 g as (select *, unnest(range(i0, i1 + 1)) as gi from r),
 f as (select iteration, level, patch, gk, gj, gi from g except select iteration, level, patch, gk, gj, gi from c),
 f2 as (select *, gi - row_number() over (partition by iteration, level, patch, gk, gj order by gi) as run from f),
 r2 as (select iteration, level, patch, gk, gj, min(gi) as lo_2, max(gi) + 1 as hi_2 from f2 group by iteration, level, patch, gk, gj, run),
 f1 as (select *, gj - row_number() over (partition by iteration, level, patch, gk, lo_2, hi_2 order by gj) as run from r2),
 r1 as (select iteration, level, patch, gk, lo_2, hi_2, min(gj) as lo_1, max(gj) + 1 as hi_1 from f1 group by iteration, level, patch, gk, lo_2, hi_2, run),
 f0 as (select *, gk - row_number() over (partition by iteration, level, patch, lo_1, hi_1, lo_2, hi_2 order by gk) as run from r1)
select iteration, level::int as level, patch::int as patch, min(gk) as lo_0, max(gk) + 1 as hi_0, lo_1, hi_1, lo_2, hi_2
from f0 group by iteration, level, patch, lo_1, hi_1, lo_2, hi_2, run""")
def unwritten_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """What the chunks leave blank of the bounding box of each patch, as 3D boxes instead of points."""
    keys = ["iteration", "level", "patch"]
    return boxes.unwritten(boxes.bounds(amr.clip_chunks(amr.labelled(chunks_3d(spark, sf))), keys, 3), keys)


@query(f"""with {tb.CHUNKS}, {_writes_sql(64, True, RECIPE_EXT)},
 d as (select a.iteration, a.j, a.i, a.v / b.v as v from cv a join cv b on a.iteration = b.iteration and a.j = b.j and a.i = b.i
   and a.label = 'hydrobasex_rho' and b.label = 'hydrobasex_press' where b.v <> 0)
select e.iteration, j.j, i.i, round(d.v, 6) as v, d.v is null as unwritten
from (select distinct iteration from lead) e cross join range(64) j(j) cross join range(64) i(i)
left join d on d.iteration = e.iteration and d.j = j.j and d.i = i.i""")
def recipe_canvas(spark: SparkSession, sf: str) -> DataFrame:
    """The whole canvas of `recipe_combine`, with the points where it has no value."""
    out = amr.composite_recipe(
        labelled(spark, sf), {"rho": "hydrobasex_rho", "p": "hydrobasex_press"},
        lambda v: safe_divide(v["rho"], v["p"]), nx=64, ny=64,
    )
    return out.select(
        "iteration", F.col("j").cast("bigint").alias("j"), F.col("i").cast("bigint").alias("i"),
        F.round(finite_or_null("v"), 6).alias("v"), F.isnan("v").alias("unwritten"),
    )


SLICE_AT = 0.5
SLICE_SQL = f"""s0 as (
    select vec_id as chunk_id, vec_id % 5 as iteration, 'hydrobasex_rho' as label, (label % 3)::bigint as level, vec_id % 4 as patch,
           1::double / pow(2, label % 3) as sp, -2 + (vec_id % 5) * (1::double / pow(2, label % 3)) as z0,
           ((vec_id * 5) % 13) * (1::double / pow(2, label % 3)) as y0, ((vec_id * 3) % 13) * (1::double / pow(2, label % 3)) as x0,
           embedding::double[] as d3 from embeddings),
  s1 as (select *, least(3, greatest(0, ceil(({SLICE_AT}::double - z0) / sp - 0.5)))::bigint as kz from s0
     where {SLICE_AT}::double between z0 - sp / 2 and z0 + 3 * sp + sp / 2),
  ch as (select *, 4 as ny, 4 as nx, d3[kz * 16 + 1 : kz * 16 + 16] as d2,
     ((level * 65536 + patch) * 65536) * 8388608 + chunk_id as prio from s1)"""


@query(f"with {SLICE_SQL}, " + _writes_sql(40, False, """lo as (select iteration, label, min(level) as l0 from ch group by all),
 ext as (select ch.iteration, ch.label, min(x0) as x_min, max(x0 + 3 * sp) as x_max, min(y0) as y_min, max(y0 + 3 * sp) as y_max
   from ch join lo on lo.iteration = ch.iteration and level = l0 group by all)""").replace("data[(jn) * 8 + (inn) + 1]", "d2[jn * 4 + inn + 1]")
    + " select iteration, label, j, i, round(v, 9) as v from cv")
def slice_3d(spark: SparkSession, sf: str) -> DataFrame:
    chunks = amr.labelled(chunks_3d(spark, sf))
    return _canvas(amr.composite_slice(chunks, "xy", SLICE_AT, n=40, method="nearest", dense=False))


#: Record axes (z, y, x) of `chunks_3d` with origin and stride: which is cut, which runs slow and which fast.
_AXES_3D = {"z": ("-2 + (vec_id % 5) * sp", 16), "y": ("((vec_id * 5) % 13) * sp", 4), "x": ("((vec_id * 3) % 13) * sp", 1)}
_CUTS = {"xy": ("z", "y", "x", 0.5), "xz": ("y", "z", "x", 2.2), "yz": ("x", "z", "y", 3.25)}


def _cut_sql(axis: str) -> str:
    """ch: the slabs that a cut meets, as 2D chunks."""
    cut, slow, fast, at = _CUTS[axis]
    (c0, cs), (s0, ss), (f0, fs) = (_AXES_3D[a] for a in (cut, slow, fast))
    return f"""a0 as (select vec_id, label, 1::double / pow(2, label % 3) as sp, embedding::double[] as d3 from embeddings),
  a1 as (select vec_id as chunk_id, vec_id % 5 as iteration, 'hydrobasex_rho' as label, (label % 3)::bigint as level, vec_id % 4 as patch, sp, 4 as ny, 4 as nx,
     {c0} as c0, {s0} as y0, {f0} as x0, d3 from a0),
  a2 as (select *, least(3, greatest(0, ceil(({at}::double - c0) / sp - 0.5)))::bigint as kc from a1 where {at}::double between c0 - sp / 2 and c0 + 3 * sp + sp / 2),
  ch as (select * exclude (d3), [d3[kc * {cs} + (q // 4) * {ss} + (q % 4) * {fs} + 1] for q in range(16)] as data,
     ((level * 65536 + patch) * 65536) * 8388608 + chunk_id as prio from a2)"""


_CUT_BOX = """lo as (select iteration, label, min(level) as l0 from ch group by all),
 ext as (select ch.iteration, ch.label, min(x0) as x_min, max(x0 + 3 * sp) as x_max, min(y0) as y_min, max(y0 + 3 * sp) as y_max
   from ch join lo on lo.iteration = ch.iteration and level = l0 group by all)"""


def _cut_query(axis: str, method: str) -> None:
    def cut(spark: SparkSession, sf: str) -> DataFrame:
        return _canvas(amr.composite_slice(amr.labelled(chunks_3d(spark, sf)), axis, _CUTS[axis][3], n=40, method=method, dense=False))

    cut.__name__ = f"slice_{axis}_{method}"
    query(f"with {_cut_sql(axis)}, {_writes_sql(40, method == 'linear', _CUT_BOX, 4)} select iteration, label, j, i, round(v, 9) as v from cv")(cut)


for _axis, _method in (("xy", "linear"), ("xz", "nearest"), ("xz", "linear"), ("yz", "nearest"), ("yz", "linear")):
    _cut_query(_axis, _method)


@query(f"""with {CELLS_SQL}, c as (select iteration, i, j, (i - 3.5::double) as x, (j - 3.5::double) as y, v from cl),
 r as (select *, sqrt(x * x + y * y) + 1e-17::double as r from c)
select iteration, i, j, round({tb.MILLIS_SQL} * (0.5::double * ((x / r) * (v + 1) - (y / r) * v) / r - ((x / r) * 0.25::double - (y / r) * v) / r), 6) as omega from r""")
def cylindrical_omega(spark: SparkSession, sf: str) -> DataFrame:
    c = fields.cells(tb.slices(spark, sf)).withColumns({"x": F.col("i") - 3.5, "y": F.col("j") - 3.5})
    omega = rotation_rate("x", "y", F.col("v"), F.col("v") + 1, F.col("v"), F.lit(0.25), F.lit(0.5))
    return c.select(
        "iteration", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.round(omega, 6).alias("omega")
    )


N_PHI, R_STEP, R_STOP = 32, 0.25, 5.0
_BRACKET = "least(6, greatest(0, floor({0} + 3.5::double)))::bigint"


@query(f"""with {tb.SLICES},
 m as (select iteration, data, k, 0.125::double + k * {R_STEP}::double as r, q * '{2 * math.pi / N_PHI!r}'::double as phi
   from sl, range({math.ceil((R_STOP - 0.125) / R_STEP)}) t(k), range({N_PHI}) u(q)),
 p as (select *, r * cos(phi) as x, r * sin(phi) as y from m),
 b as (select *, {_BRACKET.format('x')} as i0, {_BRACKET.format('y')} as j0 from p),
 w as (select *, x + 3.5::double - i0 as wx, y + 3.5::double - j0 as wy from b)
select iteration, k, r, round(sum(data[i0 * 8 + j0 + 1] * (1 - wx) * (1 - wy) + data[i0 * 8 + j0 + 2] * (1 - wx) * wy
  + data[(i0 + 1) * 8 + j0 + 1] * wx * (1 - wy) + data[(i0 + 1) * 8 + j0 + 2] * wx * wy) / {N_PHI}, 6) as mean
from w group by all""")
def azimuthal_mean(spark: SparkSession, sf: str) -> DataFrame:
    out = fields.polar_mean(
        tb.slices(spark, sf), ["iteration"], x0=-3.5, y0=-3.5, dx=1.0, dy=1.0,
        r_start=0.125, r_stop=R_STOP, r_step=R_STEP, n_phi=N_PHI,
    )
    return out.select("iteration", F.col("k").cast("bigint").alias("k"), "r", F.round("mean", 6).alias("mean"))


@query(f"""with {CELLS_SQL} select iteration, i, j, v from cl
where i between (iteration % 8) - 1.75::double and (iteration % 8) + 1.75::double and j between 1.75::double and 5.25::double""")
def track_zoom(spark: SparkSession, sf: str) -> DataFrame:
    sl = tb.slices(spark, sf)
    track = sl.select("iteration", (F.col("iteration") % 8).cast("double").alias("cx"), F.lit(3.5).alias("cy"))
    cells = fields.cells(sl).withColumns({"x": F.col("i").cast("double"), "y": F.col("j").cast("double")})
    return fields.zoom(cells, track, ["iteration"]).select(
        "iteration", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), "v"
    )


@query(f"""with {tb.CHUNKS}, {_writes_sql(48, False, FIXED)}
select e.iteration, e.label, i.i * 48 + j.j as pos, round(cv.v, 9) as v
from (select distinct iteration, label from ch) e cross join range(48) j(j) cross join range(48) i(i)
left join cv on cv.iteration = e.iteration and cv.label = e.label and cv.j = j.j and cv.i = i.i""")
def canvas_to_slices(spark: SparkSession, sf: str) -> DataFrame:
    canvas = amr.composite_plane(
        labelled(spark, sf), nx=48, ny=48, method="nearest", extent=amr.Extent(0, 33, 0, 33)
    )
    return (
        fields.to_slices(canvas, ["iteration", "label"])
        .select("iteration", "label", F.posexplode("data").alias("pos", "v"))
        .select("iteration", "label", F.col("pos").cast("bigint").alias("pos"), F.round(finite_or_null("v"), 9).alias("v"))
    )

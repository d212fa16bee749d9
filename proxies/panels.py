"""Contour lines and frames of several panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.scalars import safe_divide_arrays
from gridloom.operators import contours
from gridloom.plans import config, frames
from proxies import tables as tb
from proxies.registry import query

LEVELS = (-0.05, 0.1)


def _lines_sql(source: str, keys: str, levels: str) -> str:
    """SQL whose last table ln(keys, level, line, closed, pos, edge, x, y) holds the lines of 8 x 8 arrays `data` of `source`.

    Every edge that starts a segment is walked from; kept are the walks that start where no segment ends, or
    at the least edge of a loop. The query must begin with `with recursive`.
    """
    on = " and ".join(f"w.{k} = sg.{k}" for k in (*keys.split(", "), "level"))
    low = "data[edge // 2 + 1]"
    high = "data[edge // 2 + 1 + case when edge % 2 = 0 then 8 else 1 end]"
    return f"""lv as (select *, unnest({levels}) as level from {source}),
 co as (select {keys}, level, p, data[p + 1] as a, data[p + 9] as b, data[p + 10] as c, data[p + 2] as d from lv, range(56) t(p) where p % 8 < 7),
 cs as (select *, (a > level)::int + 2 * (b > level)::int + 4 * (c > level)::int + 8 * (d > level)::int as k, a / 4 + b / 4 + c / 4 + d / 4 > level as up from co),
 pr as (select *, unnest(case when k = 1 then ['SW'] when k = 2 then ['ES'] when k = 3 then ['EW'] when k = 4 then ['NE'] when k = 6 then ['NS'] when k = 7 then ['NW']
     when k = 8 then ['WN'] when k = 9 then ['SN'] when k = 11 then ['EN'] when k = 12 then ['WE'] when k = 13 then ['SE'] when k = 14 then ['WS']
     when k = 5 and up then ['SE', 'NW'] when k = 5 then ['SW', 'NE'] when k = 10 and up then ['WS', 'EN'] when k = 10 then ['ES', 'WN'] else [] end) as s from cs),
 sg as (select {keys}, level, {", ".join(f"case s[{n}] when 'S' then 2 * p when 'E' then 2 * (p + 8) + 1 when 'N' then 2 * (p + 1) else 2 * p + 1 end as {c}" for n, c in ((1, 'f'), (2, 'g')))} from pr),
 en as (select {keys}, level, g from sg),
 st as (select w.*, en.g is null as free from sg w left join en on {on.replace('sg.', 'en.')} and en.g = w.f),
 wk as (select {keys}, level, f as start, free, 0 as pos, f as edge from st
   union all
   select w.{keys.replace(', ', ', w.')}, w.level, w.start, w.free, w.pos + 1, sg.g from wk w join sg on {on} and sg.f = w.edge
   where (w.pos = 0 or w.edge <> w.start) and (w.free or sg.g >= w.start)),
 ok as (select {keys}, level, start, min(edge) as line, not free as closed from wk group by {keys}, level, start, free having free or bool_or(pos > 0 and edge = start)),
 pt as (select w.*, ok.line, ok.closed from wk w join ok on {on.replace('sg.', 'ok.')} and ok.start = w.start),
 fr as (select {", ".join(f"pt.{k}" for k in keys.split(", "))}, level, line, closed, pos, edge, (level - {low}) / ({high} - {low}) as part
   from pt join {source} s on {" and ".join(f"s.{k} = pt.{k}" for k in keys.split(", "))}),
 ln as (select *, edge // 16 + case when edge % 2 = 0 then part else 0 end as x, (edge // 2) % 8 + case when edge % 2 = 1 then part else 0 end as y from fr)"""


@query(f"""with recursive {tb.SLICES}, {_lines_sql('sl', 'run, variable, iteration', str(list(LEVELS)) + '::double[]')}
select run, variable, iteration, level, line, closed, pos, edge, round(0.5 * x - 2, 9) as x, round(0.25 * y - 1, 9) as y from ln""")
def contour_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive points of a line are its segments."""
    got = contours.lines(tb.slices(spark, sf), ["run", "variable", "iteration"], LEVELS, x=(-2.0, 0.5), y=(-1.0, 0.25))
    return got.withColumns({"x": F.round("x", 9), "y": F.round("y", 9)})


SETTINGS = {**config.MOVIE_DEFAULTS, "FRAME_START": 2, "FRAME_STRIDE": 3, "FIG_ROWS": 1, "FIG_COLS": 2, "OUT_PREFIX": "two"}
VARIABLES = {"rho": "rho", "p": "press", "e": "energy"}
SPECS = [
    frames.Panel(lambda v: v["rho"], "rho", r"$\rho$ {t:.3f} it={it}", 5.0, [frames.Contour(lambda v: v["rho"], "rho", [0.1, -0.05]),
                 frames.Contour(lambda v: v["e"], "e", [0.02])]),
    frames.Panel(lambda v: safe_divide_arrays(v["rho"], v["p"]), "p", "{idx}: {t:.3f}", -7.5, [frames.Contour(lambda v: v["e"], "e", [0.01])]),
    frames.Panel(lambda v: v["e"], "e", "no room"),
]
GRIDS = {"rho": frames.FieldGrid(8, (0.0, 1.0), (0.0, 1.0)), "e": frames.FieldGrid(8, (-1.0, 0.5), (2.0, 2.0))}


def _slices(spark: SparkSession, sf: str) -> DataFrame:
    """A third field: the squares of rho, three of four slices of it stored."""
    sl = tb.slices(spark, sf)
    third = sl.where("variable = 'rho' and iteration % 4 <> 1").withColumns({
        "variable": F.lit("energy"), "data": F.transform("data", lambda v: v * v),
    })
    return sl.unionByName(third)


FRAMES_SQL = f"""{tb.SLICES},
 th as (select * from sl union all select run, 'energy', iteration, time, [v * v for v in data] from sl where variable = 'rho' and iteration % 4 <> 1),
 ix as (select *, row_number() over (partition by run, variable order by iteration) - 1 as frame_idx from th),
 fm as (select r.run, r.frame_idx, (r.frame_idx - 2) // 3 as seq, r.iteration as it_r, r.time as t_r, p.iteration as it_p, p.time as t_p, r.data as dr, p.data as dp, e.data as de
   from ix r join ix p on p.run = r.run and p.frame_idx = r.frame_idx and p.variable = 'press' join ix e on e.run = r.run and e.frame_idx = r.frame_idx and e.variable = 'energy'
   where r.variable = 'rho' and r.frame_idx >= 2 and (r.frame_idx - 2) % 3 = 0)"""


@query(f"""with {FRAMES_SQL}, pn as (
  select run, frame_idx, seq, 0 as panel, it_r as iteration, t_r as time, '$\\rho$ ' || format('{{:.3f}}', (t_r - 5) / {tb.MILLIS_SQL}) || ' it=' || it_r as title, 2 as n_contours, dr as data from fm
  union all select run, frame_idx, seq, 1, it_p, t_p, frame_idx || ': ' || format('{{:.3f}}', (t_p + 7.5) / {tb.MILLIS_SQL}), 1, [dr[k + 1] / dp[k + 1] for k in range(64)] from fm)
select run, frame_idx, seq, panel, 0 as row, panel as col, iteration, time, title, 'two_' || lpad(seq::varchar, greatest(4, length(seq::varchar))::int, '0') || '.png' as file, n_contours,
  k as pos, round(data[k + 1], 9) as v from pn, range(64) t(k)""")
def frame_panels(spark: SparkSession, sf: str) -> DataFrame:
    """Two panels with their own times, of three fields of different lengths."""
    made = frames.panels(_slices(spark, sf), VARIABLES, SPECS, SETTINGS)
    return made.select(
        "run", "frame_idx", "seq", "panel", "row", "col", "iteration", "time", "title", "file", F.size("contours").alias("n_contours"), F.posexplode("data").alias("pos", "v"),
    ).withColumns({"pos": F.col("pos").cast("bigint"), "v": F.round("v", 9)})


_KM = repr(SETTINGS["MSUN_TO_KM"])


@query(f"""with recursive {FRAMES_SQL},
 ps as (select run, frame_idx, 0 as panel, 0 as contour, [-0.05, 0.1]::double[] as levels, 0 as x0, 1 as dx, 0 as y0, 1 as dy, dr as data from fm
   union all select run, frame_idx, 0, 1, [0.02]::double[], -1, 0.5, 2, 2, de from fm union all select run, frame_idx, 1, 0, [0.01]::double[], -1, 0.5, 2, 2, de from fm),
 {_lines_sql('ps', 'run, frame_idx, panel, contour', 'levels')}
select ln.run, ln.frame_idx, ln.panel, ln.contour, level, line, closed, pos, edge, round((x0 + x * dx) * '{_KM}'::double, 9) as x, round((y0 + y * dy) * '{_KM}'::double, 9) as y
from ln join ps on ps.run = ln.run and ps.frame_idx = ln.frame_idx and ps.panel = ln.panel and ps.contour = ln.contour""")
def frame_panel_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Contours of the panels, two of them from a field that is not shown and lies on another grid."""
    made = frames.panels(_slices(spark, sf), VARIABLES, SPECS, SETTINGS)
    return frames.panel_lines(made, SPECS, GRIDS, SETTINGS).withColumns({"x": F.round("x", 9), "y": F.round("y", 9)})

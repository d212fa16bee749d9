"""Series, ordering and join operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.scalars import cutoff_periods, deformation, dimensionless_spin, radial_kinetic
from gridloom.operators import ordered, selection, series, tracks
from gridloom.operators.asof import asof_forward, nearest_in_time
from gridloom.plans.tasks import requested_variables, run_cutoffs, skipped_variables, task_grid as plan_task_grid
from proxies import tables as tb
from proxies.registry import query

PEAK = "{'a': round(y, 15), 't': t}"
MERGER = f"m as (select run, arg_max({{'t': t, 'y': y}}, {PEAK}) as m, max(t) as t_end, count(*) as n from ev group by run)"


@query(f"with {tb.EVENTS}, {MERGER} select run, m.t as t_merge, m.y as amp_merge, t_end, n from m")
def series_merger(spark: SparkSession, sf: str) -> DataFrame:
    return series.merger(tb.events(spark, sf), ["run"], "t", "y").withColumnRenamed("_n", "n")


@query(f"""with {tb.EVENTS}, {MERGER}, c as (select min(t_end - m.t) as tc from m)
select e.run, e.iteration, (e.t - m.m.t) / {tb.MILLIS_SQL} as t_ms, e.y / m.m.y as amp_norm
from ev e join m on e.run = m.run cross join c
where e.t >= m.m.t and e.t < tc + m.m.t and t_end >= tc + m.m.t""")
def series_shift_norm(spark: SparkSession, sf: str) -> DataFrame:
    return series.align(tb.events(spark, sf), ["run"], "t", "y").select("run", "iteration", "t_ms", "amp_norm")


@query(f"with {tb.EVENTS}, {MERGER} select min(t_end - m.t) as t_common from m")
def common_end(spark: SparkSession, sf: str) -> DataFrame:
    return series.common_end(series.merger(tb.events(spark, sf), ["run"], "t", "y"))


@query(f"""with {tb.EVENTS},
  i as (select *, row_number() over (partition by run order by t) - 1 as idx from ev),
  m as (select run, arg_max(idx, {{'a': round(y, 15), 'i': idx}}) as im from i group by run)
select i.run, iteration, idx, im as idx_merge from i join m on i.run = m.run where idx >= greatest(im - 214, 0)""")
def event_window(spark: SparkSession, sf: str) -> DataFrame:
    return series.event_window(tb.events(spark, sf), ["run"], "t", "y", before=214).select(
        "run", "iteration", "idx", "idx_merge"
    )


def _hours(spark: SparkSession, sf: str, shift: float) -> DataFrame:
    return tb.events(spark, sf).select(
        "run", (F.floor(F.col("t") / 3600).cast("double") * 3600 + shift).alias("target")
    )


def _asof_sql(shift: int, clamp: bool) -> str:
    time, it = ("coalesce(h.t, l.t)", "coalesce(h.it, l.it)") if clamp else ("h.t", "h.it")
    return f"""with {tb.EVENTS},
  tg as (select distinct run, floor(t / 3600)::double * 3600 + {shift} as target from ev),
  h as (select tg.run, target, min(t) as t, arg_min(iteration, t) as it
        from tg join ev on ev.run = tg.run and ev.t >= target group by all),
  l as (select run, max(t) as t, arg_max(iteration, t) as it from ev group by run)
select tg.run, tg.target, {time} as t, coalesce({it}, -1) as iteration
from tg left join h on h.run = tg.run and h.target = tg.target join l on l.run = tg.run"""


@query(_asof_sql(5400, False))
def asof_forward_lookup(spark: SparkSession, sf: str) -> DataFrame:
    hit = asof_forward(_hours(spark, sf, 5400.0), tb.events(spark, sf), ["run"], "target", "t", ["iteration"])
    return hit.fillna(-1, ["iteration"])


@query(_asof_sql(1800, False))
def asof_forward_ordered(spark: SparkSession, sf: str) -> DataFrame:
    hit = asof_forward(
        _hours(spark, sf, 1800.0), tb.events(spark, sf), ["run"], "target", "t", ["iteration"], few_targets=False
    )
    return hit.fillna(-1, ["iteration"])


@query(_asof_sql(5400, True))
def asof_clamped(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_in_time(_hours(spark, sf, 5400.0), tb.events(spark, sf), ["run"], "target", "t", ["iteration"])


def _dedup_sql(at: str) -> str:
    return f"""with {tb.RESTARTS}, f as (select run, {at}, min(restart) as r0 from rs group by all)
select rs.run, rs.restart, rs.iteration, rs.time, rs.y from rs join f on f.run = rs.run and f.{at} = rs.{at}
where rs.restart = r0"""


@query(_dedup_sql("iteration"))
def restart_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return series.first_restart_wins(tb.restarts(spark, sf), ["run"], "iteration", "restart").select(
        "run", "restart", "iteration", "time", "y"
    )


@query(_dedup_sql("time"))
def volume_dedup_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return series.first_restart_wins(tb.restarts(spark, sf), ["run"], "time", "restart").select(
        "run", "restart", "iteration", "time", "y"
    )


@query(f"""with {tb.EVENTS}, r as (
  select *, row_number() over (partition by run order by iteration) - 1 as i from ev where iteration >= 100)
select run, iteration, t from r where i % 3 = 0""")
def iter_range_stride(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.iteration_select(tb.events(spark, sf), ["run"], it_min=100, stride=3).select("run", "iteration", "t")


@query(f"""with {tb.EVENTS}, r as (
  select *, row_number() over (partition by run order by iteration) - 1 as idx from ev)
select run, iteration, idx, (idx - 5) // 4 as seq from r where idx >= 5 and (idx - 5) % 4 = 0""")
def frame_select(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordered.row_index(tb.events(spark, sf), ["run"], "iteration")
    return ordered.frame_select(rows, 5, None, 4).select("run", "iteration", "idx", "seq")


@query(f"""with {tb.EVENTS}, r as (
  select *, row_number() over (partition by run order by iteration) as rn from ev)
select run, iteration, y from r where rn > 25 and (rn - 26) % 10 = 0""")
def skip_and_downsample(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordered.row_index(tb.events(spark, sf), ["run"], "iteration")
    return ordered.frame_select(rows, 25, None, 10).select("run", "iteration", "y")


@query(f"""with {tb.EVENTS} select run, iteration, ntile(7) over (partition by run order by iteration) - 1 as part from ev""")
def ntile_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.split_contiguous(tb.events(spark, sf), ["run"], "iteration", 7).select("run", "iteration", "part")


@query(f"""with {tb.EVENTS}
select run, iteration, (row_number() over (partition by run order by iteration) - 1) % 6 as rank from ev""")
def round_robin(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.round_robin(tb.events(spark, sf), ["run"], "iteration", 6).select("run", "iteration", "rank")


@query(f"""with {tb.EVENTS}, r as (
  select *, row_number() over (partition by run order by iteration) - 1 as i, count(*) over (partition by run) as n from ev)
select run, iteration, least(i // (n // 6), 5) as rank from r""")
def block_partition(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.split_blocks(tb.events(spark, sf), ["run"], "iteration", 6).select("run", "iteration", "rank")


@query(f"""with {tb.EVENTS}, f as (select run, arg_min(y, t) as y0 from ev group by run)
select ev.run, iteration, y / y0 as y_norm from ev join f on f.run = ev.run""")
def normalise_by_first(spark: SparkSession, sf: str) -> DataFrame:
    return series.normalise_by_first(tb.events(spark, sf), ["run"], "t", "y", "y_norm").select("run", "iteration", "y_norm")


@query(f"""with {tb.EVENTS}, x as (
  select *, t / 86400 as td, pow(y / 100, 2) as fl from ev),
 l as (select *, lag(td) over w as pt, lag(fl) over w as pf from x window w as (partition by run order by t))
select run, iteration, round(sum(coalesce((td - pt) * (fl + pf) / 2, 0))
  over (partition by run order by t rows unbounded preceding), 6) as energy from l""")
def cumulative_energy(spark: SparkSession, sf: str) -> DataFrame:
    rows = tb.events(spark, sf).withColumns({"td": F.col("t") / 86400, "fl": F.pow(F.col("y") / 100, 2)})
    out = series.cumulative_integral(rows, ["run"], "td", "fl", "e")
    return out.select("run", "iteration", F.round("e", 6).alias("energy"))


@query("""with d as (
  select o_orderpriority as run, epoch_us(o_orderdate) // 86400000000 as day, avg(o_totalprice) as rho
  from orders group by all)
select d.run, d.day, round((d.rho - b.rho) / b.rho, 6) as rel
from d join d b on b.day = d.day and b.run = '1-URGENT'""")
def relative_to_baseline(spark: SparkSession, sf: str) -> DataFrame:
    days = (
        tb.read(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("run"), F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint").alias("day"))
        .agg(F.avg("o_totalprice").alias("rho"))
    )
    return series.relative_to(days, "run", "1-URGENT", ["day"], "rho").select("run", "day", F.round("rel", 6).alias("rel"))


@query(f"""with {tb.EVENTS}, a as (select run, iteration, t, y as re from ev),
 b as (select run, iteration, y / 2 + 1 as im from ev)
select a.run, a.iteration, sqrt(re * re + im * im) as def from a join b on a.run = b.run and a.iteration = b.iteration""")
def deformation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    ev = tb.events(spark, sf)
    re = ev.select("run", "iteration", F.col("y").alias("re"))
    im = ev.select("run", "iteration", (F.col("y") / 2 + 1).alias("im"))
    return re.join(im, ["run", "iteration"]).select("run", "iteration", deformation("re", "im").alias("def"))


@query("""select l_returnflag as run, l_orderkey as iteration, l_linenumber as part,
  round(l_extendedprice / 1000 - l_quantity - l_discount, 6) as residual,
  round((l_discount + '6.79368'::double) / pow('2.5592675'::double - l_tax, 2), 6) as spin from lineitem""")
def energy_residual_and_spin(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("run"), F.col("l_orderkey").alias("iteration"), F.col("l_linenumber").alias("part"),
        F.round(radial_kinetic(F.col("l_extendedprice") / 1000, "l_quantity", "l_discount"), 6).alias("residual"),
        F.round(dimensionless_spin("l_discount", "l_tax"), 6).alias("spin"),
    )


@query(f"""with {tb.EVENTS}, r as (select distinct run from ev), c as (
  select * from (values {", ".join(f"({i}, '{p!r}'::double)" for i, p in enumerate(cutoff_periods()))}) v(cutoff, period)),
 n as (select run, count(*) as n from ev group by run)
select r.run, cutoff, period, n from r cross join c join n on n.run = r.run""")
def run_cutoff_grid(spark: SparkSession, sf: str) -> DataFrame:
    runs = tb.events(spark, sf).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return run_cutoffs(runs).select("run", "cutoff", "period", "n")


@query(f"""with {tb.EVENTS}, i as (select distinct iteration from ev), v(seq, variable) as (
  values (0, 'rho_b'), (1, 'temp'), (2, 'alp'))
select variable, iteration, seq * (select count(*) from i) + row_number() over (partition by seq order by iteration) - 1 as task
from i cross join v""")
def task_grid(spark: SparkSession, sf: str) -> DataFrame:
    its = tb.events(spark, sf).select("iteration").distinct()
    return plan_task_grid(its, ["rho_b", "temp", "alp"]).select("variable", "iteration", "task")


WANTED = ["click", "view", "missing", "error", "absent"]
_WANTED_SQL = ", ".join(f"({i}, '{w}')" for i, w in enumerate(WANTED))


@query(f"""with {tb.EVENTS}, w(seq, variable) as (values {_WANTED_SQL}), n as (
  select run, count(*) as n from ev group by run)
select seq, variable, n is null as skipped, coalesce(n, 0) as n_iterations from w left join n on n.run = w.variable""")
def variables_semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    index = tb.events(spark, sf).withColumnRenamed("run", "variable")
    kept = requested_variables(index, WANTED).groupBy("seq", "variable").agg(
        F.lit(False).alias("skipped"), F.count(F.lit(1)).alias("n_iterations")
    )
    gone = skipped_variables(index, WANTED).select(
        "seq", "variable", F.lit(True).alias("skipped"), F.lit(0).cast("bigint").alias("n_iterations")
    )
    return kept.unionByName(gone)


def _puncture_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Six scalar files' worth of rows per restart; an iteration has several rows, and restarts repeat many of them."""
    li = tb.read(spark, sf, "lineitem")
    axes = F.array(*[F.struct(F.lit(b).alias("body"), F.lit(a).alias("axis"), F.lit(k).alias("f")) for b in (0, 1) for k, a in enumerate("xyz")])
    return li.select(
        F.col("l_returnflag").alias("run"), (F.col("l_linenumber") % 2).alias("restart"), F.col("l_orderkey").alias("iteration"),
        (F.col("l_orderkey") * 0.5).alias("time"), F.col("l_linenumber").alias("line"), F.explode(axes).alias("a"),
    ).select(
        "run", "restart", "iteration", "time", "line", "a.body", "a.axis",
        (((F.col("iteration") + F.col("a.f") * F.expr("line div 2") * 13) % 97) * (F.col("a.f") + 1) * F.when(F.col("a.body") == 0, 0.25).otherwise(-0.25)).alias("value"),
    )


_AXIS = "((l_orderkey + {0} * (l_linenumber // 2) * 13) % 97) * {1} * s"
TRACK_SQL = f"""tr as (select distinct l_returnflag as run, b as body, l_orderkey as iteration, l_orderkey * 0.5::double as time,
  {_AXIS.format(0, 1)} as x, {_AXIS.format(1, 2)} as y, {_AXIS.format(2, 3)} as z
  from lineitem cross join (values (0, 0.25::double), (1, -0.25::double)) v(b, s))"""


@query(f"with {TRACK_SQL} select * from tr")
def puncture_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return tracks.combine_axes(_puncture_samples(spark, sf))


@query(f"""with {TRACK_SQL},
 f as (select run, time, body, min({{'iteration': iteration, 'x': x, 'y': y, 'z': z}}) as p from tr group by run, time, body),
 g as (select run, time, any_value(p) filter (body = 0) as a, any_value(p) filter (body = 1) as b from f group by run, time)
select run, time, a.iteration as iteration, a.x as x0, b.x as x1, a.y as y0, b.y as y1, a.z as z0, b.z as z1 from g where a is not null and b is not null""")
def puncture_lookup(spark: SparkSession, sf: str) -> DataFrame:
    track = tracks.combine_axes(_puncture_samples(spark, sf))
    wanted = tb.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("run"), (F.col("l_orderkey") * 0.5).alias("time"))
    return tracks.lookup(track, wanted, by="time").select(
        "run", "time", F.col("body0.iteration").alias("iteration"),
        *[F.col(f"body{b}.{a}").alias(f"{a}{b}") for a in "xyz" for b in (0, 1)],
    )


@query("""select l_returnflag as run, epoch_us(l_shipdate) / 86400000000::double as time, l_extendedprice as thermal,
  l_tax as kin_total, null::double as kinetic_shi from lineitem where l_returnflag = 'N'
union all
select l_returnflag, epoch_us(l_shipdate) / 86400000000::double, l_extendedprice, l_tax, l_discount from lineitem
where l_returnflag <> 'N'""")
def heterogeneous_union(spark: SparkSession, sf: str) -> DataFrame:
    li = tb.read(spark, sf, "lineitem")
    cols = [
        F.col("l_returnflag").alias("run"), F.unix_date(F.col("l_shipdate").cast("date")).cast("double").alias("time"),
        F.col("l_extendedprice").alias("thermal"),
    ]
    short = li.filter("l_returnflag = 'N'").select(*cols, F.col("l_tax").alias("kin_total"))
    long = li.filter("l_returnflag <> 'N'").select(*cols, F.col("l_discount").alias("kinetic_shi"), F.col("l_tax").alias("kin_total"))
    return series.merge_volume_families(short, long)


@query("""select l_returnflag as run, round(quantile_cont(l_extendedprice, 0.01), 6) as p1, round(quantile_cont(l_extendedprice, 0.5), 6) as p50,
  round(quantile_cont(l_extendedprice, 0.99), 6) as p99, quantile_cont(l_quantity, 0.25) as q25 from lineitem group by 1""")
def run_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of many values in brackets that narrow twice; quantities are mostly ties."""
    rows = tb.restarts(spark, sf)
    prices = selection.percentiles(rows, ["run"], "y", (0.01, 0.5, 0.99), "p", small=200, steps=16)
    counts = selection.percentiles(rows, ["run"], "q", (0.25,), "q", small=20, steps=16)
    return prices.join(counts, "run").select("run", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p1", "p50", "p99"))], F.col("q")[0].alias("q25"))

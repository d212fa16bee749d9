"""Phase, spectrum, noise and gravitational-wave operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.scalars import both_halves, characteristic_strain, dimensionless_spin, spectral_density
from gridloom.operators import gridjoin, spectral, splines
from gridloom.operators.ordered import Ordered, row_index
from gridloom.plans import waves
from gridloom.sources.scratch import settled
from proxies import tables as tb
from proxies.registry import query

PI = "pi()"
UNWRAP_SQL = f"""{tb.WAVES}, rw as (select *, atan(-im / re) as raw from wv),
 dr as (select *, case when raw < lag(raw) over (partition by run order by t) then 1 else 0 end as d from rw),
 ph as (select *, raw + {PI} * sum(d) over (partition by run order by t rows unbounded preceding) as phase from dr)"""


@query(f"with {UNWRAP_SQL} select run, iteration, round(phase, 6) as phase from ph")
def phase_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    return spectral.unwrap_phase(tb.waves(spark, sf), ["run"], "t", "re", "im").select(
        "run", "iteration", F.round("phase", 6).alias("phase")
    )


@query(f"""with {UNWRAP_SQL} select run, iteration, round(coalesce((lead(phase) over w - lag(phase) over w) / (2 * {PI})
  / (lead(t) over w - lag(t) over w), 0) * 1000, 6) as f_mhz from ph window w as (partition by run order by t)""")
def gw_frequency(spark: SparkSession, sf: str) -> DataFrame:
    ph = spectral.unwrap_phase(tb.waves(spark, sf), ["run"], "t", "re", "im")
    return spectral.instantaneous_frequency(ph, ["run"], "t", "phase").select(
        "run", "iteration", F.round(F.col("f_gw") * 1000, 6).alias("f_mhz")
    )


def _taper_sql(source: str, columns: str, alpha: float) -> str:
    """tp: mean-removed and tapered columns with idx, n, dt."""
    cols = columns.split()
    means = ", ".join(f"avg({c}) as m_{c}" for c in cols)
    w = f"""case when idx <= floor({alpha}::double * (n - 1) / 2) then 0.5::double * (1 + cos({PI} * (-1 + 2 * idx / {alpha}::double / (n - 1))))
        when idx < n - 1 - floor({alpha}::double * (n - 1) / 2) then 1
        else 0.5::double * (1 + cos({PI} * (-2 / {alpha}::double + 1 + 2 * idx / {alpha}::double / (n - 1)))) end"""
    tapered = ", ".join(f"({c} - m_{c}) * {w} as w_{c}" for c in cols)
    return f"""st as (select run, {means}, count(*) as n, (max(t) - min(t)) / (count(*) - 1) as dt from {source} group by run),
 tp as (select s.run, s.iteration, idx, n, dt, {tapered} from (
   select *, row_number() over (partition by run order by t) - 1 as idx from {source}) s join st on st.run = s.run)"""


@query(f"with {tb.EVENTS}, {_taper_sql('ev', 'y', 0.25)} select run, iteration, idx, n, round(w_y, 6) as y from tp")
def tukey_mean_removed(spark: SparkSession, sf: str) -> DataFrame:
    return spectral.prepare_series(tb.events(spark, sf), ["run"], "t", ["y"], 0.25).select(
        "run", "iteration", "idx", "n", F.round("y", 6).alias("y")
    )


def _dft_sql(columns: str) -> str:
    sums = ", ".join(
        f"sum(w_{c} * cos(2 * {PI} * ((k * idx) % ks.n) / ks.n)) as re_{c}, sum(w_{c} * sin(2 * {PI} * ((k * idx) % ks.n) / ks.n)) as im_{c}"
        for c in columns.split()
    )
    return f"""ks as (select run, n, dt, unnest(range(0, n // 2 + 1)) as k from (select distinct run, n, dt from tp)),
 ft as (select ks.run, ks.n, ks.dt, k, {sums} from ks join tp on tp.run = ks.run group by all)"""


@query(f"""with {tb.EVENTS}, {_taper_sql('ev', 'y', 0.25)}, {_dft_sql('y')}
select run, k, round(k / (n * dt) * 1000, 9) as f_mhz, round(sqrt(re_y * re_y + im_y * im_y) * dt / 1e6::double, 6) as amp from ft""")
def dft_amplitude(spark: SparkSession, sf: str) -> DataFrame:
    ready = spectral.prepare_series(tb.events(spark, sf), ["run"], "t", ["y"], 0.25)
    return spectral.amplitude_spectrum(ready, ["run"], "y").select(
        "run", "k", F.round(F.col("f") * 1000, 9).alias("f_mhz"), F.round(F.col("amp") / 1e6, 6).alias("amp")
    )


ASD_SQL = f"""{tb.WAVES}, {_taper_sql('wv', 're im', 0.2)}, {_dft_sql('re im')},
 sp as (select run, k, k / (n * dt) as f, sqrt((re_re * re_re + im_re * im_re + re_im * re_im + im_im * im_im) / 2) * dt as amp from ft)"""


@query(f"with {ASD_SQL} select run, k, round(amp / 1e6::double, 6) as amp from sp")
def asd_polarisation_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _asd(spark, sf).select("run", "k", F.round(F.col("amp") / 1e6, 6).alias("amp"))


def _asd(spark: SparkSession, sf: str) -> DataFrame:
    return spectral.polarised_spectrum(tb.waves(spark, sf), ["run"], "t", "re", "im", 0.2)


@query(f"""with {ASD_SQL}, v as (select *, 2 * amp * sqrt(f) as h from sp)
select run, round(arg_max(f, h) * 1000, 9) as f_peak_mhz, round(max(h) / 1e4::double, 6) as peak from v group by run""")
def spectral_peak(spark: SparkSession, sf: str) -> DataFrame:
    peak = spectral.spectral_peak(_asd(spark, sf), ["run"], "f", spectral_density("amp", "f"))
    return peak.select("run", F.round(F.col("f_peak") * 1000, 9).alias("f_peak_mhz"), F.round(F.col("peak") / 1e4, 6).alias("peak"))


@query(f"""with {ASD_SQL}
select run, k, round(2 * amp * sqrt(f * ({tb.MILLIS_SQL} * 1000)) / ({tb.MILLIS_SQL} * 1000) / 1e3::double, 6) as h_char from sp""")
def characteristic_strain_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    return _asd(spark, sf).select("run", "k", F.round(characteristic_strain("amp", "f", 1e3), 6).alias("h_char"))


MONTHS_SQL = """sp as (select o_orderpriority as run, (year(o_orderdate) - 1992) * 12 + month(o_orderdate) - 1 as i, avg(o_totalprice) as amp from orders group by all),
 nz as (select (year(l_shipdate) - 1992) * 12 + month(l_shipdate) - 1 as i, avg(l_extendedprice) as noise from lineitem group by all)"""


def _months(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    def month(c: str):
        return ((F.year(c) - 1992) * 12 + F.month(c) - 1).alias("i")

    spec = tb.read(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("run"), month("o_orderdate")).agg(F.avg("o_totalprice").alias("amp"))
    noise = tb.read(spark, sf, "lineitem").groupBy(month("l_shipdate")).agg(F.avg("l_extendedprice").alias("noise"))
    return spec.withColumn("f", F.col("i") + 1.0), noise


# Even or odd number of months: the weights are written out by position on both rules. Months count from the first of each series.
@query(f"""with {MONTHS_SQL}, s0 as (select run, row_number() over (partition by run order by i) - 1 as i, count(*) over (partition by run) as n, amp from sp),
 n0 as (select row_number() over (order by i) - 1 as i, noise from nz),
 j as (select run, s0.i, n, amp * amp / (s0.i + 1) / (noise * noise) as v from s0 join n0 on n0.i = s0.i),
 a as (select *, case when n % 2 = 1 then (case when i = 0 or i = n - 1 then 1 when i % 2 = 1 then 4 else 2 end) / 3::double
   else ((case when i > n - 2 then 0 when i = 0 or i = n - 2 then 1 when i % 2 = 1 then 4 else 2 end) / 3::double + (case when i >= n - 2 then 0.5 else 0 end)
       + (case when i < 1 then 0 when i = 1 or i = n - 1 then 1 when i % 2 = 0 then 4 else 2 end) / 3::double + (case when i <= 1 then 0.5 else 0 end)) / 2 end as w from j)
select run, round(sqrt(sum(v * w * 0.01::double)), 6) as snr from a group by run""")
def snr_simpson(spark: SparkSession, sf: str) -> DataFrame:
    spec, noise = _months(spark, sf)
    numbered = Ordered.of(spec.select("run", "i", "amp"), ["run"], "i").index("k").count("n").result().withColumn("f", F.col("k") + 1.0)
    curve = row_index(noise, [], "i", out="k").select("k", "noise")
    return spectral.signal_to_noise(numbered, curve, ["run"], "k", "f", "amp", "noise", F.col("n"), F.lit(0.01)).withColumn("snr", F.round("snr", 6))


# Elimination forwards and substitution backwards, one knot a step.
SPLINE_SQL = f"""{MONTHS_SQL},
 kn as (select run, i + 1.0::double as x, amp as y, row_number() over w - 1 as j, count(*) over (partition by run) as n from sp window w as (partition by run order by i)),
 hs as (select *, x - lag(x) over w as h0, lead(x) over w - x as h1, (lead(y) over w - y) / (lead(x) over w - x) - (y - lag(y) over w) / (x - lag(x) over w) as rise
   from kn window w as (partition by run order by j)),
 eq as (select run, j, n, h0, h1, 6 * rise as r, h0 - case when j = n - 2 then h1 * h1 / h0 else 0 end as a, h1 - case when j = 1 then h0 * h0 / h1 else 0 end as c,
   2 * (h0 + h1) + case when j = 1 then h0 * (1 + h0 / h1) else 0 end + case when j = n - 2 then h1 * (1 + h1 / h0) else 0 end as b from hs where j between 1 and n - 2),
 fw as (select run, j, c / b as cc, r / b as dd from eq where j = 1 union all
   select eq.run, eq.j, c / (b - a * cc), (r - a * dd) / (b - a * cc) from fw join eq on eq.run = fw.run and eq.j = fw.j + 1),
 bw as (select fw.run, fw.j, dd as m from fw join eq on eq.run = fw.run and eq.j = fw.j where fw.j = n - 2 union all
   select fw.run, fw.j, dd - cc * m from bw join fw on fw.run = bw.run and fw.j = bw.j - 1),
 ms as (select run, j, m from bw union all
   select e.run, 0, p.m + (p.m - q.m) * e.h0 / e.h1 from eq e join bw p on p.run = e.run and p.j = 1 join bw q on q.run = e.run and q.j = 2 where e.j = 1 union all
   select e.run, e.j + 1, p.m + (p.m - q.m) * e.h1 / e.h0 from eq e join bw p on p.run = e.run and p.j = e.j join bw q on q.run = e.run and q.j = e.j - 1 where e.j = e.n - 2),
 pc as (select * from (select kn.run, kn.j, n, x, y, m, lead(x) over w as x1, lead(y) over w as y1, lead(m) over w as m1
   from kn join ms on ms.run = kn.run and ms.j = kn.j window w as (partition by kn.run order by kn.j)) where x1 is not null)"""


def _spline_points_sql(step: str, total: int) -> str:
    return f"""gp as (select k, 37.0::double + k * {step}::double as gx from unnest(range({total})) t(k)),
 ev as (select run, k, gx as gx, y + (gx - x) * ((y1 - y) / (x1 - x) - (x1 - x) * (2 * m + m1) / 6 + (gx - x) * (m / 2 + (gx - x) * (m1 - m) / (6 * (x1 - x)))) as gy
   from pc join gp on (j = 0 or gx >= x) and (j = n - 2 or gx < x1))"""


def _untied(c: str) -> Column:
    """Rounded after a division by pi: means of prices lie on ties of decimal rounding."""
    return F.round(F.col(c) / (F.lit(1e4) * F.pi()), 7)


@query(f"with recursive {SPLINE_SQL}, {_spline_points_sql('0.01', 7900)} select run, k, gx as x, round(gy / (1e4::double * pi()), 7) as y from ev")
def spectrum_spline(spark: SparkSession, sf: str) -> DataFrame:
    spec, _ = _months(spark, sf)
    return splines.cubic_spline(spec, ["run"], "f", "amp", 37.0, 116.0, 0.01).withColumn("y", _untied("y"))


@query(f"with recursive {SPLINE_SQL}, {_spline_points_sql('0.25', 320)} select run, k, gx as x, round(gy / (1e4::double * pi()), 7) as y from ev")
def spectrum_spline_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same system in blocks of eight knots, merged three at a time on two levels."""
    spec, _ = _months(spark, sf)
    return splines.cubic_spline(spec, ["run"], "f", "amp", 37.0, 117.0, 0.25, block=8, fan=3).withColumn("y", _untied("y"))


# psi4 modes on an even grid: the wave as (2, 2) and a scaled, reversed copy as (3, 2).
MODES_SQL = f"""{tb.WAVES},
 md as (select run, 2 as l, 2 as m, rn, re, im from wv union all
        select run, 3, 2, rn, im / 2, re / 2 from wv),
 nn as (select run, count(*) as n from wv group by run)"""
CUTOFF = 40.0


def _modes(spark: SparkSession, sf: str) -> DataFrame:
    # The series is ordered once; its modes are read several times.
    w = settled(tb.waves(spark, sf).select("run", F.col("rn").cast("double").alias("t"), "re", "im"))
    made = {(2, 2): (F.col("re"), F.col("im")), (3, 2): (F.col("im") / 2, F.col("re") / 2)}
    each = F.array(*[
        F.struct(F.lit(l).alias("l"), F.lit(m).alias("m"), F.col("t").alias("t"), re.alias("re"), im.alias("im"))
        for (l, m), (re, im) in made.items()])
    return w.select("run", F.inline(each))


def _ffi_sql(order: int, modes: str = "md") -> str:
    """it: time integrals of the modes by a plain double sum, forward and back."""
    arg = "2 * pi() * ((k * {0}) % n) / n"
    w = f"greatest(abs(2 * pi() * kk / n), 2 * pi() / {CUTOFF}::double)"
    if order == 2:
        re, im = f"-xr / ({w} * {w})", f"-xi / ({w} * {w})"
    else:
        re, im = f"xi * sign(kk) / {w}", f"-xr * sign(kk) / {w}"
    c, s = f"cos({arg.format('rn')})", f"sin({arg.format('rn')})"
    ci, si = f"cos({arg.format('j')})", f"sin({arg.format('j')})"
    return f"""kn as (select run, n, unnest(range(n)) as k from nn),
 fx as (select a.run, l, m, n, k, sum(re * {c} + im * {s}) as xr, sum(im * {c} - re * {s}) as xi
        from {modes} a join kn on kn.run = a.run group by all),
 fk as (select *, case when 2 * k < n then k else k - n end as kk from fx),
 fy as (select run, l, m, n, k, {re} as yr, {im} as yi from fk),
 jn as (select run, unnest(range(n)) as j from nn),
 it as (select fy.run, l, m, j, sum((yr * {ci} - yi * {si}) / n) as re, sum((yi * {ci} + yr * {si}) / n) as im
        from fy join jn on jn.run = fy.run group by all)"""


@query(f"""with {MODES_SQL}, {_ffi_sql(2)}
select it.run, l, m, j::double as t, round(re * 500, 3) as re, round(im * 500, 3) as im from it
join nn on nn.run = it.run where j >= {CUTOFF} and j <= n - 1 - {CUTOFF}""")
def gw_strain(spark: SparkSession, sf: str) -> DataFrame:
    """All modes of one of two extraction radii."""
    modes = _modes(spark, sf)
    near = modes.withColumns({"radius": F.lit(300.0), "re": F.col("re") * 7})
    h = waves.strain(modes.withColumn("radius", F.lit(500.0)).unionByName(near), 500.0, CUTOFF)
    return h.select("run", "l", "m", F.round("t", 6).alias("t"), F.round("re", 3).alias("re"), F.round("im", 3).alias("im"))


def _second_integral_sql() -> str:
    """it2: the double integral, from the transform that `_ffi_sql` made."""
    first = _ffi_sql(2)
    return first[first.index(" fy as"):].replace("fy", "fy2").replace("it as", "it2 as").replace("jn", "jn2")


@query(f"""with {MODES_SQL}, {_ffi_sql(1)},{_second_integral_sql()},
 fl as (select a.run, a.j, sum(a.re * a.re + a.im * a.im) as e, sum(a.m * (b.im * a.re - b.re * a.im)) as jz,
     sum(a.re * (2.0::double * a.m / (a.l * (a.l + 1)) * a.re + sqrt(5.0::double / 7) / 3 * o.re) + a.im * (2.0::double * a.m / (a.l * (a.l + 1)) * a.im + sqrt(5.0::double / 7) / 3 * o.im)) as pz
   from it a join it2 b on b.run = a.run and b.l = a.l and b.j = a.j join it o on o.run = a.run and o.l = 5 - a.l and o.j = a.j group by all),
 lg as (select *, lag(e) over w as pe, lag(jz) over w as pj, lag(pz) over w as pp from fl window w as (partition by run order by j))
select run, j::double as t, round(sum(coalesce((e + pe) / 2, 0)) over w * 0.25 / (16 * pi()) / 1e3::double, 6) as energy,
  round(sum(coalesce((jz + pj) / 2, 0)) over w * 0.25 / (16 * pi()) / 1e5::double, 6) as j_z, round(sum(coalesce((pz + pp) / 2, 0)) over w * 0.25 / (16 * pi()) / 1e3::double, 6) as p_z
from lg window w as (partition by run order by j rows unbounded preceding)""")
def gw_radiated_energy(spark: SparkSession, sf: str) -> DataFrame:
    out = waves.radiated(_modes(spark, sf), 0.5, CUTOFF)
    scaled = {"energy": 1e3, "j_z": 1e5, "p_z": 1e3}
    return out.select("run", F.round("t", 6).alias("t"), *[F.round(F.col(c) / s, 6).alias(c) for c, s in scaled.items()])


@query(f"""with {tb.WAVES}, m as (select run, max(rn) as last from wv group by run)
select wv.run, wv.iteration, round(({'6.79368'} + im / 1e3::double) / pow('2.5592675'::double - abs(re) / 1e6::double, 2), 6) as spin,
  round(2 * re / 1e3::double, 6) as both_halves, rn < last as later from wv join m on m.run = wv.run""")
def gw_spin_join(spark: SparkSession, sf: str) -> DataFrame:
    """Energy and angular momentum of a run, sampled a hair apart, meet on their common grid; so does a coarser flag."""
    w = tb.waves(spark, sf)
    energy = w.select("run", "iteration", F.col("rn").cast("double").alias("t"), (F.abs("re") / 1e6).alias("energy"), both_halves(F.col("re") / 1e3).alias("both_halves"))
    momentum = w.select("run", (F.col("rn") + F.when(F.col("rn") % 2 == 0, 1e-9).otherwise(-1e-9)).alias("t"), (F.col("im") / 1e3).alias("j_z"))
    ahead = w.select("run", (F.col("rn") - 1.0).alias("t"), F.lit(True).alias("ahead"))
    both = gridjoin.join_on_grid(energy, momentum, ["run"], "t", tolerance=1e-6)
    both = gridjoin.join_on_grid(both, ahead, ["run"], "t", tolerance=1e-6, missing="null")
    return both.select(
        "run", "iteration", F.round(dimensionless_spin("j_z", "energy"), 6).alias("spin"), F.round("both_halves", 6).alias("both_halves"),
        F.col("ahead").isNotNull().alias("later"))


_Y = {(l, m): waves.spin_harmonic(l, m, 0.7, 0.3) for l, m in ((2, 2), (3, 2))}


@query(f"""with {MODES_SQL}, y(l, m, yr, yi) as (values {", ".join(f"({l}, {m}, '{v.real!r}'::double, '{v.imag!r}'::double)" for (l, m), v in _Y.items())})
select run, rn::double as t, round(sum(re * yr - im * yi), 6) as re, round(sum(re * yi + im * yr), 6) as im
from md join y on y.l = md.l and y.m = md.m group by all""")
def gw_total_strain(spark: SparkSession, sf: str) -> DataFrame:
    out = waves.total_strain(_modes(spark, sf), 0.7, 0.3)
    return out.select("run", "t", F.round("re", 6).alias("re"), F.round("im", 6).alias("im"))


# The chain on short modes made of monthly averages under a bell: four cutoffs, three noise curves.
_PERIODS, _BEFORE, _BAND = (6.0, 8.0, 10.0, 12.0), 20, (5000.0, 90000.0, 1000.0)
_Z = {(l, m): waves.spin_harmonic(l, m, 0.7, 0.3) for l, m in ((2, 2), (3, 2))}
_HERTZ = f"({tb.MILLIS_SQL} * 1000)"
_W = "greatest(abs(2 * pi() * kk / n), 2 * pi() / p)"
CHAIN_SQL = f"""{MONTHS_SQL},
 m0 as (select run, row_number() over (partition by run order by i) - 1 as rn, amp / 1e5::double as y from sp),
 mo as (select run, rn, y * exp(-(rn - 40) * (rn - 40) / 400::double) as y from m0),
 md as (select run, 2 as l, 2 as m, rn, y * cos('{tb.WAVE}'::double * rn) as re, -y * sin('{tb.WAVE}'::double * rn) as im from mo union all
   select run, 3, 2, rn, -y * sin('{tb.WAVE}'::double * rn) / 2, y * cos('{tb.WAVE}'::double * rn) / 2 from mo),
 nn as (select run, count(*) as n from mo group by run),
 {_ffi_sql(2)[:_ffi_sql(2).index(" fy as")].replace("kn", "kf").strip()}
 ct as (select unnest([{", ".join(f"{p}::double" for p in _PERIODS)}]) as p),
 fy as (select fk.*, p, -xr / ({_W} * {_W}) as yr, -xi / ({_W} * {_W}) as yi from fk cross join ct),
 it as (select fy.run, l, m, p, jn.rn, 500 * sum((yr * cos(2 * pi() * ((k * jn.rn) % n) / n) - yi * sin(2 * pi() * ((k * jn.rn) % n) / n)) / n) as re,
     500 * sum((yi * cos(2 * pi() * ((k * jn.rn) % n) / n) + yr * sin(2 * pi() * ((k * jn.rn) % n) / n)) / n) as im
   from fy join mo jn on jn.run = fy.run where jn.rn >= p and jn.rn <= n - 1 - p group by all),
 yl(l, yr, yi) as (values {", ".join(f"({l}, '{v.real!r}'::double, '{v.imag!r}'::double)" for (l, m), v in _Z.items())}),
 tot as (select run || '/' || p as run, p, rn, sqrt(pow(sum(re * yr - im * yi), 2) + pow(sum(re * yi + im * yr), 2)) as amp,
     max(case when it.l = 2 then re end) as re, max(case when it.l = 2 then im end) as im from it join yl on yl.l = it.l group by it.run, p, rn),
 tx as (select *, row_number() over (partition by run order by rn) - 1 as ix from tot),
 mg as (select run, p, arg_max(rn, (round(amp, 15), rn)) as tm, arg_max(ix, (round(amp, 15), rn)) as im, max(rn) as te from tx group by run, p),
 cm as (select p, min(te - tm) as common from mg group by p),
 wv as (select tx.run, tx.rn as iteration, tx.rn::double as t, tx.re, tx.im from tx join mg on mg.run = tx.run join cm on cm.p = tx.p
   where ix >= greatest(mg.im - {_BEFORE}, 0) and rn < tm + common),
 {_taper_sql('wv', 're im', 0.25)}, {_dft_sql('re im')},
 hc as (select run, k / (n * dt) * {_HERTZ} as x, 2 * sqrt((re_re * re_re + im_re * im_re + re_im * re_im + im_im * im_im) / 2) * dt * sqrt(k / (n * dt) * {_HERTZ}) / {_HERTZ} * 1e3 as y from ft),
 nd as (select d.run, i * 1200.0::double as x, noise * d.a + i * d.b as y from nz cross join (values ('~a', 1e-5::double, 0::double), ('~b', 2e-5::double, 0::double), ('~c', 1e-5::double, 1e-2::double)) d(run, a, b)),
 kn as (select *, row_number() over w - 1 as j, count(*) over (partition by run) as n from (select * from hc union all select * from nd) window w as (partition by run order by x)),
 {SPLINE_SQL[SPLINE_SQL.index("hs as"):]},
 gp as (select k, {_BAND[0]}::double + k * {_BAND[2]}::double as gx from unnest(range(85)) t(k)),
 ev as (select run, k, gx, y + (gx - x) * ((y1 - y) / (x1 - x) - (x1 - x) * (2 * m + m1) / 6 + (gx - x) * (m / 2 + (gx - x) * (m1 - m) / (6 * (x1 - x)))) as gy
   from pc join gp on (j = 0 or gx >= x) and (j = n - 2 or gx < x1)),
 sn as (select s.run, o.run as detector, sum(s.gy * s.gy / s.gx / (o.gy * o.gy) * {_BAND[2]} * (case when s.k = 0 or s.k = 84 then 1 when s.k % 2 = 1 then 4 else 2 end) / 3::double) as sq
   from ev s join ev o on o.k = s.k and o.run like '~%' where s.run not like '~%' group by all)"""


@query(f"with recursive {CHAIN_SQL} select split_part(run, '/', 1) as run, split_part(run, '/', 2)::double as cutoff, detector, round(sqrt(sq), 4) as snr from sn")
def gw_chain_snr(spark: SparkSession, sf: str) -> DataFrame:
    spec, noise = _months(spark, sf)
    rows = Ordered.of(spec.select("run", "i", "amp"), ["run"], "i").index("rn").result()
    angle, y = F.lit(tb.WAVE) * F.col("rn"), F.col("amp") / 1e5 * F.exp(-(F.col("rn") - 40) * (F.col("rn") - 40) / 400)
    wave = rows.select("run", F.col("rn").cast("double").alias("t"), (y * F.cos(angle)).alias("a"), (-y * F.sin(angle)).alias("b"))
    modes = wave.select("run", F.lit(2).alias("l"), F.lit(2).alias("m"), "t", F.col("a").alias("re"), F.col("b").alias("im")).unionByName(
        wave.select("run", F.lit(3).alias("l"), F.lit(2).alias("m"), "t", (F.col("b") / 2).alias("re"), (F.col("a") / 2).alias("im")))
    curves = [noise.select(F.lit(d).alias("detector"), (F.col("i") * 1200.0).alias("f"), (F.col("noise") * a + F.col("i") * b).alias("amp"))
              for d, a, b in (("~a", 1e-5, 0.0), ("~b", 2e-5, 0.0), ("~c", 1e-5, 1e-2))]
    out = waves.snr_chain(
        modes, 500.0, curves[0].unionByName(curves[1]).unionByName(curves[2]), cutoffs=_PERIODS, before=_BEFORE, theta=0.7, phi=0.3, distance=1e-3, band=_BAND)
    return out["snr"].select("run", "cutoff", "detector", F.round("snr", 4).alias("snr"))

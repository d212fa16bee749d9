"""Name, tag and path parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import names
from proxies import tables as tb
from proxies.registry import query

# Tag with variable digit counts and an optional fraction; every seventh name has no tag.
TAG_SQL = """case when p_partkey % 7 = 3 then 'volume'
  else (case p_size % 3 when 0 then 'xy' when 1 then 'xz' else 'yz' end) || '_' ||
       (case p_partkey % 3 when 0 then 'x' when 1 then 'y' else 'z' end) || '_' ||
       (case when p_partkey % 2 = 0 then 'pos' else 'neg' end) || lpad(p_size::varchar, 4, '0') ||
       (case when p_partkey % 5 = 0 then '' else 'p' || lpad((p_partkey % 1000)::varchar, 3, '0') end) end"""
NAMES_SQL = f"""nm as (select p_partkey as id, {TAG_SQL} as tag0,
  case when p_partkey % 4 = 0 then 'bvec_cv' when p_partkey % 4 = 1 then 'rho' when p_partkey % 4 = 2 then 'press_vc' else 'eps' end as grp,
  lpad((p_partkey % 3)::varchar, 2, '0') as pt, lpad((p_size % 10)::varchar, 2, '0') as lv,
  case p_partkey % 3 when 0 then 'scalar' when 1 then 'vx' else 'VALUE' end as component
  from part),
 mn as (select *, case when id % 11 = 5 then tag0 || '_hydrobasex_' || grp
     when id % 2 = 0 then tag0 || '_hydrobasex_' || grp || '_patch' || pt || '_lev' || lv
     else tag0 || '_hydrobasex_' || grp || '_lev' || lv || '_patch' || pt end as mesh_name from nm)"""


def mesh_names(spark: SparkSession, sf: str) -> DataFrame:
    part = tb.read(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    tag = F.when(key % 7 == 3, F.lit("volume")).otherwise(
        F.concat(
            F.when(size % 3 == 0, "xy").when(size % 3 == 1, "xz").otherwise("yz"), F.lit("_"),
            F.when(key % 3 == 0, "x").when(key % 3 == 1, "y").otherwise("z"), F.lit("_"),
            F.when(key % 2 == 0, "pos").otherwise("neg"), names.zero_padded(size, 4),
            F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("p"), names.zero_padded(key % 1000, 3))),
        )
    )
    group = F.when(key % 4 == 0, "bvec_cv").when(key % 4 == 1, "rho").when(key % 4 == 2, "press_vc").otherwise("eps")
    body = F.concat(tag, F.lit("_hydrobasex_"), group)
    patch, lev = names.zero_padded(key % 3, 2), names.zero_padded(size % 10, 2)
    name = (
        F.when(key % 11 == 5, body)
        .when(key % 2 == 0, F.concat(body, F.lit("_patch"), patch, F.lit("_lev"), lev))
        .otherwise(F.concat(body, F.lit("_lev"), lev, F.lit("_patch"), patch))
    )
    component = F.when(key % 3 == 0, "scalar").when(key % 3 == 1, "vx").otherwise("VALUE")
    return part.select(key.alias("id"), tag.alias("tag0"), name.alias("mesh_name"), component.alias("component"))


RX = r"'(xy|xz|yz)_([xyz])_(pos|neg)(\d{1,8})(?:p(\d{0,8}))?'"
ELEVATION_SQL = f"""(case when regexp_extract(s, {RX}, 3) = 'neg' then -1 else 1 end) *
  (try_cast(regexp_extract(s, {RX}, 4) as double) +
   coalesce(try_cast(nullif(regexp_extract(s, {RX}, 5), '') as double) / pow(10, length(regexp_extract(s, {RX}, 5))), 0))"""


@query(f"""with {NAMES_SQL}, s as (select id, tag0 as s from nm)
select id, regexp_extract(s, {RX}) as tag, regexp_extract(s, {RX}, 1) as plane,
  regexp_extract(s, {RX}, 2) as normal_axis, regexp_extract(s, {RX}, 3) as sign,
  round({ELEVATION_SQL}, 9) as elevation, 9::bigint as first, 9 + length(regexp_extract(s, {RX})) as last
from s where regexp_matches(s, {RX})
union all
-- No tag in the basename: the one of the directory counts, at its place in the whole path.
select id, 'xy_z_pos9', 'xy', 'z', 'pos', 9::double, 9::bigint, 18::bigint from s where not regexp_matches(s, {RX})""")
def plane_tag_parse(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/data/xy_z_pos9/sim.x_"), F.col("tag0"))
    return (
        mesh_names(spark, sf).select("id", F.explode(F.array_compact(F.array(names.plane_tag(path)))).alias("t"), "tag0")
        .select(
            "id", "t.tag", "t.plane", "t.normal_axis", "t.sign", F.round("t.elevation", 9).alias("elevation"),
            (F.col("t.start") + 3).cast("bigint").alias("first"), (F.col("t.end") + 3).cast("bigint").alias("last"),
        )
    )


PARSED_SQL = f"""{NAMES_SQL}, ps as (select *,
   case when regexp_matches(mesh_name, '_patch\\d+_lev\\d+$') then regexp_extract(mesh_name, '^(.+)_patch0*(\\d+)_lev0*(\\d+)$', 1)
        else regexp_extract(mesh_name, '^(.+)_lev0*(\\d+)_patch0*(\\d+)$', 1) end as prefix,
   regexp_extract(mesh_name, '_lev(\\d+)', 1)::int as level, regexp_extract(mesh_name, '_patch(\\d+)', 1)::int as patch
   from mn where id % 11 <> 5),
 pt as (select *, case when tag0 = 'volume' then null else tag0 end as tag,
   case when tag0 = 'volume' then prefix else regexp_replace(substr(prefix, length(tag0) + 1), '^_', '') end as g0 from ps),
 pg as (select *, case when g0 like '%\\_cv' escape '\\' then 'cv' when g0 like '%\\_vc' escape '\\' then 'vc' end as centering,
   regexp_replace(g0, '_(cv|vc)$', '') as grp0 from pt)"""


@query(f"""with {PARSED_SQL} select id, grp0 as "group", centering, level, patch, tag from pg""")
def mesh_name_parse(spark: SparkSession, sf: str) -> DataFrame:
    return (
        names.with_mesh(mesh_names(spark, sf), out="m")
        .select("id", "m.group", "m.centering", "m.level", "m.patch", F.col("m.plane.tag").alias("tag"))
    )


@query(f"""with {PARSED_SQL} select id, component, case when component = 'vx' then component else grp0 end as label from pg""")
def component_label(spark: SparkSession, sf: str) -> DataFrame:
    return (
        names.with_mesh(mesh_names(spark, sf), out="m")
        .select("id", "component", names.component_label("component", "m.group").alias("label"))
    )


@query(f"""with {NAMES_SQL}, c as (select id, lower(mesh_name) as m, lower(component) as k from mn)
select id, contains(m, 'x_r') or contains(k, 'x_r') as by_group, contains(m, 'vx') or contains(k, 'vx') as by_component,
  contains(m, 'xz_y') or contains(k, 'xz_y') as by_tag from c""")
def variable_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = names.with_mesh(mesh_names(spark, sf), out="m", keep_unparsed=True)

    def match(pattern: str):
        return names.matches_variable(pattern, "mesh_name", "component", "m")

    return rows.select("id", match("X_R").alias("by_group"), match("vX").alias("by_component"), match("xz_y").alias("by_tag"))


def series_paths(spark: SparkSession, sf: str) -> DataFrame:
    return mesh_names(spark, sf).select(
        "id", F.concat(F.lit("/data/run7/sim."), F.col("tag0"), F.lit(".it"), names.zero_padded("id", 8), F.lit(".bp5")).alias("path")
    )


@query(f"""with {NAMES_SQL}, s as (select id, tag0 as s from nm where tag0 <> 'volume')
select id from s where regexp_extract(s, {RX}, 1) = 'xy' and abs({ELEVATION_SQL} - 12::double) <= 1e-8::double + 1e-5::double * 12::double""")
def plane_filter_isclose(spark: SparkSession, sf: str) -> DataFrame:
    return series_paths(spark, sf).filter(names.plane_matches("path", plane="xy", elevation=12.0)).select("id")


@query(r"""select page_id, trim(regexp_replace(url || '_', '[^0-9A-Za-z._-]+', '_', 'g'), '_') as token,
  regexp_replace(url, '[^0-9A-Za-z._-]+', '_', 'g') as safe,
  trim(regexp_replace(url, '[^0-9A-Za-z._-]+', '_', 'g'), '_') || '__run.part' || lpad((page_id % 10000)::varchar, 4, '0') || '.h5' as part_file,
  case when length(url) < 20 then url else substr(url, 1, 17) || '...' end as short
from pages""")
def safe_filename(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read(spark, sf, "pages").select(
        "page_id", names.file_token(F.concat("url", F.lit("_"))).alias("token"), names.safe_name("url").alias("safe"),
        names.part_file(names.variable_file("url", "run"), F.col("page_id") % 10000).alias("part_file"),
        names.truncated("url", 20).alias("short"),
    )


@query("""with p as (select doc_id, n_chars, case doc_id % 4 when 0 then 'bp5' when 1 then 'h5' when 2 then 'md.0' else 'bp5.dir' end as e from documents)
select doc_id, case when doc_id % 3 = 0 then 0 else n_chars end as iteration, (n_chars % 12)::int as level,
  e in ('bp5', 'h5') as is_series, e in ('bp5', 'h5') and doc_id % 3 <> 0 as is_iteration_series from p""")
def iteration_number(spark: SparkSession, sf: str) -> DataFrame:
    ext = F.element_at(F.array(*[F.lit(e) for e in ("bp5", "h5", "md.0", "bp5.dir")]), (F.col("doc_id") % 4).cast("int") + 1)
    mid = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit(".it"), names.zero_padded("n_chars", 8)))
    path = F.concat(F.lit("/d/sim_lev"), (F.col("n_chars") % 12).cast("string"), mid, F.lit("."), ext, F.lit("/"))
    return tb.read(spark, sf, "documents").select(
        "doc_id", names.iteration_number(path).alias("iteration"), names.level_in_name(path).alias("level"),
        names.is_series_name(path).alias("is_series"), names.is_iteration_series(path).alias("is_iteration_series"),
    )


@query(f"""with {tb.EVENTS} select iteration, '$\\rho;~t={{x}}$ ' || format('{{:.3f}}', t / {tb.MILLIS_SQL}) || ' ms it=' || iteration as title from ev""")
def frame_title(spark: SparkSession, sf: str) -> DataFrame:
    ev = tb.events(spark, sf)
    return ev.select(
        "iteration",
        names.title(r"$\rho;~t={x}$ {t:.3f} ms it={it}", t=F.col("t") / F.lit(tb.MILLIS), it="iteration").alias("title"),
    )


@query(f"""with {tb.EVENTS} select iteration, lpad(iteration::varchar, greatest(8, length(iteration::varchar))::int, ' ') || '|' || format('{{:,}}', iteration) || '|' || printf('%+.1f', t / 8) || '|'
  || rpad(printf('%.0f', y), greatest(10, length(printf('%.0f', y)))::int, '.') || '|' || printf('%06d', iteration) || '|' || printf('%x', iteration) || '|' || printf('%.1f%%', y * 100) as title from ev""")
def title_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Widths, fills, signs, grouping, bases and percentages; eighths of whole seconds make ties."""
    template = "{it:>8}|{it:,}|{t:+.1f}|{t_raw:.<10.0f}|{it:06d}|{it:x}|{t_raw:.1%}"
    return tb.events(spark, sf).select("iteration", names.title(template, t=F.col("t") / 8, t_raw="y", it="iteration", idx=F.lit(0)).alias("title"))

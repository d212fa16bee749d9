"""The given tables in the engine's shapes, and the same shapes as SQL.

time series   events       run = event_type, iteration = event_id, t = seconds since 2024
restarts      lineitem     run = l_returnflag, restart = l_linenumber, iteration = l_orderkey
2D slices     embeddings   8 x 8 values, run = label div 2, variable by label % 2
AMR chunks    embeddings   8 x 8 chunk, level = label % 3, patch = vec_id % 4
names, paths  part, documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.constants import MILLIS
from gridloom.operators.ordered import Ordered

EPOCH_US = 1704067200000000
WAVE = 0.7


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("iteration"),
        ((micros - EPOCH_US) / 1e6).alias("t"), F.col("value").alias("y"),
    )


EVENTS = f"""ev as (
    select event_type as run, event_id as iteration,
           (epoch_us(ts) - {EPOCH_US}) / 1e6::double as t, value as y
    from events)"""


def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complex series with a steadily turning phase; the events' values are its amplitude."""
    rows = Ordered.of(events(spark, sf_dir), ["run"], "t").index("rn").result()
    angle = F.lit(WAVE) * F.col("rn")
    return rows.withColumns({"re": F.col("y") * F.cos(angle), "im": -F.col("y") * F.sin(angle)})


WAVES = f"""{EVENTS},
  rn as (select *, row_number() over (partition by run order by t) - 1 as rn from ev),
  wv as (select *, y * cos('{WAVE}'::double * rn) as re, -y * sin('{WAVE}'::double * rn) as im from rn)"""


def restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("run"), F.col("l_linenumber").alias("restart"),
        F.col("l_orderkey").alias("iteration"), F.unix_date(F.col("l_shipdate").cast("date")).cast("double").alias("time"),
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"),
    )


RESTARTS = """rs as (
    select l_returnflag as run, l_linenumber as restart, l_orderkey as iteration,
           epoch_us(l_shipdate) / 86400000000::double as time,
           l_extendedprice as y, l_quantity as q, l_discount as d
    from lineitem)"""


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.expr("concat('run', label div 2)").alias("run"),
        F.expr("if(label % 2 = 0, 'rho', 'press')").alias("variable"),
        F.lit("xy").alias("plane"), F.col("vec_id").alias("iteration"),
        (F.col("vec_id") * 0.5).alias("time"), F.lit(8).alias("nx"), F.lit(8).alias("ny"),
        F.col("embedding").cast("array<double>").alias("data"),
    )


SLICES = """sl as (
    select 'run' || (label // 2) as run, case when label % 2 = 0 then 'rho' else 'press' end as variable,
           vec_id as iteration, vec_id * 0.5::double as time, embedding::double[] as data
    from embeddings)"""


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2D chunks in the schema of `gridloom.schema.AMR_CHUNK`."""
    return read(spark, sf_dir, "embeddings").selectExpr(
        "'sim' as series", "(vec_id div 8) % 5 as iteration", "vec_id * 0.25D as time",
        "format_string('xy_z_pos0000p000_hydrobasex_%s_patch%02d_lev%02d',"
        " if((vec_id div 4) % 2 = 0, 'rho', 'press'), vec_id % 4, label % 3) as mesh_name",
        "'scalar' as component",
        "0 as mesh_seq", "cast(vec_id as int) as chunk_id",
        "array(32L, 32L) as shape", "array((vec_id * 5) % 25, (vec_id * 3) % 25) as off", "array(8L, 8L) as ext",
        "array(4D * (label % 3), 3D * (label % 3)) as grid_offset",
        "array(1D / pow(2D, label % 3), 1D / pow(2D, label % 3)) as spacing",
        "if(label % 2 = 0, array(0.5D, 0.5D), array(0D, 0D)) as position",
        "cast(embedding as array<double>) as data",
    )


# One row per chunk with its clipped extents: y runs first. `o`, `p` are offset and position.
CHUNKS = """ch0 as (
    select vec_id as chunk_id, (vec_id // 8) % 5 as iteration,
           case when (vec_id // 4) % 2 = 0 then 'hydrobasex_rho' else 'hydrobasex_press' end as label,
           (label % 3)::bigint as level, vec_id % 4 as patch,
           (vec_id * 5) % 25 as oy, (vec_id * 3) % 25 as ox,
           1::double / pow(2, label % 3) as sp, case when label % 2 = 0 then 0.5 else 0 end::double as p,
           4::double * (label % 3) as gy, 3::double * (label % 3) as gx, embedding::double[] as data
    from embeddings),
  ch as (
    select *, case when p <> 0 then least(8, greatest(0, 31 - oy)) else 8 end as ny,
           case when p <> 0 then least(8, greatest(0, 31 - ox)) else 8 end as nx,
           gy + (oy + p) * sp as y0, gx + (ox + p) * sp as x0,
           ((level * 65536 + patch) * 65536 + 0) * 8388608 + chunk_id as prio
    from ch0)"""

MILLIS_SQL = f"'{MILLIS!r}'::double"

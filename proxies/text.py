"""Text tables: lines built from the given tables, parsed by the readers' column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources import ascii
from proxies import tables as tb
from proxies.registry import query

# Notes behind a row, rows without columns, and tabs between columns, by the part's number.
_NOTE = "case when l_partkey % 5 = 0 then '  # note 1 2' else '' end"
_LINE = """case when l_partkey % 11 = 0 then '   ' when l_partkey % 7 = 0 then '# column 1:it 9:time' else
  concat('  ', cast(l_orderkey as string), ' 0 0 0', char(9), '0 0 0 0   ', cast(l_linenumber * 0.5D as string), ' 0 0 0 ', cast(l_extendedprice as string), {note}) end"""


@query("""select l_returnflag as run, l_linenumber as restart, l_orderkey as iteration, l_linenumber * 0.5::double as time, l_extendedprice as value
from lineitem where l_partkey % 11 <> 0 and l_partkey % 7 <> 0""")
def ascii_scalar_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = tb.read(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("run"),
        F.expr("concat('file:/runs/', l_returnflag, '/output-', lpad(cast(l_linenumber as string), 4, '0'), '/data_asc_0D/mass..asc')").alias("path"),
        F.expr(_LINE.format(note=_NOTE)).alias("value"),
    )
    return ascii.rows_of(lines).select("run", ascii.restart_number("path").alias("restart"), *ascii.scalar_columns(F.col("cols")))


@query("""select l_returnflag as run, (l_linenumber % 2)::int as body, ['x', 'y', 'z'][(l_linenumber % 3)::int + 1] as axis, l_orderkey as iteration,
  l_linenumber * 0.5::double as time, l_extendedprice as value from lineitem where l_partkey % 11 <> 0 and l_partkey % 7 <> 0""")
def puncture_file_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Names with plain and with encoded brackets."""
    name = F.expr("format_string(if(l_partkey % 2 = 0, 'pt_loc_%s[%d]', 'pt_loc_%s%%5B%d%%5D'), substr('xyz', l_linenumber % 3 + 1, 1), l_linenumber % 2)")
    lines = tb.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("run"), name.alias("quantity"), F.expr(_LINE.format(note=_NOTE)).alias("value"))
    return ascii.rows_of(lines).select("run", *ascii.puncture_columns("quantity"), *ascii.scalar_columns(F.col("cols")))


@query("""select 'second' as curve, p_partkey * 0.25::double as f, p_retailprice as amp from part union all
select 'third', p_partkey * 0.25::double, p_size / 1e3::double from part""")
def noise_curve_parse(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat_ws(" ", (F.col("p_partkey") * 0.25).cast("string"), F.col("p_retailprice").cast("string"), F.lit("7e-24"), (F.col("p_size") / 1e3).cast("string"))
    rows = ascii.rows_of(tb.read(spark, sf, "part").select(line.alias("value")))
    curves = [rows.select(F.lit(c).alias("curve"), *ascii.noise_columns(F.col("cols"), k)) for c, k in (("second", 1), ("third", 3))]
    return curves[0].unionByName(curves[1])

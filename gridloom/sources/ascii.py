"""Whitespace-separated text tables: scalars, volume integrals, puncture tracks, noise curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.schema import VOLUME_COLUMNS_LONG, VOLUME_COLUMNS_SHORT
from gridloom.sources import restarts

# Fixed column positions of the 13-column scalar files.
ITERATION, TIME, VALUE = 0, 8, 12
RESTART = r"output-(\d{4})"


def bare(line: Column | str) -> Column:
    """A line without its comment (from `#` on) and outer white space; empty if it holds no row."""
    return F.trim(F.regexp_replace(_col(line), r"#.*$", ""), F.lit(" \t\r\n\f\v"))


def numbers(line: Column | str) -> Column:
    """ARRAY<DOUBLE> of a line's columns."""
    return F.split(bare(line), r"\s+").cast("array<double>")


def scalar_columns(cols: Column) -> list[Column]:
    """iteration, time, value of a 13-column row."""
    return [cols[ITERATION].cast("bigint").alias("iteration"), cols[TIME].alias("time"), cols[VALUE].alias("value")]


def puncture_columns(quantity: Column | str) -> list[Column]:
    """body and axis of a location file's name, `pt_loc_<axis>[<body>]`, also where the brackets are encoded."""
    name = F.regexp_replace(F.regexp_replace(_col(quantity), "(?i)%5B", "["), "(?i)%5D", "]")
    rule = r"pt_loc_([xyz])\[(\d+)\]"
    return [F.regexp_extract(name, rule, 2).try_cast("int").alias("body"), F.nullif(F.regexp_extract(name, rule, 1), F.lit("")).alias("axis")]


def noise_columns(cols: Column, amp_column: int = 1) -> list[Column]:
    """f and amp of a noise curve's row; the amplitude sits in column 1, or 3 for the third curve."""
    return [cols[0].alias("f"), cols[amp_column].alias("amp")]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rows_of(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that hold a row, with its columns as `cols`; other columns stay."""
    return lines.filter(bare(value) != "").withColumn("cols", numbers(value)).drop(value)


def read_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows (path, line, cols ARRAY<DOUBLE>); comments from `#` on and blank lines are dropped.

    `line` orders the rows of a file as they stand in it. A file with a single row is just that.
    """
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    text = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return rows_of(text.select(F.col("_metadata.file_path").alias("path"), line.alias("line"), "value")).select("path", "line", "cols")


def restart_number(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), RESTART, 1).try_cast("int")


def read_restarts(spark: SparkSession, run: str, run_dir: str, subdir: str, quantity: str | None = None) -> DataFrame:
    """(run, restart, quantity, path, line, cols) of all restarts' tables; filters on restart and quantity reach the listing."""
    restarts.register(spark)
    lines = spark.read.format(restarts.NAME).option("subdir", subdir).load(run_dir)
    if quantity is not None:
        lines = lines.filter(F.col("quantity") == quantity)
    return rows_of(lines).withColumn("run", F.lit(run))


def read_scalar(spark: SparkSession, run: str, run_dir: str, quantity: str, subdir: str = "data_asc_0D") -> DataFrame:
    """(run, restart, iteration, time, value) of a scalar over all restarts, in `schema.ASCII_0D`."""
    return read_restarts(spark, run, run_dir, subdir, quantity).select("run", "restart", *scalar_columns(F.col("cols")))


def read_volume(spark: SparkSession, run: str, paths: str | Sequence[str], long: bool) -> DataFrame:
    """Volume integrals of one run, 8 or 11 named columns, keyed by time."""
    columns = VOLUME_COLUMNS_LONG if long else VOLUME_COLUMNS_SHORT
    return read_table(spark, paths).select(
        F.lit(run).alias("run"), restart_number("path").alias("restart"),
        *[F.col("cols")[k].alias(name) for k, name in enumerate(columns)],
    )


def read_puncture(spark: SparkSession, run: str, run_dir: str, subdir: str = "Scalars") -> DataFrame:
    """(run, restart, body, axis, iteration, time, value, line) from the six location files of each restart."""
    table = read_restarts(spark, run, run_dir, subdir).filter(F.col("quantity").startswith("pt_loc_"))
    return table.select("run", "restart", *puncture_columns("quantity"), *scalar_columns(F.col("cols")), "line")


def read_noise(spark: SparkSession, path: str, amp_column: int = 1) -> DataFrame:
    """Detector noise curve (f, amp)."""
    return read_table(spark, path).select(*noise_columns(F.col("cols"), amp_column))


def write_profile(df: DataFrame, path: str) -> None:
    """Plain text columns, one row per line."""
    df.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def read_profile(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return read_table(spark, path).select(*[F.col("cols")[k].alias(c) for k, c in enumerate(columns)])

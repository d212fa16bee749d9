"""Results must not depend on which keys count as hot, nor on NULL keys, ties and empty runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import series
from gridloom.operators.asof import asof_forward
from gridloom.operators.ordered import Ordered, split_contiguous
from gridloom.plans import waves

SCHEMA = "run string, restart int, iteration bigint, t double, y double"


@pytest.fixture(scope="module")
def awkward(spark):
    """One run with most rows, a NULL run, NULL and repeated times, a run without amplitudes, repeated rows."""
    rng = np.random.default_rng(3)
    rows = []
    for run, n in (("big", 150), (None, 70), ("mid", 60), ("small", 6)):
        for k in range(n):
            t = None if k % 29 == 7 else float(k // 3)
            rows.append((run, int(rng.integers(0, 3)), None if k % 31 == 5 else k // 4, t, float(np.round(rng.normal(), 3))))
    rows += [("silent", 0, k, float(k), None) for k in range(50)] + rows[:9]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def prepared(df):
    """In a fixed order, values rounded."""
    pdf = df.toPandas()
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return pdf.map(lambda v: "-" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)).sort_values(list(sorted(pdf.columns))).to_numpy().tolist()


def ordered(df):
    return Ordered.of(df, ["run"], "t")


OPERATIONS = {
    "first_restart_wins": lambda df: series.first_restart_wins(df, ["run"], "iteration", "restart"),
    "neighbours": lambda df: ordered(df).neighbours(p="lag:y", n="lead:y", pt="lag:t").result(),
    "running_sum": lambda df: ordered(df).running_sum(F.col("y"), "s").result(),
    "index": lambda df: ordered(df).index().result(),
    "count": lambda df: ordered(df).count().result(),
    "merger": lambda df: series.merger(df, ["run"], "t", "y"),
    "align": lambda df: series.align(df, ["run"], "t", "y"),
    "split_contiguous": lambda df: split_contiguous(df, ["run"], "t", 4),
    "cumulative_integral": lambda df: series.cumulative_integral(df, ["run"], "t", "y", "c"),
    "remove_mean": lambda df: series.remove_mean(df, ["run"], ["y"]),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_hot_and_cold_agree(spark, awkward, name, request):
    cold = prepared(OPERATIONS[name](awkward))
    request.getfixturevalue("hot")
    assert prepared(OPERATIONS[name](awkward)) == cold


def test_nothing_is_lost(awkward):
    n = awkward.count()
    for name in ("neighbours", "running_sum", "index", "count", "split_contiguous", "cumulative_integral", "remove_mean"):
        assert OPERATIONS[name](awkward).count() == n, name
    assert OPERATIONS["count"](awkward).filter("n is null").count() == 0
    runs = {r.run: r for r in OPERATIONS["merger"](awkward).collect()}
    assert set(runs) == {"big", None, "mid", "small", "silent"} and runs["silent"].t_merge is None


def test_asof_does_not_depend_on_the_number_of_targets(spark, awkward):
    targets = awkward.select("run", (F.col("t") - 0.5).alias("at")).unionByName(
        spark.createDataFrame([("big", None), (None, 1.0), ("nobody", 2.0), ("big", 9e9)], "run string, at double"))
    for clamp in (False, True):
        few = asof_forward(targets, awkward, ["run"], "at", "t", ["y"], clamp=clamp)
        many = asof_forward(targets, awkward, ["run"], "at", "t", ["y"], clamp=clamp, few_targets=False)
        assert prepared(few) == prepared(many)
        assert few.filter("run is null or at is null").count() == 0 and few.filter("run = 'nobody'").count() == 1


def test_total_strain_counts_every_mode(spark):
    modes = spark.createDataFrame(pd.DataFrame({"run": "a", "l": [2, 8, 9, 11], "m": [2, 0, 1, -3], "t": 0.0, "re": 1.0, "im": 0.0}))
    want = sum(waves.spin_harmonic(l, m, 0.7, 0.3) for l, m in ((2, 2), (8, 0), (9, 1), (11, -3)))
    got = waves.total_strain(modes, 0.7, 0.3).first()
    np.testing.assert_allclose([got.re, got.im], [want.real, want.imag], rtol=1e-12)
    only = waves.spin_harmonic(2, 2, 0.7, 0.3)
    assert abs(waves.total_strain(modes, 0.7, 0.3, l_max=2).first().re - only.real) < 1e-12


@pytest.fixture()
def limit(spark):
    yield lambda rows: spark.conf.set("gridloom.hot.rows", str(rows))
    spark.conf.unset("gridloom.hot.rows")


def test_more_hot_keys_than_the_first_list(spark, limit):
    limit(8)
    keys, rows = 4_500, 20
    df = spark.range(keys * rows).select((F.col("id") % keys).alias("run"), F.expr(f"id div {keys}").cast("double").alias("t"), F.col("id").alias("y"))
    o = ordered(df)
    assert len(o.segments.edges) == keys
    sizes = o.df.groupBy("run", "_seg").count()
    assert sizes.agg(F.max("count")).first()[0] <= 16
    placed = o.index("i").running_sum(F.lit(1.0), "s").result()
    assert placed.filter("i <> t or s <> t + 1").count() == 0 and placed.count() == keys * rows


def test_second_level_of_edges(spark, limit, monkeypatch):
    from gridloom.operators import skew

    limit(10)
    monkeypatch.setattr(skew, "_PROBS", 8)
    df = spark.range(3000).select(F.when(F.col("id") % 30 == 0, F.col("id") % 4).otherwise(7).alias("run"), F.col("id").cast("double").alias("t"), F.lit(1.0).alias("y"))
    o = ordered(df)
    assert max(len(e) for _, e in o.segments.edges) > 8
    assert o.df.groupBy("run", "_seg").count().agg(F.max("count")).first()[0] < 100
    got = o.index("i").neighbours(p="lag:t").result().filter("run = 7").orderBy("t").collect()
    assert [r.i for r in got] == list(range(2900)) and all(b.p == a.t for a, b in zip(got, got[1:]))

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import ordered, series
from gridloom.operators.asof import asof_forward
from gridloom.operators.ordered import Ordered
from gridloom.operators.skew import Segments, attach


def skewed(spark, n=400, seed=0):
    """One run owns most rows; times bunch up."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "run": np.where(rng.random(n) < 0.7, "big", np.where(rng.random(n) < 0.5, "mid", "small")),
        "t": np.cumsum(rng.exponential(1.0, n) ** 3),
        "y": rng.normal(size=n),
    })
    pdf["iteration"] = np.arange(n)
    return pdf.sample(frac=1, random_state=1), None


@pytest.fixture(params=["plain", "hot"])
def mode(request, spark):
    if request.param == "hot":
        request.getfixturevalue("hot")
    return request.param


def frame(spark):
    pdf, _ = skewed(spark)
    return pdf.sort_values("t"), spark.createDataFrame(pdf).repartition(5)


def test_segments_split_hot_runs_only(spark, hot):
    pdf, df = frame(spark)
    seg = Segments.plan(df, ["run"], "t")
    assert {k[0] for k, _ in seg.edges} == {r for r, n in pdf.run.value_counts().items() if n > 40}
    tagged = seg.tag(df).groupBy("run", "_seg").count().toPandas()
    big = tagged[tagged.run == "big"]
    assert len(big) > 3 and big["count"].max() < 0.5 * big["count"].sum()
    # Segments follow the order: no overlap between neighbours.
    spans = seg.tag(df).groupBy("run", "_seg").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).toPandas()
    for _, g in spans.sort_values("_seg").groupby("run"):
        assert (g.hi.to_numpy()[:-1] <= g.lo.to_numpy()[1:]).all()


def test_index_neighbours_running_sum(spark, mode):
    pdf, df = frame(spark)
    o = Ordered.of(df, ["run"], "t").index("idx").neighbours(prev="lag:y", nxt="lead:y").running_sum(F.col("y"), "cum").count("n")
    got = o.result().toPandas().sort_values("t").reset_index(drop=True)
    g = pdf.groupby("run")
    want = pdf.assign(idx=g.cumcount(), prev=g.y.shift(1), nxt=g.y.shift(-1), cum=g.y.cumsum(), n=g.y.transform("size")).reset_index(drop=True)
    for c in ("idx", "n"):
        assert (got[c] == want[c]).all()
    for c in ("prev", "nxt", "cum"):
        np.testing.assert_allclose(got[c], want[c], atol=1e-12)


def test_stride_after_range(spark):
    df = spark.createDataFrame([("a", i) for i in (0, 2, 4, 6, 8, 10)], "run string, iteration bigint")
    got = ordered.iteration_select(df, ["run"], it_min=2, it_max=10, stride=2)
    assert sorted(r.iteration for r in got.collect()) == [2, 6, 10]
    same = ordered.iteration_select(df, ["run"], stride=1)
    assert same.count() == 6


@pytest.mark.parametrize("parts", [1, 3, 4, 7, 500])
def test_contiguous_parts_match_array_split(spark, mode, parts):
    pdf, df = frame(spark)
    got = ordered.split_contiguous(df, ["run"], "iteration", parts).toPandas()
    for run, g in pdf.groupby("run"):
        its = np.sort(g.iteration.to_numpy())
        want = {i: p for p, chunk in enumerate(np.array_split(its, parts)) for i in chunk}
        mine = got[got.run == run].set_index("iteration").part.to_dict()
        assert mine == want


@pytest.mark.parametrize("size", [3, 6, 1000])
def test_block_partition_gives_rest_to_last(spark, size):
    pdf, df = frame(spark)
    got = ordered.split_blocks(df, ["run"], "iteration", size).toPandas()
    for run, g in pdf.groupby("run"):
        its, block = np.sort(g.iteration.to_numpy()), len(g) // size
        mine = got[got.run == run].sort_values("iteration")["rank"].to_numpy()
        want = [min(i // block, size - 1) if block else size - 1 for i in range(len(its))]
        assert list(mine) == want


def test_frame_select_renumbers(spark):
    df = spark.range(20).withColumnRenamed("id", "idx")
    got = [(r.idx, r.seq) for r in ordered.frame_select(df, 3, 15, 4).orderBy("idx").collect()]
    assert got == [(3, 0), (7, 1), (11, 2)]


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("clamp", [True, False])
def test_asof_forward(spark, mode, few, clamp):
    pdf, df = frame(spark)
    rng = np.random.default_rng(3)
    targets = pd.DataFrame({"run": rng.choice(["big", "mid", "small"], 120), "target": rng.uniform(-5, pdf.t.max() * 1.1, 120)})
    exact = pdf.groupby("run").head(5)[["run", "t"]].rename(columns={"t": "target"})
    targets = pd.concat([targets, exact, targets.head(10)])
    got = asof_forward(
        spark.createDataFrame(targets), df, ["run"], "target", "t", ["iteration"], clamp=clamp, few_targets=few
    ).toPandas()
    assert len(got) == len(targets.drop_duplicates())
    for r in got.itertuples():
        own = pdf[pdf.run == r.run]
        later = own[own.t >= r.target]
        want = later.iloc[0] if len(later) else (own.iloc[-1] if clamp else None)
        if want is None:
            assert np.isnan(r.t) and np.isnan(r.iteration)
        else:
            assert r.t == want.t and r.iteration == want.iteration


def test_asof_hand_cases(spark):
    s = spark.createDataFrame([("a", float(t), i) for i, t in enumerate((0, 10, 20))], "run string, t double, iteration bigint")
    q = spark.createDataFrame([("a", float(t)) for t in (5, 20, 21)], "run string, target double")
    for few in (True, False):
        hit = {r.target: r.t for r in asof_forward(q, s, ["run"], "target", "t", ["iteration"], few_targets=few).collect()}
        assert hit == {5.0: 10.0, 20.0: 20.0, 21.0: None}
        hit = {r.target: r.t for r in asof_forward(q, s, ["run"], "target", "t", ["iteration"], few_targets=few, clamp=True).collect()}
        assert hit[21.0] == 20.0


def test_restart_dedup(spark, mode):
    rows = [("a", 0, 1), ("a", 0, 2), ("a", 1, 2), ("a", 1, 3), ("a", 1, 3)]
    # A hot key: one iteration repeated far more often than the hot limit.
    rows += [("b", r, 7) for r in (2, 3) for _ in range(60)]
    df = spark.createDataFrame(rows, "run string, restart int, iteration bigint").repartition(4)
    got = series.first_restart_wins(df, ["run"], "iteration", "restart").toPandas()
    assert sorted(got[got.run == "a"].iteration) == [1, 2, 3, 3]
    b = got[got.run == "b"]
    assert len(b) == 60 and set(b.restart) == {2}


def test_attach_keeps_every_row(spark, mode):
    pdf, df = frame(spark)
    means = df.groupBy("run").agg(F.avg("y").alias("m"), F.count(F.lit(1)).alias("_n"))
    for many in (False, True):
        got = attach(df, means, ["run"], many_keys=many).toPandas()
        assert len(got) == len(pdf)
        want = pdf.groupby("run").y.mean()
        np.testing.assert_allclose(got.m, got.run.map(want))


def test_hot_plan_has_no_whole_key_window(spark, hot):
    _, df = frame(spark)
    plan = ordered.row_index(df, ["run"], "t")._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    assert main and all("_seg" in line for line in main)


def test_hot_order_value_is_split_by_ties(spark, hot):
    """Most rows of the run share one time; the tie column orders and splits them."""
    rng = np.random.default_rng(4)
    n = 600
    pdf = pd.DataFrame({
        "run": "a", "t": np.where(rng.random(n) < 0.6, 5.0, rng.uniform(0, 10, n)), "k": rng.permutation(n), "y": rng.normal(size=n),
    })
    df = spark.createDataFrame(pdf).repartition(4)
    o = Ordered.of(df, ["run"], "t", ["k"])
    assert o.segments.tied
    sizes = o.df.groupBy("_seg").count().toPandas()["count"]
    assert sizes.max() < 0.3 * n
    got = o.index("idx").neighbours(prev="lag:y", nxt="lead:y").running_sum(F.col("y"), "cum").result().toPandas().sort_values(["t", "k"])
    want = pdf.sort_values(["t", "k"])
    assert list(got.idx) == list(range(n))
    np.testing.assert_allclose(got.prev, want.y.shift(1))
    np.testing.assert_allclose(got.nxt, want.y.shift(-1))
    np.testing.assert_allclose(got.cum, want.y.cumsum(), atol=1e-12)

"""Box algebra against points."""

import itertools
import random

import pytest

from gridloom.operators import boxes


def points(row, n):
    return set(itertools.product(*[range(row[f"lo_{a}"], row[f"hi_{a}"]) for a in range(n)]))


def made(spark, rows, n):
    return spark.createDataFrame(rows, ", ".join(["g string"] + [f"lo_{a} long, hi_{a} long" for a in range(n)]))


def check(spark, rows, n):
    df = made(spark, rows, n)
    whole = {}
    for r in df.collect():
        if all(r[f"lo_{a}"] is not None and r[f"hi_{a}"] is not None and r[f"lo_{a}"] < r[f"hi_{a}"] for a in range(n)):
            whole.setdefault(r.g, set()).update(points(r, n))
    parts = boxes.decompose(df, ["g"]).collect()
    for g, want in whole.items():
        own = [(points(r, n), r.written) for r in parts if r.g == g]
        frame = set(itertools.product(*[range(min(p[a] for p in want), max(p[a] for p in want) + 1) for a in range(n)]))
        # Disjoint, filling, and right about what is written.
        assert sum(len(p) for p, _ in own) == len(frame) and set().union(*(p for p, _ in own)) == frame
        assert set().union(set(), *(p for p, w in own if w)) == want
    assert {r.g for r in parts} == set(whole)
    sizes = {r.g: (r.written_points, r.box_points) for r in boxes.union_volume(df, ["g"]).collect()}
    assert {g: v[0] for g, v in sizes.items()} == {g: len(p) for g, p in whole.items()}


def random_boxes(n, many, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(many):
        lo = [rng.randrange(8) for _ in range(n)]
        # Some boxes are empty, some repeat.
        rows.append((rng.choice(["a", "b", None]), *[v for a in range(n) for v in (lo[a], lo[a] + rng.randrange(5))]))
    return rows + rows[:3]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_boxes_equal_points(spark, n):
    check(spark, random_boxes(n, 14, n) + [("c", *[0, 2] * n), ("d", *[0, None] * n)], n)


def test_hot_keys_give_the_same(spark, hot):
    spark.conf.set("gridloom.hot.rows", "3")
    check(spark, random_boxes(2, 14, 9), 2)


def test_frame_of_four_leaves_its_middle(spark):
    ring = [("r", 0, 1, 0, 5), ("r", 4, 5, 0, 5), ("r", 0, 5, 0, 1), ("r", 0, 5, 4, 5)]
    (blank,) = boxes.unwritten(made(spark, ring, 2), ["g"]).collect()
    assert tuple(blank) == ("r", 1, 4, 1, 4)
    (size,) = boxes.union_volume(made(spark, ring, 2), ["g"]).collect()
    assert (size.written_points, size.box_points) == (16, 25)


def test_empty_tables_huge_bounds_and_touching_boxes(spark):
    assert boxes.decompose(made(spark, [], 2), ["g"]).count() == 0
    big = 1 << 40
    (one,) = boxes.decompose(made(spark, [("x", 0, big, 0, 7), ("x", big, 2 * big, 0, 7)], 2), ["g"]).collect()
    assert tuple(one) == ("x", 0, 2 * big, 0, 7, True)
    with pytest.raises(ValueError, match="lo_0"):
        boxes.decompose(spark.createDataFrame([("x",)], "g string"), ["g"])

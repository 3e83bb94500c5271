import random

import pytest
from pyspark.sql import functions as F

from driftwood.operators import ordered


def kadane_loop(xs):
    h = m = 0
    out = []
    for x in xs:
        h = max(0, h + x)
        m = max(m, h)
        out.append((h, m))
    return out


def rls_loop(pairs, x0, y0):
    theta, w = 1.0, (0.0 if x0 == 0 else y0 / x0)
    out = []
    for x, y in pairs:
        theta = theta - (theta * theta * x * x) / (1 + x * x * theta)
        w = w - theta * x * (w * x - y)
        out.append((theta, w, w * x))
    return out


def ftl_loop(pairs, slopes, window=None):
    past, px, out = [], 0.0, []
    for x, y in pairs:
        past.append((px, y))
        use = past if window is None else past[-window:]
        losses = [sum(abs(a * p - q) for p, q in use) for a in slopes]
        best = min(range(len(slopes)), key=lambda i: (losses[i], i))
        out.append((best, slopes[best] * x))
        px = x
    return out


@pytest.mark.parametrize("nb", [1, 3, 7])
def test_kadane_global_matches_loop(spark, nb):
    rng = random.Random(nb)
    xs = [rng.randint(-1000, 99) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "seq long, x long")
    got = (ordered.running_max_subarray(df, "x", ["seq"], min_buckets=nb, rows_per_bucket=50)
           .orderBy("seq").collect())
    assert [(r.max_ending_here, r.max_subarray) for r in got] == kadane_loop(xs)
    fin = ordered.max_subarray(df, "x", ["seq"], min_buckets=nb, rows_per_bucket=50).collect()
    assert fin[0].max_subarray == kadane_loop(xs)[-1][1]


def test_kadane_all_negative_and_keyed(spark):
    rows = [(k, i, -5 - i) for k in (1, 2) for i in range(20)]
    rows += [(3, i, v) for i, v in enumerate([3, -1, 4, -10, 6, 1])]
    df = spark.createDataFrame(rows, "k long, seq long, x long")
    got = ordered.running_max_subarray(df, "x", ["seq"], ["k"], min_buckets=4).collect()
    for k in (1, 2, 3):
        xs = [r[2] for r in rows if r[0] == k]
        mine = sorted((r.seq, r.max_ending_here, r.max_subarray) for r in got if r.k == k)
        assert [(h, m) for _, h, m in mine] == kadane_loop(xs)
    fin = {r.k: r.max_subarray for r in
           ordered.max_subarray(df, "x", ["seq"], ["k"], min_buckets=4).collect()}
    assert fin == {1: 0, 2: 0, 3: 7}


def test_kadane_empty(spark):
    df = spark.createDataFrame([], "seq long, x long")
    assert ordered.running_max_subarray(df, "x", ["seq"]).count() == 0


@pytest.mark.parametrize("nb", [1, 5])
def test_rls_matches_recursion(spark, nb):
    rng = random.Random(3)
    pairs = [(float(i % 7), -10 + 10 * i + rng.uniform(-2.5, 2.5)) for i in range(200)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)],
                               "seq long, x double, y double")
    got = ordered.rls_weights(df, "x", "y", ["seq"], x0=1.0, y0=10.0, min_buckets=nb,
                              rows_per_bucket=30).orderBy("seq").collect()
    want = rls_loop(pairs, 1.0, 10.0)
    for r, (t, w, p) in zip(got, want):
        assert r.theta == pytest.approx(t, rel=1e-9)
        assert r.weight == pytest.approx(w, rel=1e-7, abs=1e-9)
        assert r.prediction == pytest.approx(p, rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("nb,window", [(1, None), (6, None), (1, 5), (6, 5), (9, 3)])
def test_ftl_matches_loop(spark, nb, window):
    rng = random.Random(11)
    pairs, y = [], 0.0
    for i in range(150):
        pairs.append((float(i % 13), y))
        y += 10 + rng.uniform(-2.5, 2.5)
    pairs = [(x, float(round(v))) for x, v in pairs]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)],
                               "seq long, x double, y double")
    got = ordered.follow_the_leader(df, "x", "y", ["seq"], window=window, min_buckets=nb,
                                    rows_per_bucket=10).orderBy("seq").collect()
    assert [(r.leader, r.prediction) for r in got] == ftl_loop(pairs, list(range(31)), window)


def test_zip_by_position(spark):
    a = spark.createDataFrame([(i * 3, f"a{i}") for i in range(25)], "s long, av string")
    b = spark.createDataFrame([(100 - i, f"b{i}") for i in range(20)], "t long, bv string")
    got = ordered.zip_by_position(a, b, ["s"], [F.col("t").desc()] and ["t"], min_buckets=4)
    rows = sorted((r.pos, r.av, r.bv) for r in got.collect())
    assert len(rows) == 20
    assert rows[0] == (0, "a0", "b19")


def test_take_first(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(50)], "seq long, v long")
    assert [r.v for r in ordered.take_first(df, 3, "seq").collect()] == [0, 1, 4]

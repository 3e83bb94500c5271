"""Plan-shape and skew checks for the two-level ordered scan."""

import random

from pyspark.sql import functions as F

from driftwood.operators import ordered
from driftwood.plans import scan


def _kadane(xs):
    h = m = 0
    out = []
    for x in xs:
        h = max(0, h + x)
        m = max(m, h)
        out.append(m)
    return out


def test_hot_key_is_split_across_buckets(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else rng.randint(2, 200)  # key 1 holds a third of the rows
        rows.append((key, i, rng.randint(-50, 40)))
    df = spark.createDataFrame(rows, "k long, seq long, x long")
    b, nb = scan.add_range_bucket(df, ["seq"], min_buckets=8, rows_per_bucket=100)
    hot_buckets = b.filter("k = 1").select(scan.BUCKET).distinct().count()
    assert nb >= 8 and hot_buckets >= nb - 1
    got = ordered.running_max_subarray(df, "x", ["seq"], ["k"], min_buckets=8, rows_per_bucket=100)
    hot = [r.max_subarray for r in got.filter("k = 1").orderBy("seq").collect()]
    assert hot == _kadane([x for k, _, x in rows if k == 1])


def test_global_scan_shuffles_rows_by_bucket_only(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 7 - 3).alias("x"))
    out = ordered.running_max_subarray(df, "x", ["seq"], min_buckets=4, rows_per_bucket=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_bucket" in plan
    # the row side is never gathered into a single partition; only the per-bucket summary is
    assert out.count() == 5000


def test_multi_column_order_with_ties_in_first_column(spark):
    rows = [(i // 100, i, (i * 7919) % 23 - 11) for i in range(2000)]  # first order column is hot
    df = spark.createDataFrame(rows, "t long, id long, x long")
    got = [r.max_subarray for r in ordered.running_max_subarray(df, "x", ["t", "id"], min_buckets=6,
                                                                rows_per_bucket=200)
           .orderBy("t", "id").collect()]
    assert got == _kadane([x for _, _, x in rows])


def test_partition_count_invariance(spark):
    rng = random.Random(9)
    rows = [(i % 5, i, rng.randint(-20, 20), float(rng.randint(0, 9))) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, seq long, x long, y double")
    outs = []
    for parts in (1, 8):
        d = df.repartition(parts)
        kad = ordered.running_max_subarray(d, "x", ["seq"], ["k"], min_buckets=4)
        ftl = ordered.follow_the_leader(d, F.col("x").cast("double"), "y", ["seq"], min_buckets=4)
        outs.append((sorted(tuple(r) for r in kad.select("seq", "max_subarray").collect()),
                     sorted(tuple(r) for r in ftl.select("seq", "leader").collect())))
    assert outs[0] == outs[1]


def test_nb_and_nominal_merge_equal_whole(spark):
    from driftwood.operators import bayes, observers

    rows = [(i, i % 2, {"a": float(i % 3), "b": float(i % 5 + 1)}) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, label int, tf map<string,double>")
    whole = bayes.nb_train(df, "tf")
    merged = bayes.nb_merge(bayes.nb_train(df.filter("id < 77"), "tf"),
                            bayes.nb_train(df.filter("id >= 77"), "tf"))
    key = lambda t: sorted(tuple(r) for r in t.collect())
    assert key(whole.feature_sums) == key(merged.feature_sums)
    assert key(whole.class_counts) == key(merged.class_counts)
    long = spark.createDataFrame([(0, i % 3, float(i % 4), 1.0) for i in range(120)],
                                 "feature int, label int, value double, weight double")
    a = observers.nominal_stats(long.filter("value < 2"))
    b = observers.nominal_stats(long.filter("value >= 2"))
    assert key(observers.merge_nominal_stats(a, b)) == key(observers.nominal_stats(long))


def test_chi_square_matches_spark_ml(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest

    from driftwood.operators import statistics

    rng = random.Random(4)
    rows = []
    for _ in range(400):
        lab = rng.randint(0, 2)
        v = min(3, max(0, lab + rng.randint(-1, 1)))
        rows.append((float(lab), float(v)))
    long = spark.createDataFrame([(0, v, int(lab)) for lab, v in rows], "feature int, value double, label int")
    mine = statistics.chi_square_test(long).first()
    vec = spark.createDataFrame([(lab, Vectors.dense([v])) for lab, v in rows], ["label", "features"])
    ml = ChiSquareTest.test(vec, "features", "label").first()
    assert abs(mine.statistic - ml.statistics[0]) < 1e-6
    assert mine.dof == ml.degreesOfFreedom[0]
    assert abs(mine.p_value - ml.pValues[0]) < 1e-6


def test_hot_key_ftl_and_rls(spark):
    from tests.test_ordered import ftl_loop, rls_loop

    rng = random.Random(8)
    rows = [(1 if i % 2 == 0 else 2 + i % 37, i, float(i % 11), float(rng.randint(0, 60)))
            for i in range(900)]
    df = spark.createDataFrame(rows, "k long, seq long, x double, y double")
    b, nb = scan.add_range_bucket(df, ["seq"], key_cols=["k"], min_buckets=6, rows_per_bucket=50)
    per_key = {r.k: r.nb for r in b.groupBy("k").agg(F.countDistinct(scan.BUCKET).alias("nb")).collect()}
    assert per_key[1] > 1 and all(v == 1 for k, v in per_key.items() if k != 1)
    for window in (None, 4):
        got = ordered.follow_the_leader(df, "x", "y", ["seq"], ["k"], window=window, min_buckets=6,
                                        rows_per_bucket=50)
        for key in (1, 3):
            mine = [(r.leader, r.prediction) for r in got.filter(F.col("k") == key).orderBy("seq").collect()]
            pairs = [(x, y) for k, _, x, y in rows if k == key]
            assert mine == ftl_loop(pairs, list(range(31)), window)
    rls = ordered.rls_weights(df, "x", "y", ["seq"], ["k"], min_buckets=6, rows_per_bucket=50)
    mine = [r.weight for r in rls.filter("k = 1").orderBy("seq").collect()]
    want = [w for _, w, _ in rls_loop([(x, y) for k, _, x, y in rows if k == 1], 1.0, 10.0)]
    assert all(abs(a - b) <= 1e-7 * max(1.0, abs(b)) for a, b in zip(mine, want))


def test_null_keys_give_one_row_each(spark):
    from driftwood.operators import ensemble, statistics

    rows = [(None if i % 4 == 0 else i % 3, i, i % 17 - 8, float(i % 5)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, seq long, x long, y double")
    for opts in ({}, {"min_buckets": 8, "rows_per_bucket": 50}):  # with and without hot keys
        got = ordered.running_max_subarray(df, "x", ["seq"], ["k"], **opts)
        assert got.count() == 1000
        nulls = [r.max_subarray for r in got.where("k is null").orderBy("seq").collect()]
        assert nulls == _kadane([x for k, _, x, _ in rows if k is None])
        assert ordered.rls_weights(df, "y", "x", ["seq"], ["k"], **opts).count() == 1000
        assert ordered.follow_the_leader(df, "y", "x", ["seq"], ["k"], **opts).count() == 1000
        assert ordered.zip_by_position(df, df.withColumnsRenamed({"seq": "s2", "x": "x2", "y": "y2"}), ["seq"], ["s2"],
                                       key_cols=["k"], **opts).count() == 1000
    assert ensemble.normalize_counts(df, "y", ["k"]).count() == 1000
    assert statistics.gaussian_tail(df, "y", ["k"]).count() == 1000


def test_many_buckets_plan_fast_and_small(spark):
    import time

    n = 10_000
    df = spark.range(40_000).select(F.col("id").alias("a"), (F.col("id") * 7 % 1000).alias("b"),
                                    F.timestamp_micros(F.col("id") * 1000).alias("t"))
    bounds = [(4 * i, 0) for i in range(1, n)]
    start = time.time()
    bucket = scan.search_bucket(F.struct(F.col("a").alias("k0"), F.lit(0).cast("bigint").alias("k1")), bounds,
                                "array<struct<k0:bigint,k1:bigint>>")
    out = df.select("a", bucket.alias("bucket"))
    plan = out._jdf.queryExecution().executedPlan()
    assert time.time() - start < 3 and "WholeStageCodegen" in plan.toString() or "*(1)" in plan.toString()
    assert out.where("bucket <> a div 4").count() == 0
    got, nb = scan.add_range_bucket(df, ["t", "a"], min_buckets=50)
    sizes = [r["count"] for r in got.groupBy(scan.BUCKET).count().collect()]
    assert nb == 50 and len(sizes) == 50 and max(sizes) < 4000
    assert got.groupBy(scan.BUCKET).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy(scan.BUCKET).count() == 50

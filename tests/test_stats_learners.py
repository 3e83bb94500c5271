import math
import random

import pytest
from pyspark.sql import functions as F

from driftwood.functions import stats as S
from driftwood.operators import bayes, ensemble, observers, splits, statistics
from driftwood.operators.examples import to_long


def test_normal_cdf_against_erf(spark):
    zs = [-4.0, -2.0, -1.0, -0.3, 0.0, 0.5, 1.0, 2.0, 3.5]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", S.normal_cdf("z").alias("p")).collect():
        assert r.p == pytest.approx(0.5 * (1 + math.erf(r.z / math.sqrt(2))), abs=2e-7)


def test_gaussian_stats_merge_equals_whole(spark):
    rng = random.Random(5)
    rows = [(i % 3, rng.gauss(10, 3), 1.0 if i % 7 else 0.0) for i in range(300)]
    rows.append((0, float("nan"), 1.0))
    df = spark.createDataFrame(rows, "label int, value double, weight double").withColumn("feature", F.lit(0))
    whole = {r.label: r for r in observers.gaussian_stats(df).collect()}
    a = observers.gaussian_stats(df.filter("value < 10 or isnan(value)"))
    b = observers.gaussian_stats(df.filter("value >= 10"))
    merged = {r.label: r for r in observers.merge_gaussian_stats(a, b).collect()}
    for c in range(3):
        vals = [v for (l, v, w) in rows if l == c and w > 0 and not math.isnan(v)]
        mean = sum(vals) / len(vals)
        m2 = sum((v - mean) ** 2 for v in vals)
        for got in (whole[c], merged[c]):
            assert got.n == len(vals)
            assert got.mean == pytest.approx(mean, rel=1e-9)
            assert got.m2 == pytest.approx(m2, rel=1e-7)


def test_info_gain_and_gini_golden(spark):
    post = spark.createDataFrame([(1, 0, 0, 8.0), (1, 0, 1, 2.0), (1, 1, 0, 1.0), (1, 1, 1, 9.0),
                                  (2, 0, 0, 10.0), (2, 0, 1, 11.0), (2, 1, 0, 0.0), (2, 1, 1, 0.0)],
                                 "cand int, branch int, label int, w double")
    ig = {r.cand: r.merit for r in splits.info_gain(post, ["cand"]).collect()}

    def ent(xs):
        s = sum(xs)
        return math.log2(s) - sum(x * math.log2(x) for x in xs if x > 0) / s

    assert ig[1] == pytest.approx(ent([9, 11]) - (10 * ent([8, 2]) + 10 * ent([1, 9])) / 20)
    assert ig[2] == float("-inf")  # only one branch holds weight
    g = {r.cand: r.merit for r in splits.gini_merit(post, ["cand"]).collect()}
    gini = lambda d: 1 - sum(x * x for x in d) / sum(d) ** 2
    assert g[1] == pytest.approx(1 - (0.5 * gini([8, 2]) + 0.5 * gini([1, 9])))


def test_nb_train_predict_matches_python(spark):
    docs = [(0, 0, {"a": 2.0, "b": 1.0}), (1, 0, {"a": 3.0}), (2, 1, {"c": 2.0, "b": 1.0}),
            (3, 1, {"c": 1.0})]
    df = spark.createDataFrame(docs, "id int, label int, tf map<string,double>")
    model = bayes.nb_train(df, "tf")
    pri, cond = bayes.nb_params(model)
    pri = {r.label: r.log_prior for r in pri.collect()}
    total, F_ = 10.0, 3.0
    assert pri[0] == pytest.approx(math.log(2 + 1) - math.log(total + 2))
    cnd = {(r.label, r.feature): r.log_cond for r in cond.collect()}
    assert cnd[(0, "a")] == pytest.approx(math.log(5 + 1) - math.log(6 + F_))
    test = spark.createDataFrame([(10, {"a": 1.0}), (11, {"c": 3.0, "zz": 5.0}), (12, {})],
                                 "id int, tf map<string,double>")
    got = {r.id: r.prediction for r in bayes.nb_predict(model, test, ["id"], "tf").collect()}
    assert got == {10: 0, 11: 1, 12: 0}


def test_majority_vote_and_poisson(spark):
    votes = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (2, 3), (2, 1)], "id int, vote int")
    got = {r.id: r.vote for r in ensemble.majority_vote(votes, ["id"]).collect()}
    assert got == {1: 2, 2: 1}
    df = spark.range(20000)
    w = ensemble.poisson_weights(df, 1.0, ["id"]).agg(F.avg("weight"), F.variance("weight")).first()
    assert abs(w[0] - 1.0) < 0.05 and abs(w[1] - 1.0) < 0.1
    big = ensemble.poisson_weights(df, 150.0, ["id"]).agg(F.avg("weight")).first()[0]
    assert abs(big - 150.0) < 1.0


def test_chi_square_and_anova(spark):
    rows = [(0, float(i % 2), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "feature int, value double, label int")
    chi = statistics.chi_square_test(df).first()
    assert chi.dof == 2 and chi.p_value > 0.5
    num = spark.createDataFrame([(0, float(c * 10 + (i % 5)), c) for c in range(3) for i in range(50)],
                                "feature int, value double, label int")
    an = statistics.anova_f_test(num).first()
    assert an.df_between == 2 and an.df_within == 147 and an.f_stat > 100 and an.p_value < 1e-10


def test_to_long(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 0)], "id int, a double, b double, y int")
    got = sorted((r.feature, r.value) for r in to_long(df, ["id"], ["a", "b"], "y").collect())
    assert got == [(0, 2.0), (1, 3.0)]


def test_gaussian_two_pass_is_stable(spark):
    base = 1e9
    rows = [(0, base + (i % 3) * 1e-3, 1.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "label int, value double, weight double").withColumn("feature", F.lit(0))
    vals = [v for _, v, _ in rows]
    mean = sum(vals) / len(vals)
    m2 = sum((v - mean) ** 2 for v in vals)
    got = observers.gaussian_stats(df, two_pass=True).first()
    assert got.m2 == pytest.approx(m2, rel=1e-3)


def test_f_pvalue_closed_form(spark):
    # df1 = 2: P(F > f) = (d2 / (d2 + 2 f)) ** (d2 / 2)
    rows = [(f, d2) for f in (0.3, 1.0, 2.5, 6.0) for d2 in (5, 40, 3000)]
    df = spark.createDataFrame(rows, "f double, d2 int")
    for r in df.select("f", "d2", S.f_test_pvalue("f", F.lit(2), "d2").alias("p")).collect():
        assert r.p == pytest.approx((r.d2 / (r.d2 + 2 * r.f)) ** (r.d2 / 2), rel=1e-8, abs=1e-12)


def test_tails_at_large_degrees_of_freedom(spark):
    import math

    from driftwood.functions import stats as S

    # chi-square with an even number of degrees is a Poisson tail; its mean has the tail 1/2 + 1/(3 sqrt(pi k))
    rows = [(float(k), k) for k in (2, 10, 1999, 2000, 2002, 100_000, 10**6, 10**9, 10**12)]
    for r in spark.createDataFrame(rows, "x double, k bigint").select("k", S.chi2_pvalue("x", "k").alias("p")).collect():
        if r.k >= 2000:
            assert math.isclose(r.p, 0.5 - 1 / (3 * math.sqrt(math.pi * r.k)), abs_tol=2e-5), r
        else:
            assert 0 < r.p < 1
    # a poisson sum in logarithms, on both sides of the switch
    for k, x in ((1998, 2100.0), (2400, 2300.0), (2400, 2550.0), (5000, 5200.0)):
        h = x / 2
        exact = math.fsum(math.exp(-h + i * math.log(h) - math.lgamma(i + 1)) for i in range(k // 2))
        got = spark.createDataFrame([(x, k)], "x double, k bigint").select(S.chi2_pvalue("x", "k")).first()[0]
        assert math.isclose(got, exact, rel_tol=2e-5), (k, x, got, exact)
    f = [(1.0, 2, 10**12, math.exp(-1)), (3.0, 2, 10**7, math.exp(-3)), (1.0, 10**6, 10**6, 0.5), (1.0, 5000, 5000, 0.5),
         (1.2, 50, 1900, None), (1.2, 50, 2100, None)]
    got = {(r.f, r.a, r.b): r.p for r in spark.createDataFrame([t[:3] for t in f], "f double, a bigint, b bigint").select(
        "f", "a", "b", S.f_test_pvalue("f", "a", "b").alias("p")).collect()}
    for x, a, b, want in f:
        if want is not None:
            assert math.isclose(got[(x, a, b)], want, rel_tol=1e-3), (x, a, b, got[(x, a, b)])
    assert math.isclose(got[(1.2, 50, 1900)], got[(1.2, 50, 2100)], rel_tol=2e-2)


def test_poisson_weights_on_large_keys(spark):
    from driftwood.operators import ensemble

    df = spark.createDataFrame([(9_000_000_000_000 + k, None if k % 9 == 0 else k) for k in range(3000)], "a long, b int")
    w = [r.weight for r in ensemble.poisson_weights(df, 1.0, ["a", "b"]).collect()]
    assert abs(sum(w) / len(w) - 1) < 0.08 and max(w) > 3


def test_naive_bayes_answers_every_document(spark):
    from driftwood.functions import vectors as vec
    from driftwood.operators import bayes

    rows = [(1, "a a b", 0), (2, "c c d", 1), (3, "", 0), (4, None, 1), (5, "zzz", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    tf = vec.word_counts(df, "doc_id", "text", "tf").join(df.select("doc_id", "label"), "doc_id")
    assert tf.count() == 5
    model = bayes.nb_train(tf, "tf")
    assert {r.label: r.n for r in model.class_counts.collect()} == {0: 2.0, 1: 3.0}
    got = {r.doc_id: r.prediction for r in bayes.nb_predict(model, tf.where("doc_id <> 5"), ["doc_id"], "tf").collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == 0 and got[2] == 1

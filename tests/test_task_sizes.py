import re

from pyspark.sql import functions as F

from driftwood.functions import vectors as vec
from driftwood.operators import bayes, ensemble, ordered
from driftwood.plans import parallelism
from driftwood.sources import arff


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_taken_apart_once_and_a_repeated_index_keeps_its_first(spark):
    spec = arff.ArffSpec("t", [*[arff.Attribute(f"a{i}") for i in range(30)], arff.Attribute("c", ["x", "y"])])
    dense = ",".join(str(i) for i in range(30)) + ",y"
    lines = spark.createDataFrame([(dense,), ("{0 5, 3 7, 30 y}",), ("{3 1, 3 2, z 9, 4}",), ("1,2",), ("{}",)], "value string")
    out = arff.arff_rows(lines, F.col("value"), spec)
    plan = _plan(out)
    assert plan.count("split(") <= 12  # thirty-one attributes split it as often before
    a, b, c, d, e = out.collect()
    assert list(a) == [float(i) for i in range(30)] + [1.0]
    assert (b.a0, b.a3, b.a4, b.label) == (5.0, 7.0, 0.0, 1.0) and (c.a3, c.a4, c.label) == (1.0, None, 0.0)
    assert (d.a0, d.a1, d.a2, d.label) == (1.0, 2.0, None, None) and set(e) == {0.0}
    assert sorted(map(tuple, lines.select(*arff.arff_row_columns(F.col("value"), spec)).collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_word_counts_get_partitions_by_the_bytes_of_the_input(spark, tmp_path, monkeypatch):
    texts = [(k % 40 if k % 9 else None, f"a b a w{k}" if k % 5 else None) for k in range(120)]
    spark.createDataFrame(texts, "id long, text string").write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    few = {(r.id, frozenset(r.tf.items())) for r in vec.word_counts(docs, "id", "text").collect()}
    monkeypatch.setattr(parallelism, "BYTES_PER_PARTITION", 200)
    n = -(-parallelism.input_bytes(docs) // 200)
    many = vec.word_counts(docs, "id", "text")
    assert n > 4 and many.rdd.getNumPartitions() == n
    assert {(r.id, frozenset(r.tf.items())) for r in many.collect()} == few and len(few) == 41


def test_rare_features_meet_their_parameters_in_partitions_by_size(spark, tmp_path, monkeypatch):
    rows = [(k, k % 2, {f"w{k % 17}": 2.0, f"v{k}": 1.0}) for k in range(60)]
    spark.createDataFrame(rows, "id long, label int, tf map<string,double>").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    model = bayes.nb_train(df, "tf")
    want = sorted(bayes.nb_predict(model, df, ["id"], "tf").collect())
    monkeypatch.setattr(bayes, "BROADCAST_FEATURES", 3)
    monkeypatch.setattr(bayes, "HOT_FEATURES", 5)
    monkeypatch.setattr(parallelism, "BYTES_PER_PARTITION", 300)
    n = -(-parallelism.input_bytes(df) // 300)
    got = bayes.nb_predict(model, df, ["id"], "tf")
    assert "RepartitionByExpression [feature#" in _plan(got) and f", {n}" in _plan(got)
    # both keys are joined on, so the rows stay as they were dealt
    assert re.search(r"Join LeftOuter, \(\(feature#\d+ = feature#\d+\) AND \(_salt#\w+ = _salt#\w+\)\)", _plan(got))
    assert sorted(got.collect()) == want


def test_keys_without_a_hot_one_carry_nothing(spark):
    rows = [(k % 7 if k % 7 else None, k, float(k % 5), float(3 * (k % 5) + k % 2)) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, seq long, x double, y double")
    whole = ordered.follow_the_leader(df, "x", "y", ["seq"], ["k"])
    cut = ordered.follow_the_leader(df, "x", "y", ["seq"], ["k"], rows_per_bucket=5, min_buckets=40)
    assert "Join" not in _plan(whole) and "Join" in _plan(cut)
    assert sorted(whole.drop("k").collect()) == sorted(cut.drop("k").collect())
    whole = ordered.rls_weights(df, "x", "y", ["seq"], ["k"])
    assert "Join" not in _plan(whole)


def test_poisson_weights_draw_one_uniform_a_row(spark):
    from driftwood.functions.stats import uniform_from_text

    df = spark.range(300)
    for lam in (1.0, 40.0):
        got = ensemble.poisson_weights(df, lam, ["id"], seed=3)
        assert _plan(got).count("md5(") == 1 and "lambda" not in _plan(got)
        table = ensemble.poisson_cdf_table(lam)
        u = {r.id: r.u for r in df.select("id", uniform_from_text("id", seed=3).alias("u")).collect()}
        assert {r.id: r.weight for r in got.collect()} == {k: sum(c < v for c in table) for k, v in u.items()}
    nulls = spark.createDataFrame([(None,), (0.5,), (float("nan"),)], "u double")
    assert [r.w for r in nulls.select(ensemble.poisson_weight(F.col("u"), 1.0).alias("w")).collect()] == [0, 1, len(ensemble.poisson_cdf_table(1.0))]

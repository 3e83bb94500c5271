import pytest
from pyspark.sql import functions as F

from driftwood.operators import linear
from driftwood.sources import arff


def test_linear_gradient_matches_numpy(spark):
    rows = [(1, [1.0, 2.0], 1.0), (2, [0.5, -1.0], 0.0), (3, [2.0, 0.0], 1.0)]
    df = spark.createDataFrame(rows, "id int, x array<double>, y double")
    w = [0.1, -0.2, 0.05]
    for loss in linear.LOSSES:
        got = {r["index"]: r["grad"] for r in linear.linear_gradient(df, "x", "y", w, loss).collect()}
        want = [0.0, 0.0, 0.0]
        for _, x, y in rows:
            xb = x + [1.0]
            d = sum(a * b for a, b in zip(w, xb))
            if loss == "squared":
                g = d - y
            elif loss == "hinge":
                l_ = -1.0 if y == 0 else 1.0
                g = -l_ if l_ * d < 1 else 0.0
            elif loss == "logistic":
                import math
                l_ = -1.0 if y <= 0 else 1.0
                g = -l_ * (1 - 1 / (1 + math.exp(-l_ * d)))
            else:
                g = y - (1.0 if d >= 0 else 0.0)
            for i in range(3):
                want[i] += -g * xb[i]
        for i in range(3):
            assert got[i] == pytest.approx(want[i]), loss


def test_linear_train_reduces_loss(spark):
    rows = [(i, [i / 10.0], 2.0 * i / 10.0 + 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, x array<double>, y double")
    w = linear.linear_train(df, "x", "y", 1, loss="squared", steps=200, learning_rate=0.5)
    assert w[0] == pytest.approx(2.0, abs=0.05) and w[1] == pytest.approx(1.0, abs=0.05)


def test_arff_header_and_rows(spark):
    spec = arff.parse_arff_header(["% c", "@relation elec", "@attribute day {1,2, 3}",
                                   "@attribute price numeric", "@attribute class {UP, DOWN}", "@data"])
    assert [a.name for a in spec.attributes] == ["day", "price", "class"]
    assert spec.attributes[0].domain == ["1", "2", "3"] and spec.label.domain == ["UP", "DOWN"]
    lines = spark.createDataFrame([("2,0.5,DOWN",), ("{0 3, 1 1.5, 2 UP}",), ("{1 2.0}",)], "value string")
    got = lines.select(*arff.arff_row_columns(F.col("value"), spec)).collect()
    assert [tuple(r) for r in got] == [(1.0, 0.5, 1.0), (2.0, 1.5, 0.0), (0.0, 2.0, 0.0)]


def test_example_and_text_formats(spark):
    lines = spark.createDataFrame([("1 0.5,0.25,1.0 2.0",), ("0.5,1.5",), ("0 1:0.5,7:2.0,1:9.0",)], "value string")
    dense = lines.limit(2).select(*arff.example_columns(F.col("value"))).collect()
    assert (dense[0].label, dense[0].features, dense[0].weight) == (1.0, [0.5, 0.25, 1.0], 2.0)
    assert (dense[1].label, dense[1].features, dense[1].weight) == (None, [0.5, 1.5], 1.0)
    sp = lines.filter(F.col("value").startswith("0 ")).select(
        *arff.example_columns(F.col("value"), "sparse")).first()
    assert sp.features == {0: 0.5, 6: 2.0}
    tf = spark.createDataFrame([("spark:2,stream:1,spark:5",)], "value string")
    assert tf.select(arff.text_feature_map(F.col("value")).alias("m")).first().m == {"spark": 2.0, "stream": 1.0}


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"user_id", "event_id", "x", "max_ending_here", "max_subarray"}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_arff_nulls_short_lines_and_headers(spark, tmp_path):
    import pytest

    from driftwood.sources import arff

    spec = arff.ArffSpec("t", [arff.Attribute("a"), arff.Attribute("b"), arff.Attribute("c", ["x", "y"]), arff.Attribute("k", ["p", "q"])])
    df = spark.createDataFrame([(1.0, None, 0.0, 1.0), (None, 2.0, None, 0.0), (0.0, 0.0, 1.0, None)], "a double, b double, c double, k double")
    for sparse in (False, True):
        path = str(tmp_path / f"s{sparse}")
        arff.write_arff(df, path, spec, ["a", "b", "c", "k"], sparse=sparse)
        for given in (None, spec):
            got = {tuple(r) for r in arff.read_arff(spark, path, spec=given, nominal_class=True).collect()}
            assert got == {tuple(r) for r in df.collect()}
    (tmp_path / "short.arff").write_text("@relation r\n@attribute a numeric\n% note\n@attribute k {p,q}\n@data\n1,p\n2\n?,q\n")
    assert {tuple(r) for r in arff.read_arff(spark, str(tmp_path / "short.arff")).collect()} == {(1.0, 0.0), (2.0, None), (None, 1.0)}
    with pytest.raises(ValueError, match="numeric"):
        arff.parse_arff_header(["@attribute a numeric", "@data"], nominal_class=True)
    with pytest.raises(ValueError, match="@data"):
        arff.parse_arff_header(["@attribute a numeric"])


def test_linear_width_mismatch_is_an_error(spark):
    import pytest

    from driftwood.operators import linear

    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 1.0)], "x array<double>, y double")
    with pytest.raises(Exception):
        linear.linear_train(df, "x", "y", 2, steps=1)


def test_sparse_features_train_like_dense_ones(spark):
    from pyspark.sql import functions as F

    from driftwood.functions import vectors as vec
    from driftwood.operators import linear

    rows = [([float(i % 3), 0.0, float(i % 5) / 2, 0.0], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "x array<double>, y double").withColumn("m", vec.dense_to_map("x"))
    w0 = [0.1, -0.2, 0.3, 0.4, 0.05]
    for loss in linear.LOSSES:
        dense = linear.linear_train(df, "x", "y", 4, loss=loss, steps=3, init=w0)
        sparse = linear.linear_train(df, "m", "y", 4, loss=loss, steps=3, init=w0)
        assert all(abs(a - b) < 1e-9 for a, b in zip(dense, sparse))
    got = df.select(linear.linear_score("x", w0).alias("a"), linear.linear_score_sparse("m", w0).alias("b"))
    assert got.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0

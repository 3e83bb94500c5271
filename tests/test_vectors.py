import math

from pyspark.sql import functions as F

from driftwood.functions import conditions as C
from driftwood.functions import vectors as V


def test_dense_ops(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0])], "a array<double>, b array<double>")
    r = df.select(V.vec_get("a", 1).alias("g1"), V.vec_get("a", 5).alias("g5"),
                  V.vec_get("a", -1).alias("gneg"),
                  V.vec_dot("a", "b").alias("dot"), V.vec_add("a", "b").alias("add"),
                  V.vec_hadamard("a", "b").alias("had"), V.vec_distance("a", "b").alias("dist"),
                  V.vec_set("a", 1, 9.0).alias("set1"), V.vec_set("a", 3, 7.0).alias("app"),
                  V.vec_set("a", 8, 7.0).alias("noop"), V.vec_map("a", lambda x: x * 2).alias("m"),
                  V.vec_reduce("a", lambda acc, x: acc + x).alias("red"),
                  V.vec_argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("am")).first()
    assert (r.g1, r.g5, r.gneg) == (2.0, 0.0, 0.0)
    assert r.dot == 1 * 4 + 2 * 5
    assert r.add == [5.0, 7.0, 3.0] and r.had == [4.0, 10.0, 0.0]
    assert math.isclose(r.dist, math.sqrt(9 + 9 + 9))
    assert r.set1 == [1.0, 9.0, 3.0] and r.app == [1.0, 2.0, 3.0, 7.0] and r.noop == [1.0, 2.0, 3.0]
    assert r.m == [2.0, 4.0, 6.0] and r.red == 6.0 and r.am == 1


def test_map_ops(spark):
    df = spark.createDataFrame([({"x": 1.0, "y": 2.0}, {"y": 3.0, "z": -2.0})],
                               "a map<string,double>, b map<string,double>")
    r = df.select(V.map_get("a", "y").alias("g"), V.map_get("a", "q").alias("gq"),
                  V.map_dot("a", "b").alias("dot"), V.map_add("a", "b").alias("add"),
                  V.map_hadamard("a", "b").alias("had"), V.map_distance("a", "b").alias("dist"),
                  V.map_set("a", "x", 5.0).alias("set")).first()
    assert (r.g, r.gq, r.dot) == (2.0, 0.0, 6.0)
    assert r.add == {"x": 1.0, "y": 5.0, "z": -2.0}
    assert r.had == {"y": 6.0}
    assert math.isclose(r.dist, math.sqrt(1 + 1 + 4))
    assert r.set == {"x": 5.0, "y": 2.0}


def test_sparse_first_wins_and_entries(spark):
    df = spark.createDataFrame([(1, [0, 3, 0], [1.5, 2.0, 9.0])], "id int, i array<int>, v array<double>")
    m = df.select("id", V.sparse_from_arrays("i", "v").alias("m"))
    assert m.first().m == {0: 1.5, 3: 2.0}
    ent = sorted((r["index"], r["value"]) for r in V.vec_entries(m, "m", keep=["id"]).collect())
    assert ent == [(0, 1.5), (3, 2.0)]


def test_branch_tests(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double")
    got = df.select(C.numeric_test("v", 2.0).alias("lt"), C.numeric_test("v", 2.0, True).alias("eq"),
                    C.nominal_test("v", 3.0).alias("nom"), C.multiway_test("v").alias("mw"),
                    *[C.rule_predicate("v", 2.0, k).alias(f"r{k}") for k in range(4)]).collect()
    assert [r.lt for r in got] == [0, 1, 1] and [r.eq for r in got] == [1, 0, 1]
    assert [r.nom for r in got] == [1, 1, 0] and [r.mw for r in got] == [1, 2, 3]
    assert [r.r1 for r in got] == [0, 0, 1] and [r.r2 for r in got] == [0, 1, 1]
    assert [r.r0 for r in got] == [r.r3 for r in got] == [1, 0, 1]

"""Trees whose plans do not grow with the model."""

from pyspark.sql import functions as F

from driftwood.operators.tree import HoeffdingTree, Node


def _deep_tree(leaves, leaf_type="nb"):
    """A chain of numeric cuts, with a nominal and a multiway test at its end, and statistics of every leaf."""
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, leaf_type=leaf_type)
    ht.nodes, ht.next_id = {}, 0

    def node(parent, branch, depth):
        i, ht.next_id = ht.next_id, ht.next_id + 1
        ht.nodes[i] = Node(i, parent, branch, depth, "active", [1.0 + i % 2, 1.5])
        if parent is not None:
            ht.nodes[parent].children[branch] = i
        return ht.nodes[i]

    def split(n, feature, test, value, branches):
        n.kind, n.feature, n.test, n.value, n.n_branches = "split", feature, test, value, branches
        return [node(n.id, b, n.depth + 1) for b in range(branches)]

    at = node(None, None, 0)
    for i in range(leaves):
        _, at = split(at, 0, "numeric", float(i), 2)
    _, at = split(at, 1, "nominal", 1.0, 2)
    split(at, 1, "multiway", None, 2)  # no child for the value 2
    for n in ht.leaves():
        for c in range(2):
            ht.g[(n.id, 0, c)] = [5.0, float(n.id + c), 2.0, 0.0, 9.0]
            ht.n[(n.id, 1, c, 0.0)] = 3.0
    return ht


def test_node_arrays_route_as_the_tests_do(spark):
    ht = _deep_tree(12)
    rows = [(i, x, z) for i, (x, z) in enumerate((x, z) for x in (-1.0, 3.5, 11.0, 99.0, None, float("nan")) for z in (0.0, 1.0, 2.0, None))]
    df = spark.createDataFrame(rows, "seq int, x double, z double")
    got = {r.seq: (r.a, r.b) for r in df.select("seq", ht.route().alias("a"), ht.route_arrays().alias("b")).collect()}
    assert all(a == b for a, b in got.values())
    assert {i: ht.route_values(v) for i, *v in rows if v[0] == v[0]} == {i: got[i][1] for i, *v in rows if v[0] == v[0]}


def test_naive_bayes_plans_do_not_grow_with_the_leaves(spark):
    df = spark.range(10).select(F.col("id").alias("seq"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("z"), F.lit(0).alias("label"))
    sizes = [len(_deep_tree(n).predict(df, ["seq"])._jdf.queryExecution().toString()) for n in (70, 700)]
    assert sizes[1] < 4 * sizes[0] and sizes[1] < 1_000_000
    assert _deep_tree(70).predict(df, ["seq"]).where("prediction is not null").count() == 10


def test_no_attempt_after_a_sure_split(spark):
    ht = HoeffdingTree(["x"], 2, grace=100.0, tie_threshold=0.5, delta=0.1)
    sums = spark.createDataFrame([(0, b, -1, c, 0.0, 100.0, None, None, None, None) for b in range(6) for c in (0, 1)],
                                 "leaf int, _block long, feature int, label int, value double, w double, s1 double, s2 double, mn double, mx double")
    at = sums.select("leaf", "_block").distinct()
    assert [r["_block"] for r in ht._attempts(sums, at, [0], False).collect()] == [0]
    ht.pre_prune = False
    assert ht._attempts(sums, at, [0], False).count() == 6

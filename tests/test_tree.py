from pyspark.sql import functions as F

import pytest

from driftwood.operators.ensemble import load_model, save_model
from driftwood.operators.tree import HoeffdingTree
from driftwood.streaming.tree import tree_step
from tests.plain_tree import Plain


def _data(spark, n=1200):
    rows = []
    for i in range(n):
        x = (i * 37) % 100 / 10.0  # 0..9.9
        z = float(i % 3)
        label = 0 if x < 5.0 else 1
        rows.append((i, x, z, label))
    return spark.createDataFrame(rows, "seq long, x double, z double, label int")


def test_tree_learns_threshold_split(spark):
    df = _data(spark)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, split_all=True)
    ht.fit(df, ["seq"], rows_per_block=300)
    root = ht.nodes[0]
    assert root.kind == "split" and root.feature == 0 and root.test == "numeric"
    assert 4.0 <= root.value <= 6.0
    pred = ht.predict(df, ["seq"]).join(df, "seq")
    acc = pred.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.95
    shape = ht.shape(spark).first()
    assert shape.n_split >= 1 and shape.height >= 1 and shape.n_leaves == shape.n_nodes - shape.n_split
    rules = {r.node_id: r.rule for r in ht.rules(spark).collect()}
    assert any("x < " in r for r in rules.values())
    pure = ht.pure_leaves(spark).collect()
    assert len(pure) == shape.n_leaves


def test_route_matches_python_walk(spark):
    df = _data(spark, 600)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True)
    ht.fit(df, ["seq"], rows_per_block=200)

    def walk(x, z):
        n = ht.nodes[0]
        while n.kind == "split":
            v = (x, z)[n.feature]
            if n.test == "numeric":
                b = 0 if v < n.value else 1
            elif n.test == "nominal":
                b = 0 if v == n.value else 1
            else:
                b = int(v)
            if b not in n.children:
                break
            n = ht.nodes[n.children[b]]
        return n.id

    got = df.select("x", "z", ht.route().alias("leaf")).collect()
    assert all(r.leaf == walk(r.x, r.z) for r in got)


def test_pure_and_grace_prevent_split(spark):
    df = spark.createDataFrame([(i, float(i), 0) for i in range(400)], "seq long, x double, label int")
    ht = HoeffdingTree(["x"], 2, grace=100)
    ht.fit(df, ["seq"], rows_per_block=100)
    assert len(ht.nodes) == 1  # single class: pure leaf never splits
    assert ht.predict(df, ["seq"]).filter("prediction != 0").count() == 0


def test_nb_and_adaptive_leaves_predict(spark):
    df = _data(spark, 600)
    for lt in ("nb", "adaptive"):
        ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=1e9, leaf_type=lt)
        ht.fit(df, ["seq"], rows_per_block=300, id_cols=["seq"])
        pred = ht.predict(df, ["seq"]).join(df, "seq")
        acc = pred.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        assert acc > 0.8, lt  # Gaussian NB at the single leaf separates x < 5


def test_nulls_and_unknown_criterion(spark):
    rows = [(i, None if i % 10 == 0 else i % 100 / 10.0, None if i % 7 == 0 else float(i % 3),
             None if i % 11 == 0 else int(i % 100 >= 50)) for i in range(1200)]
    df = spark.createDataFrame(rows, "seq long, x double, z double, label int")
    for kind in ("majority", "nb", "adaptive"):
        ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True, leaf_type=kind)
        ht.fit(df, ["seq"], rows_per_block=400)
        assert len(ht.nodes) > 1 and ht.predict(df, ["seq"]).count() == 1200
    with pytest.raises(ValueError):
        HoeffdingTree(["x"], 2, criterion="variance_reduction")


def test_blocks_are_exact_positions(spark):
    df = _data(spark, 700)
    trees = []
    for parts in (1, 3, 8):
        ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True)
        ht.fit(df.repartition(parts), ["seq"], rows_per_block=300)
        assert ht.blocks_seen == 3
        trees.append([(n.id, n.kind, n.feature, n.value, [round(v, 6) for v in n.dist]) for n in ht.nodes.values()])
    assert trees[0] == trees[1] == trees[2]


def test_scoring_has_no_exchange(spark):
    df = _data(spark, 600)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=1e9, leaf_type="nb")
    ht.fit(df, ["seq"], rows_per_block=300)
    plan = ht.predict(spark.range(10).selectExpr("id as seq", "1.0D as x", "2.0D as z"), ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_route_join_matches_when_tree(spark):
    df = _data(spark, 600)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True)
    ht.fit(df, ["seq"], rows_per_block=200)
    a = df.select("seq", ht.route().alias("leaf"))
    b = ht.route_join(df.select("seq", "x", "z")).select("seq", "leaf")
    assert a.exceptAll(b).count() == 0 and b.count() == 600


def test_large_tree_path_matches_small(spark):
    df = _data(spark, 600)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True)
    ht.fit(df, ["seq"], rows_per_block=200)
    small = ht.predict(df, ["seq"])
    ht.max_when_nodes = 1  # force the join-per-level router
    big = ht.predict(df, ["seq"])
    assert small.exceptAll(big).count() == 0
    ht2 = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=50, split_all=True)
    ht2.max_when_nodes = 1
    ht2.fit(df, ["seq"], rows_per_block=200)
    assert {n.id: (n.kind, n.feature) for n in ht2.nodes.values()} == \
        {n.id: (n.kind, n.feature) for n in ht.nodes.values()}


def test_poor_features_are_given_up(spark):
    # two equal good features keep the leaf from splitting; the noise feature trails by more than the bound
    rows = [(i, float(i % 2), float(i % 2), float((i * 7919) % 13), i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "seq long, a double, b double, noise double, label int")
    ht = HoeffdingTree(["a", "b", "noise"], 2, grace=100, tie_threshold=0.0, remove_poor=True, leaf_type="nb")
    ht.fit(df, ["seq"], rows_per_block=1500)
    assert ht.poor == {0: {2}} and not any(k[1] == 2 for k in ht.g) and len(ht.nodes) == 1
    assert ht.predict(df, ["seq"]).join(df, "seq").where("prediction <> label").count() == 0


def _noisy(spark, n=6000):
    """Two numeric features and two nominal ones, of which the label follows the first two with noise."""
    import random

    rng, rows = random.Random(17), []
    for i in range(n):
        x, y, z, v = rng.gauss(0, 2) + 1000, rng.random(), float(rng.randrange(3)), float(rng.randrange(5))
        label = int(x > 1000.5) if rng.random() < 0.85 else rng.randrange(3)
        if z == 2 and rng.random() < 0.8:
            label = 2
        if i % 97 == 0:
            x = [None, float("nan"), float("inf")][i % 3]
        rows.append((i, x, y, z if i % 53 else None, v, None if i % 41 == 0 else label, [0.5, 1.0, 2.0][i % 3]))
    return spark.createDataFrame(rows, "seq long, x double, y double, z double, v double, label int, w double")


def _table(ht):
    return [(n.id, n.parent, n.branch, n.kind, n.feature, n.test, None if n.value is None else round(n.value, 5),
             [round(d, 2) for d in n.dist], dict(n.children)) for n in sorted(ht.nodes.values(), key=lambda n: n.id)]


def _plain_table(p):
    return [(i, n["parent"], n["branch"], n["kind"], n["feature"], n["test"], None if n["value"] is None else round(n["value"], 5),
             [round(d, 2) for d in n["dist"]], n["kids"]) for i, n in enumerate(p.nodes)]


@pytest.mark.parametrize("options", [dict(split_all=True, criterion="gini", weight="w"), dict(binary_only=True)])
def test_first_fire_search_equals_plain_blocks(spark, options):
    """55 blocks (in one run, or in runs of 16, 32 and 7) against rows taken one by one; adaptive leaves included."""
    df = _noisy(spark, 3300)
    rows = [((r.x, r.y, r.z, r.v), r.label, r.w if "weight" in options else 1.0) for r in df.orderBy("seq").collect()]
    shared = {k: v for k, v in options.items() if k != "weight"}
    plain = Plain({2: 3, 3: 5}, 3, 4, grace=40, tie=0.1, track=True, **shared).fit(rows, 60)
    ht = HoeffdingTree(["x", "y", "z", "v"], 3, nominal={2: 3, 3: 5}, grace=40, tie_threshold=0.1, leaf_type="adaptive", **options)
    ht.fit(df, ["seq"], rows_per_block=60, first_run=16 if "weight" in options else 64)
    assert ht.blocks_seen == 55 and sum(n["kind"] == "split" for n in plain.nodes) >= 2
    assert _table(ht) == _plain_table(plain)
    got = {r.seq: r.prediction for r in ht.predict(df, ["seq"]).collect()}
    clean = [i for i, (x, _, _) in enumerate(rows) if x[0] is not None and abs(x[0]) < 1e9 and x[2] is not None]
    assert sum(got[i] != plain.adaptive(rows[i][0]) for i in clean[::7]) == 0


def test_jobs_follow_the_depth_not_the_blocks(spark, monkeypatch):
    from driftwood.operators import tree as T

    df = _data(spark, 1500)
    rounds = []
    inner = HoeffdingTree._block_sums
    monkeypatch.setattr(HoeffdingTree, "_block_sums", lambda self, rows, start: rounds.append(len(start)) or inner(self, rows, start))
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, split_all=True)
    ht.fit(df, ["seq"], rows_per_block=20, first_run=200)  # 75 blocks, one run
    assert ht.blocks_seen == 75 and len(rounds) <= max(n.depth for n in ht.nodes.values()) + 1
    want = _table(ht)
    monkeypatch.setattr(T, "SEGMENT", 7)  # the two-level merge
    again = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, split_all=True)
    assert _table(again.fit(df, ["seq"], rows_per_block=20, first_run=60)) == want


def test_a_criterion_of_the_users_own(spark):
    """Share of the weight that the branches' majorities get right."""
    from driftwood.operators import splits

    def right(post, cand):
        by = post.groupBy(*cand, "branch", "label").agg(F.sum("w").alias("w"))
        best = by.groupBy(*cand, "branch").agg(F.max("w").alias("m"), F.sum("w").alias("w"))
        return best.groupBy(*cand).agg((F.sum("m") / F.sum("w")).alias("merit"))

    class Right(Plain):
        def merit(self, post):
            return sum(max(p) for p in post) / sum(map(sum, post))

    df = _data(spark, 900)
    rows = [((r.x, r.z), r.label, 1.0) for r in df.orderBy("seq").collect()]
    plain = Right({1: 3}, 2, 2, grace=100, tie=0.05, split_all=True, pre_prune=False, delta=0.01, criterion="gini").fit(rows, 100)
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, split_all=True, pre_prune=False, delta=0.01,
                       criterion=splits.Criterion(right, lambda classes: 1.0))
    assert _table(ht.fit(df, ["seq"], rows_per_block=100)) == _plain_table(plain) and len(ht.nodes) > 1
    with pytest.raises(ValueError):
        HoeffdingTree(["x"], 2, criterion="unknown")


@pytest.mark.parametrize("options", [dict(split_all=True, leaf_type="nb", weight="w"), dict(remove_poor=True, leaf_type="adaptive")])
def test_a_saved_tree_goes_on_learning(spark, tmp_path, options):
    df = _noisy(spark, 3000)
    make = lambda: HoeffdingTree(["x", "y", "z", "v"], 3, nominal={2: 3, 3: 5}, grace=100, **options)
    halves = [df.filter("seq < 1500"), df.filter("seq >= 1500")]
    straight = make()
    for h in halves:
        straight.train_block(h, ["seq"], ["seq"])
    first = make()
    first.train_block(halves[0], ["seq"], ["seq"])
    save_model(first.model_tables(spark), str(tmp_path / "tree"))
    again = make().load_tables(load_model(spark, str(tmp_path / "tree"), ["nodes", "moments", "values", "given_up", "progress"]))
    assert _table(again) == _table(first) and again.g == first.g and again.n == first.n and again.poor == first.poor
    again.train_block(halves[1], ["seq"], ["seq"])
    assert _table(again) == _table(straight) and again.next_id == straight.next_id
    mine, theirs = ({r.seq: r.prediction for r in t.predict(df, ["seq"]).collect()} for t in (again, straight))
    assert mine == theirs


def test_stream_state_is_tables_and_replays(spark):
    df = _noisy(spark, 2000).withColumn("cmd", F.when(F.col("seq") % 4 == 0, "QUERY").otherwise("EXAMPLE"))
    make = lambda: HoeffdingTree(["x", "y", "z", "v"], 3, nominal={2: 3, 3: 5}, grace=100, split_all=True)
    epochs = [df.filter(f"seq >= {k} and seq < {k + 1000}") for k in (0, 1000)]
    step = tree_step(make(), ["seq"], ["seq"])
    _, state = step(epochs[0], None, 0)
    state = spark.createDataFrame(state.collect(), state.schema)
    answers = {r.seq: r.prediction for r in step(epochs[1], state, 1)[0].collect()}
    # a replay of the epoch, and a step started anew, give the same answers as the running one
    assert {r.seq: r.prediction for r in step(epochs[1], state, 1)[0].collect()} == answers
    assert {r.seq: r.prediction for r in tree_step(make(), ["seq"], ["seq"])(epochs[1], state, 1)[0].collect()} == answers
    assert len(answers) == 250 and len(set(answers.values())) > 1

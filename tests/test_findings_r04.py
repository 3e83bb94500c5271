"""Findings of round 4: what grows with the table, on small rows of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwood.operators.tree import HoeffdingTree


@pytest.fixture(scope="module")
def examples(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(2400):
        x, z = float(rng.normal()), float(rng.integers(0, 3))
        y = int(x + 0.3 * rng.normal() > 0) if z else int(rng.integers(0, 2))
        rows.append((i, None if i % 97 == 0 else float("nan") if i % 89 == 0 else x, None if i % 83 == 0 else z, None if i % 71 == 0 else y, 1.0 + i % 3))
    return spark.createDataFrame(rows, "seq int, x double, z double, label int, w double")


def _totals(rows):
    out = {}
    for r in rows:
        k = (r.leaf, r.feature, r.label, r.value)
        old = out.get(k, (0.0, 0.0, 0.0, np.inf, -np.inf))
        out[k] = (old[0] + r.w, old[1] + (r.s1 or 0.0), old[2] + (r.s2 or 0.0), min(old[3], np.inf if r.mn is None else r.mn),
                  max(old[4], -np.inf if r.mx is None else r.mx))
    return out


def test_sums_between_attempts_are_those_of_the_blocks(spark, examples):
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, weight="w")
    ht.fit(examples, ["seq"], rows_per_block=60)
    leaves = [n.id for n in ht.leaves()]
    assert len(leaves) >= 2
    rows = examples.withColumn("_block", F.floor(F.col("seq") / 60).cast("long"))
    single = ht._block_sums(rows, {i: (3,) for i in leaves}).collect()
    spans = ht._block_sums(rows, {i: (3, 11, 39) for i in leaves}).collect()
    assert {r["_block"] for r in spans} == {11, 39} and len(spans) < len(single) / 5
    for low, high, end in ((3, 11, 11), (12, 39, 39)):
        want = _totals(r for r in single if low <= r["_block"] <= high)
        got = _totals(r for r in spans if r["_block"] == end)
        assert got.keys() == want.keys()
        for k in want:
            assert np.allclose(got[k], want[k], equal_nan=True), k


def test_what_the_driver_reads_follows_the_attempts(spark, examples, monkeypatch):
    sizes, inner = [], HoeffdingTree._learn
    monkeypatch.setattr(HoeffdingTree, "_learn", lambda self, sums, until: sizes.append(sums.num_rows) or inner(self, sums, until))
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=10_000, tie_threshold=0.0)  # never splits: one leaf, 120 attempts
    ht.fit(examples, ["seq"], rows_per_block=20)
    few = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grow=False)  # no attempt: one sum a run
    few.fit(examples, ["seq"], rows_per_block=20)
    assert sum(sizes[-2:]) <= 2 * (2 + 2 + 6) and ht.g.keys() == few.g.keys()
    assert all(np.allclose(ht.g[k], few.g[k]) for k in ht.g)


def test_naive_bayes_leaves_score_without_a_join(spark, examples):
    ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, leaf_type="nb")
    ht.fit(examples, ["seq"], rows_per_block=60)
    ht.max_when_nodes = 0
    plan = ht.predict(examples, ["seq"])._jdf.queryExecution().toString()
    assert "Join" not in plan and "aggregate(" not in plan


def _batch_and_epochs(spark, df, step_of, rows):
    """Answers and states of one micro-batch of all rows and of a micro-batch an epoch, by ``_state``."""
    from functools import reduce

    one, state = step_of(rows)(df, None, 0)
    answers, held, parts = [], None, [df.where((F.col("id") >= low) & (F.col("id") < low + rows)) for low in range(0, df.count(), rows)]
    step = step_of(None)
    for e, part in enumerate(parts):
        out, held = step(part, None if held is None else held.localCheckpoint(), e)
        answers.append(out.localCheckpoint())
    return one, state, reduce(lambda a, b: a.unionByName(b), answers), held


def test_naive_bayes_takes_many_epochs_in_a_batch(spark):
    from driftwood.operators import bayes
    from driftwood.streaming.learners import nb_step

    rng = np.random.default_rng(3)
    rows = []
    for i in range(70):
        words = {f"w{int(w)}": float(rng.integers(1, 4)) for w in rng.integers(0, 9 + i // 4, 5)}
        rows.append((i, None if i < 12 or i % 5 == 0 else int(rng.integers(0, 2 if i < 40 else 3)), {} if i % 17 == 0 else words))
    df = spark.createDataFrame(rows, "id long, label int, tf map<string,double>")

    def step_of(n):
        return nb_step(["id"], "tf", order_cols=["id"], rows_per_epoch=n)

    def key(r):
        return str(r["kind"]), r["label"], str(r["feature"]), r["mass"]

    one, state, each, held = _batch_and_epochs(spark, df, step_of, 10)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, each.collect()), key=str)
    assert sorted(map(key, state.collect())) == sorted(map(key, held.collect()))
    # two micro-batches of several epochs each go on from the state
    first, middle = step_of(10)(df.where("id < 40"), None, 0)
    second, last = step_of(10)(df.where("id >= 40"), middle.localCheckpoint(), 1)
    assert {r.id: r.prediction for r in first.unionByName(second).collect()} == {r.id: r.prediction for r in each.collect()}
    assert sorted(map(key, last.collect())) == sorted(map(key, held.collect()))
    # without any label
    none, _ = bayes.nb_test_then_train(None, df.withColumn("label", F.lit(None).cast("int")).withColumn("e", F.lit(0)), "e", ["id"], "tf")
    assert [r.prediction for r in none.collect()] == [None] * 70


def test_linear_models_take_many_epochs_in_a_batch(spark, monkeypatch):
    from driftwood.operators import linear
    from driftwood.streaming.learners import linear_step

    rng = np.random.default_rng(5)
    rows = [(i, None if i % 13 == 0 else [float(v) for v in rng.normal(size=3)], None if i % 10 == 0 else float(rng.integers(0, 2))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double")
    for loss in ("squared", "hinge"):
        def step_of(n):
            return linear_step(["id"], "x", "y", 3, loss, steps=2, reg="l2", reg_param=0.01, init=[0.1, 0.2, 0.3, 0.4], order_cols=["id"], rows_per_epoch=n)

        one, state, each, held = _batch_and_epochs(spark, df, step_of, 10)
        got, want = ({r.id: (r.score, r.prediction) for r in d.collect()} for d in (one, each))
        assert got.keys() == want.keys() and all(
            got[i][0] == want[i][0] or abs(got[i][0] - want[i][0]) < 1e-9 and got[i][1] == want[i][1] for i in got)
        got, want = ({r["index"]: r["weight"] for r in d.collect()} for d in (state, held))
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)

    def fail(*a, **k):
        raise AssertionError("a job for each epoch")

    monkeypatch.setattr(linear, "linear_train", fail)
    linear_step(["id"], "x", "y", 3, order_cols=["id"], rows_per_epoch=5)(df, None, 0)[0].count()


def test_majority_votes_are_tracked_across_runs(spark, examples):
    counts = []
    for first_run in (64, 10):
        ht = HoeffdingTree(["x", "z"], 2, nominal={1: 3}, grace=100, leaf_type="adaptive")
        ht.fit(examples.where("seq < 1200"), ["seq"], rows_per_block=60, first_run=first_run)
        counts.append({n.id: (n.kind, n.mc_correct) for n in ht.nodes.values() if n.kind != "split"})
    assert counts[0] == counts[1] and sum(c for _, c in counts[0].values()) > 100

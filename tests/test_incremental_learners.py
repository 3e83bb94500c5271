"""Prequential naive Bayes on word maps, long follow-the-leader windows, test-then-train streams."""

import math
import random

from pyspark.sql import functions as F

from driftwood.operators import bayes, linear, ordered
from driftwood.streaming import learners, runner
from tests.test_ordered import ftl_loop


class _Words:
    """Plain multinomial naive Bayes that learns row by row."""

    def __init__(self, classes):
        self.n, self.f = dict.fromkeys(classes, 0.0), {c: {} for c in classes}

    def learn(self, label, row):
        if label in self.n:
            self.n[label] += 1
            for w, x in row.items():
                self.f[label][w] = self.f[label].get(w, 0.0) + x

    def answer(self, row, s=1.0, size=None):
        vocabulary = set().union(*self.f.values())
        total = sum(sum(f.values()) for f in self.f.values())
        best = None
        for c in sorted(self.n):
            den = sum(self.f[c].values()) + (len(vocabulary) if size is None else size) * s
            score = math.log(self.n[c] + s) - math.log(total + len(self.n) * s)
            score += sum(x * (math.log(self.f[c].get(w, 0.0) + s) - math.log(den)) for w, x in row.items() if w in vocabulary)
            if best is None or score > best[0] + 1e-9:
                best = score, c
        return best[1]


def _documents(n, rng):
    rows = []
    for i in range(n):
        words = {rng.choice("abcdefghijkl"): float(rng.randint(1, 4)) for _ in range(rng.randint(0, 5))} | {"the": float(rng.randint(1, 9))}
        kind = rng.choice(["EXAMPLE", "QUERY", "EXAMPLE"])
        rows.append((i, kind, rng.choice([0, 1, 2, 7, None]) if kind == "EXAMPLE" else None, words if i % 17 else {}))
    return rows


def test_prequential_words_match_a_loop(spark):
    rng = random.Random(4)
    rows = _documents(300, rng)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "id long, cmd string, label int, tf map<string,double>")
    for size in (None, 40):
        # one word is in nearly every row: it is split over ranges of the order
        got = bayes.nb_prequential_entries(df, ["id"], "tf", "label", "cmd", ["id"], [0, 1, 2], num_features=size,
                                           min_buckets=4, rows_per_bucket=20)
        model, want = _Words([0, 1, 2]), {}
        for i, kind, label, row in rows:
            want[i] = model.answer(row, size=size) if kind == "QUERY" else None
            if kind == "EXAMPLE":
                model.learn(label, row)
        assert {r.id: r.prediction for r in got.collect()} == want
    assert bayes.nb_prequential_entries(df.limit(0), ["id"], "tf", "label", "cmd", ["id"], [0, 1, 2]).count() == 0
    nulls = spark.createDataFrame([(1, "QUERY", None, None), (2, "EXAMPLE", 1, None), (3, "QUERY", None, {"a": None}), (3, "QUERY", None, {"a": 1.0})],
                                  df.schema)
    got = bayes.nb_prequential_entries(nulls, ["id"], "tf", "label", "cmd", ["id"], [0, 1])
    assert sorted((r.id, -1 if r.prediction is None else r.prediction) for r in got.collect()) == [(1, 0), (2, -1), (3, 1), (3, 1)]


def test_prequential_words_agree_with_training_on_the_past(spark):
    rows = _documents(60, random.Random(9))
    df = spark.createDataFrame([(i, k, None if lab is None else lab % 2, w) for i, k, lab, w in rows],
                               "id long, cmd string, label int, tf map<string,double>")
    got = {r.id: r.prediction for r in bayes.nb_prequential_entries(df, ["id"], "tf", "label", "cmd", ["id"], [0, 1]).collect()}
    last = max(i for i, p in got.items() if p is not None)
    past = df.filter((F.col("id") < last) & F.col("label").isNotNull())
    model = bayes.nb_train(past, "tf")
    assert bayes.nb_predict(model, df.filter(F.col("id") == last), ["id"], "tf").first().prediction == got[last]


def test_long_windows_match_a_loop(spark, monkeypatch):
    rng = random.Random(2)
    pairs = [(float(rng.randint(0, 12)), float(rng.randint(0, 200))) for _ in range(2500)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "seq long, x double, y double").repartition(5)
    for run_rows, window in ((1, 40), (1000, 100), (100_000, 1000), (100_000, 5000), (7, 1), (7, 9)):
        monkeypatch.setattr(ordered, "RUN_ROWS", run_rows)
        got = ordered.follow_the_leader(df, "x", "y", ["seq"], window=window, rows_per_bucket=400).orderBy("seq").collect()
        assert [(r.leader, r.prediction) for r in got] == ftl_loop(pairs, list(range(31)), window)


def test_long_window_plans_do_not_grow(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "seq long, x double, y double")

    def plan(w):
        return ordered.follow_the_leader(df, "x", "y", ["seq"], window=w)._jdf.queryExecution().optimizedPlan().toString()
    assert abs(len(plan(100_000)) - len(plan(2))) < 200


def test_large_past_values_leave_no_error(spark):
    pairs = [(1.0, 1e15)] + [(1.0, 0.1 * (i % 7)) for i in range(40)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "seq long, x double, y double")
    got = ordered.follow_the_leader(df, "x", "y", ["seq"], window=3, hypotheses=[lambda v: v * 0.3, lambda v: v * 0.30001]).orderBy("seq").collect()
    for t in range(5, 41):
        past = pairs[t - 2:t + 1]
        cost = [sum(abs(h - y) for _, y in past) for h in (0.3, 0.30001)]
        assert got[t].leader == (0 if cost[0] <= cost[1] + 1e-12 else 1)


def _streamed(spark, df, order, step, rows):
    staged = runner.stage_files(df, order, None, "learner-src", rows_per_epoch=rows)
    return runner.run_file_stream(spark, staged, df.schema, runner.StatefulBatches(spark, step, "learner")).collect()


def test_naive_bayes_stream(spark):
    rows = [(i, None if k == "QUERY" or lab == 7 else lab, w) for i, k, lab, w in _documents(90, random.Random(6))]
    df = spark.createDataFrame(rows, "id long, label int, tf map<string,double>")
    got = {r.id: r.prediction for r in _streamed(spark, df, ["id"], learners.nb_step(["id"], "tf"), 30)}
    model, want = _Words([0, 1, 2]), {}
    for epoch in range(3):
        part = rows[30 * epoch:30 * epoch + 30]
        want |= {i: model.answer(w) if epoch else None for i, _, w in part}
        for _, label, w in part:
            model.learn(label, w)
    assert got == want


def test_naive_bayes_stream_without_labels(spark):
    df = spark.createDataFrame([(i, None, {"a": 1.0}) for i in range(8)], "id long, label int, tf map<string,double>")
    got = _streamed(spark, df, ["id"], learners.nb_step(["id"], "tf"), 4)
    assert sorted(r.id for r in got) == list(range(8)) and all(r.prediction is None for r in got)


def test_linear_stream(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)], None if i % 10 == 0 else float(rng.random() < 0.5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double")
    got = {r.id: (r.score, r.prediction) for r in _streamed(spark, df, ["id"], learners.linear_step(["id"], "x", "y", 3, loss="logistic"), 20)}
    w = [0.0] * 4
    for epoch in range(3):
        part = rows[20 * epoch:20 * epoch + 20]
        for i, x, _ in part:
            score = sum(a * b for a, b in zip(w, [*x, 1.0]))
            assert abs(got[i][0] - score) < 1e-9 and got[i][1] == (1.0 if score > 0 else 0.0)
        labelled = spark.createDataFrame([r for r in part if r[2] is not None], df.schema)
        w = linear.linear_train(labelled, "x", "y", 3, "logistic", 1, 0.1, init=w)


def test_losses_and_penalties_of_the_users_own(spark):
    rng = random.Random(8)
    rows = [([rng.gauss(0, 1), rng.gauss(1, 2)], float(rng.random() < 0.4)) for _ in range(40)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    squared = linear.Loss(lambda y, d: F.lit(0.5) * (d - y) * (d - y), lambda y, d: d - y)
    mine = linear.linear_train(df, "x", "y", 2, squared, 3, 0.1, reg=lambda w: w * -1.0, reg_param=0.05)
    assert mine == linear.linear_train(df, "x", "y", 2, "squared", 3, 0.1, reg="l2", reg_param=0.05)
    # Huber's loss, an elastic penalty and a threshold of its own against a loop
    huber = linear.Loss(lambda y, d: F.when(F.abs(d - y) < 1, 0.5 * (d - y) * (d - y)).otherwise(F.abs(d - y) - 0.5),
                        lambda y, d: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), d - y)), lambda d: (d >= 0.5).cast("double"))
    got = linear.linear_train(df, "x", "y", 2, huber, 4, 0.2, reg=lambda w: w * -0.5, reg_param=0.1)
    w = [0.0] * 3
    for _ in range(4):
        g = [0.0] * 3
        for x, y in rows:
            xb = [*x, 1.0]
            e = max(-1.0, min(1.0, sum(a * b for a, b in zip(w, xb)) - y))
            g = [a - e * b for a, b in zip(g, xb)]
        w = [a + 0.2 * (b / len(rows) - 0.1 * 0.5 * a) for a, b in zip(w, g)]
    assert all(abs(a - b) < 1e-12 for a, b in zip(got, w))
    s = df.select("y", linear.linear_score("x", got).alias("d")).select(
        "y", "d", linear.linear_loss("y", "d", huber).alias("loss"), linear.linear_predict("d", huber).alias("p")).collect()
    for r in s:
        e = abs(r.d - r.y)
        assert abs(r.loss - (0.5 * e * e if e < 1 else e - 0.5)) < 1e-12 and r.p == float(r.d >= 0.5)


def test_large_models_score_without_hot_words(spark, monkeypatch):
    rows = _documents(120, random.Random(3))
    df = spark.createDataFrame([(i, None if lab is None else lab % 2, w) for i, _, lab, w in rows], "id long, label int, tf map<string,double>")
    odd = spark.createDataFrame([(500, None, None), (501, None, {"never": 2.0}), (502, None, {"the": 1.0, "never": 1.0})], df.schema)
    model = bayes.nb_train(df.filter("label is not null"), "tf")
    want = {r.id: r.prediction for r in bayes.nb_predict(model, df.union(odd), ["id"], "tf").collect()}
    monkeypatch.setattr(bayes, "BROADCAST_FEATURES", 4)
    monkeypatch.setattr(bayes, "HOT_FEATURES", 3)
    got = {r.id: r.prediction for r in bayes.nb_predict(model, df.union(odd), ["id"], "tf").collect()}
    assert got == want and len(got) == 123

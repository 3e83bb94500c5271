"""Stream = batch: every streaming form against its batch twin on small inputs."""

import random

from pyspark.sql import functions as F

from driftwood.operators import membership as M
from driftwood.operators import ordered
from driftwood.sources import generators
from driftwood.streaming import membership as SM
from driftwood.streaming import ordered as SO
from driftwood.streaming import runner


def _stream(spark, df, order, step, name, files=3, append=False):
    path = runner.stage_files(df, order, files, name + "-src")
    r = runner.StatefulBatches(spark, step, name, append_state=append)
    return runner.run_file_stream(spark, path, df.schema, r)


def test_kadane_stream_equals_batch(spark):
    rng = random.Random(2)
    rows = [(i % 4, i, rng.randint(-30, 25)) for i in range(240)]
    df = spark.createDataFrame(rows, "k long, seq long, x long")
    out = _stream(spark, df, ["seq"], SO.kadane_step("x", ["seq"], ["k"]), "t-kadane")
    batch = ordered.running_max_subarray(df, "x", ["seq"], ["k"])
    a = out.select("seq", "max_ending_here", "max_subarray")
    b = batch.select("seq", "max_ending_here", "max_subarray")
    assert a.count() == 240 and a.exceptAll(b).count() == 0


def test_rls_and_ftl_global_stream_equal_batch(spark):
    rows = [(i, float(i % 9), float((i * 13) % 40)) for i in range(150)]
    df = spark.createDataFrame(rows, "seq long, x double, y double")
    out = _stream(spark, df, ["seq"], SO.ftl_step("x", "y", ["seq"]), "t-ftl")
    b = ordered.follow_the_leader(df, "x", "y", ["seq"]).select("seq", "leader", "prediction")
    assert out.select("seq", "leader", "prediction").exceptAll(b).count() == 0
    out = _stream(spark, df, ["seq"], SO.rls_step("x", "y", ["seq"]), "t-rls")
    b = ordered.rls_weights(df, "x", "y", ["seq"]).select("seq", F.round("weight", 9).alias("w"))
    assert out.select("seq", F.round("weight", 9).alias("w")).exceptAll(b).count() == 0


def test_bloom_stream_equals_asof_probe(spark):
    data = [("data", 2 * i, i % 50) for i in range(100)]
    queries = [("query", 2 * i + 1, v) for i, v in enumerate(range(0, 80, 3))]
    df = spark.createDataFrame(data + queries, "kind string, seq long, value long")
    out = _stream(spark, df, ["seq"], SM.bloom_step(), "t-bloom")
    got = {(r.seq, r.value): r.maybe for r in out.filter("kind = 'query'").collect()}
    d = df.filter("kind = 'data'")
    q = df.filter("kind = 'query'")
    want = {(r.seq, r.value): r.maybe for r in
            M.bloom_probe_asof(d, "value", "seq", q, "value", "seq", ["seq", "value"]).collect()}
    assert got == want
    assert out.filter("kind = 'data'").count() == 100  # data passes through


def test_bloom_stream_adds_only_its_own_arrivals(spark):
    rng = random.Random(5)
    epochs = [[("data" if rng.random() < 0.6 else "query", 100 * e + k, rng.randrange(60)) for k in range(40)] for e in range(5)]
    schema = "kind string, seq long, value long"
    run = runner.StatefulBatches(spark, SM.bloom_step(append=True), "t-bloom-append", append_state=True, merge=SM.earliest, fan_in=2)
    for e, rows in enumerate(epochs):
        run(spark.createDataFrame(rows, schema), e)
    df = spark.createDataFrame(sum(epochs, []), schema)
    d, q = df.filter("kind = 'data'"), df.filter("kind = 'query'")
    want = M.bloom_probe_asof(d, "value", "seq", q, "value", "seq", ["seq", "value"]).collect()
    got = run.output().filter("kind = 'query'").collect()
    assert {(r.seq, r.value): r.maybe for r in got} == {(r.seq, r.value): r.maybe for r in want}
    assert run.runs(5) == [(0, 3), (4, 4)]
    merged = spark.read.parquet(f"{run.state_dir}/run=0-3")
    assert merged.count() == merged.select("pos").distinct().count()


def test_generators(spark):
    ints = generators.random_ints(spark, 500, -1000, 100).collect()
    assert len(ints) == 500 and all(-1000 <= r.x < 100 for r in ints)
    ramp = generators.noisy_ramp(spark, 200, y0=-10.0, min_buckets=4).orderBy("seq").collect()
    assert ramp[0].y == -10.0
    steps = [b.y - a.y for a, b in zip(ramp, ramp[1:])]
    assert all(7.5 - 1e-9 <= s <= 12.5 + 1e-9 for s in steps)


def test_empty_epoch_keeps_the_state(spark):
    rows = [(i, float(i % 7 + 1), float((i * 5) % 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, x double, y double")
    steps = {"rls": (SO.rls_step("x", "y", ["seq"]), ordered.rls_weights(df, "x", "y", ["seq"]), "prediction"),
             "ftl": (SO.ftl_step("x", "y", ["seq"]), ordered.follow_the_leader(df, "x", "y", ["seq"]), "prediction"),
             "kad": (SO.kadane_step("x", ["seq"]), ordered.running_max_subarray(df, "x", ["seq"]), "max_subarray")}
    for name, (step, batch, col) in steps.items():
        r = runner.StatefulBatches(spark, step, f"t-empty-{name}")
        for epoch, part in enumerate((df.where("seq < 25"), df.where("seq < 0"), df.where("seq >= 25"))):
            r(part, epoch)
        got = {x.seq: round(x[col], 6) for x in r.output().collect()}
        assert got == {x.seq: round(x[col], 6) for x in batch.collect()}


def test_null_keys_stay_in_streams(spark):
    rows = [(None if i % 3 == 0 else i % 2, i, float(i % 5), float(i % 11)) for i in range(90)]
    df = spark.createDataFrame(rows, "k long, seq long, x double, y double")
    out = _stream(spark, df, ["seq"], SO.rls_step("x", "y", ["seq"], ["k"]), "t-null")
    want = ordered.rls_weights(df, "x", "y", ["seq"], ["k"])
    assert {(r.k, r.seq): round(r.weight, 9) for r in out.collect()} == {
        (r.k, r.seq): round(r.weight, 9) for r in want.collect()}

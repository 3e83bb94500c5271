import os
import random


from driftwood.streaming import keyed


def _epochs(spark, base, epochs, schema, transform):
    """Runs every epoch's rows through one query that is stopped and started again; rows of all epochs, and progress."""
    os.makedirs(f"{base}/in")
    stream = spark.readStream.schema(schema).parquet(f"{base}/in")
    progress = []
    for rows in epochs:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
        q = transform(stream).writeStream.format("parquet").option("path", f"{base}/out").option(
            "checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
        progress.append([p for p in q.recentProgress if p["numInputRows"]][-1]["stateOperators"][0])
    return spark.read.parquet(f"{base}/out").collect(), progress


def test_kadane_in_the_state_store(spark, tmp_path):
    rng = random.Random(3)
    idle = [(k + 10, 0, 1) for k in range(10_000)]
    live = [[(rng.randrange(3), 1000 * e + k, rng.randint(-9, 9)) for k in range(40)] for e in range(3)]
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got, progress = _epochs(spark, tmp_path, [idle + live[0], live[1], live[2]], "k long, seq long, x long",
                                lambda s: keyed.running_max_subarray(s, "x", ["seq"], ["k"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want, state = {}, {}
    for k, seq, x in sorted(sum(live, []), key=lambda r: r[1]):
        h, m = state.get(k, (0, 0))
        h = max(0, h + x)
        state[k] = h, max(m, h)
        want[k, seq] = state[k]
    assert {(r.k, r.seq): (r.max_ending_here, r.max_subarray) for r in got if r.k < 10} == want and len(got) == 10_120
    # an epoch touches the keys in it; the idle ones stay where they are
    assert progress[0]["numRowsUpdated"] >= 10_000 and all(p["numRowsUpdated"] <= 3 for p in progress[1:])
    assert progress[-1]["numRowsTotal"] >= 10_000


def test_rls_in_the_state_store(spark, tmp_path):
    rng = random.Random(5)
    epochs = [[(k, 100 * e + i, rng.random() * 4, rng.random()) for k in range(3) for i in range(20)] for e in range(2)]
    got, _ = _epochs(spark, tmp_path, epochs, "k long, seq long, x double, y double",
                     lambda s: keyed.rls(s, "x", "y", ["seq"], ["k"], w0=2.0))
    for key in range(3):
        theta, w = 1.0, 2.0
        for r in sorted((r for r in got if r.k == key), key=lambda r: r.seq):
            theta -= theta * theta * r.x * r.x / (1 + r.x * r.x * theta)
            w -= theta * r.x * (w * r.x - r.y)
            assert abs(r.theta - theta) < 1e-9 and abs(r.weight - w) < 1e-9 and abs(r.prediction - w * r.x) < 1e-9


def test_pairs_of_two_streams_of_unequal_rates(spark, tmp_path):
    """Epochs that bring 5 and 1, 0 and 7, 4 and 0, 2 and 9 elements: the batch zip, whatever the rates."""
    from driftwood.streaming import ordered, runner

    sizes = [(5, 1), (0, 7), (4, 0), (2, 9)]
    schema = "side string, seq long, v double"
    rows, nx, ny = [], 0, 0
    for a, b in sizes:
        epoch = [("x", k, float(k)) for k in range(nx, nx + a)] + [("y", k, 100.0 + k) for k in range(ny, ny + b)]
        nx, ny = nx + a, ny + b
        random.Random(a).shuffle(epoch)
        rows.append(epoch)
    run = runner.StatefulBatches(spark, ordered.zip_step("side", "x", "y", ["seq"]), "pairs")
    for epoch, batch in enumerate(rows):
        run(spark.createDataFrame(batch, schema), epoch)
        if epoch == 1:
            run(spark.createDataFrame(batch, schema), epoch)  # a replayed epoch
    got = sorted((r.pos, r.x.v, r.y.v) for r in run.output().collect())
    assert got == [(k, float(k), 100.0 + k) for k in range(min(nx, ny))]


def test_keyed_stream_in_a_session_that_sets_nothing(tmp_path):
    """No state store provider is set, and Spark's workers do not have this package on their path."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, {root!r})
from driftwood.streaming import keyed
rows = [(k % 3 if k % 3 else None, k, (-1) ** k * k) for k in range(30)]
spark.createDataFrame(rows, "k long, seq long, x long").write.parquet({str(tmp_path / "in")!r})
stream = spark.readStream.schema("k long, seq long, x long").parquet({str(tmp_path / "in")!r})
out = keyed.running_max_subarray(stream, "x", ["seq"], ["k"])
out.writeStream.format("parquet").option("path", {str(tmp_path / "out")!r}).option(
    "checkpointLocation", {str(tmp_path / "ckpt")!r}).trigger(availableNow=True).start().awaitTermination()
print("ROWS", sorted((r.seq, r.max_ending_here, r.max_subarray) for r in spark.read.parquet({str(tmp_path / "out")!r}).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=180)
    want = []
    for key in range(3):
        h = m = 0
        for k in range(key, 30, 3):
            h = max(0, h + (-1) ** k * k)
            m = max(m, h)
            want.append((k, h, m))
    assert f"ROWS {sorted(want)}" in done.stdout, done.stderr[-2000:]

import os

import pytest
from pyspark.sql import functions as F

from driftwood.operators import statistics
from driftwood.sources import arff, sinks, tail


def test_malformed_sparse_lines_have_defined_results(spark, tmp_path):
    spec = arff.ArffSpec("r", [arff.Attribute("x"), arff.Attribute("y"), arff.Attribute("z")])
    lines = ["{0 1.5, 0 2}", "{a 1}", "{1}", "{2 x, 1 4}", "{}", "1,2", "{0 1 9, 1 3}"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k long, value string")
    got = {r.k: (r.x, r.y, r.label) for r in df.select("k", *arff.arff_row_columns(F.col("value"), spec)).collect()}
    assert got == {0: (1.5, 0.0, 0.0), 1: (0.0, 0.0, 0.0), 2: (0.0, None, 0.0), 3: (0.0, 4.0, None), 4: (0.0, 0.0, 0.0),
                   5: (1.0, 2.0, None), 6: (1.0, 3.0, 0.0)}


def test_malformed_examples_and_text_features(spark):
    df = spark.createDataFrame([(0, "0 1:2,x:3"), (1, "0 y:1"), (2, "0 1:2,4"), (3, "1 01:5,1:6 2"), (4, "x :,3: q")], "k long, value string")
    got = {r.k: (r.label, r.features, r.weight) for r in df.select("k", *arff.example_columns(F.col("value"), "sparse")).collect()}
    assert got == {0: (0.0, {0: 2.0}, 1.0), 1: (0.0, {}, 1.0), 2: (0.0, {0: 2.0, 3: None}, 1.0), 3: (1.0, {0: 5.0}, 2.0),
                   4: (None, {2: None}, None)}
    df = spark.createDataFrame([(0, "k"), (1, "k:1,z"), (2, "a:1,a:2,b:x"), (3, ""), (4, ",,")], "k long, value string")
    got = {r.k: r.m for r in df.select("k", arff.text_feature_map(F.col("value")).alias("m")).collect()}
    assert got == {0: {"k": None}, 1: {"k": 1.0, "z": None}, 2: {"a": 1.0, "b": None}, 3: {}, 4: {}}


def test_anova_keeps_its_digits_at_large_means(spark):
    import random

    rng = random.Random(4)
    rows = [(0, 1e9 + rng.gauss(k % 3, 1.0), k % 3) for k in range(300)] + [(0, None, 1), (0, float("nan"), 2)]
    got = statistics.anova_f_test(spark.createDataFrame(rows, "feature int, value double, label int")).first()
    by = [[v - 1e9 for _, v, c in rows if c == k and v is not None and v == v] for k in range(3)]
    n = sum(map(len, by))
    grand = sum(map(sum, by)) / n
    means = [sum(b) / len(b) for b in by]
    between = sum(len(b) * (m - grand) ** 2 for b, m in zip(by, means)) / 2
    within = sum((v - m) ** 2 for b, m in zip(by, means) for v in b) / (n - 3)
    assert abs(got.f_stat - between / within) < 1e-4 * got.f_stat and (got.df_between, got.df_within) == (2, n - 3)


def _run(spark, base, **options):
    lines = tail.tail_lines(spark, f"{base}/in", **options)
    sinks.start_sink(lines, "parquet", path=f"{base}/out", checkpoint=f"{base}/ckpt").awaitTermination()
    return sorted((os.path.basename(r.file), r.at, r.value) for r in spark.read.parquet(f"{base}/out").collect())


def test_a_growing_file_is_read_once_and_resumes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    one, two = folder / "a.txt", folder / "b.txt"
    one.write_bytes("EXAMPLE;1\nQUERY;ü2\nEXAM".encode())
    assert [v for _, _, v in _run(spark, tmp_path, piece_bytes=7)] == ["EXAMPLE;1", "QUERY;ü2"]
    with open(one, "ab") as f:
        f.write(b"PLE;3\n\nEXAMPLE;4\n")
    two.write_bytes(b"".join(b"QUERY;%d\n" % k for k in range(500)))
    got = _run(spark, tmp_path, piece_bytes=64)  # a restart from the checkpoint
    assert [v for n, _, v in got if n == "a.txt"] == ["EXAMPLE;1", "QUERY;ü2", "EXAMPLE;3", "", "EXAMPLE;4"]
    assert [v for n, _, v in got if n == "b.txt"] == [f"QUERY;{k}" for k in range(500)]
    data = one.read_bytes()
    assert all(data[at:at + len(v.encode())] == v.encode() for n, at, v in got if n == "a.txt")
    assert _run(spark, tmp_path, piece_bytes=64) == got  # nothing new, nothing twice
    with open(two, "ab") as f:
        f.write(b"x" * 40 + b"\n")
    with pytest.raises(Exception, match="over 20"):
        _run(spark, tmp_path, max_line_bytes=20)


def test_pieces_own_the_lines_that_start_in_them(tmp_path):
    path = tmp_path / "f.txt"
    path.write_bytes(b"a\nbb\n\nccc\ndddddddd\ne\n")
    for size in range(1, 25):
        reader = tail.TailReader(str(path), 8, size)
        parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
        got = [v for p in parts for b in reader.read(p) for v in b.column(2).to_pylist()]
        assert got == ["a", "bb", "", "ccc", "dddddddd", "e"], size
    with pytest.raises(ValueError, match="shorter"):
        reader.partitions({"files": '{"%s": 99}' % path}, reader.latestOffset())

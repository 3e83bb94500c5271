"""Plans and states that must not grow with the table (findings of round 3)."""

import pytest
from pyspark.sql import functions as F

from driftwood.operators import substring as SS
from driftwood.plans import parallelism, scan
from driftwood.streaming import runner
from driftwood.streaming import substring as stream_substring
from driftwood.streaming.runner import StatefulBatches


def _rows(spark, rows):
    return spark.createDataFrame(rows, "kind string, seq long, id long, text string")


def test_substring_epochs_without_queries_search_nothing(spark, monkeypatch):
    """such an epoch only adds to the state."""
    def fail(*a, **k):
        raise AssertionError("searched")

    run = StatefulBatches(spark, stream_substring.substring_step(parts=8), "t-noq", append_state=True,
                          partition_by=stream_substring.PARTITIONS, file_batches=True, split_by="id")
    with monkeypatch.context() as m:
        m.setattr(SS, "substring_search", fail)
        run(_rows(spark, [("string", 1, 1, "abcdefgh"), ("string", 2, 2, "zzabcdzz")]), 0)
    assert run.output().count() == 0
    run(_rows(spark, [("query", 3, 9, "abcd"), ("string", 4, 4, "abcd")]), 1)
    assert sorted((r.q_seq, r.q_id, r.id) for r in run.output().collect()) == [(3, 9, 1), (3, 9, 2)]


def test_a_large_epochs_state_is_written_by_many_tasks(spark, monkeypatch):
    """a partition's rows are dealt to more tasks as the epoch grows."""
    monkeypatch.setattr(runner, "SPLIT_BYTES", 8)
    monkeypatch.setattr(runner, "PARTITIONS_OF_A_RUN", 4)
    run = StatefulBatches(spark, stream_substring.substring_step(parts=4), "t-split", append_state=True,
                          partition_by=stream_substring.PARTITIONS, file_batches=True, split_by="id")
    run(_rows(spark, [("string", i, i, "abcd" * 5) for i in range(60)]), 0)
    state = run._read_runs(run.runs(1))
    assert state.where("kind = 'gram'").count() == 60 * 17 and state.where("kind = 'text'").count() == 60
    one = state.where("kind = 'gram' and gram = 'abcd'")
    assert one.select("part").distinct().count() == 1 and one.select(F.input_file_name()).distinct().count() > 3


def test_spread_gives_the_number_of_partitions_beyond_the_cores(spark):
    """partitions that the session numbers are merged at run time, however many."""
    df, size = spark.range(1000), 10 * parallelism.BYTES_PER_PARTITION
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        many = parallelism.spread(df, "id", size=size)
        few = parallelism.spread(df, "id", size=1)
        assert many.rdd.getNumPartitions() == 10
        assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in many.collect()) == list(range(1000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("asof", [False, True])
def test_search_joins_hashes_of_grams(spark, asof):
    """postings are counted and joined as integers; the rows are those of a plain search."""
    texts = ["the cat sat on the mat", "a cat", "", None, "mat the cat sat", "xx the cat sat on the mat xx"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    asked = ["the cat", "sat on the mat", "never there", "cat sat", None]
    qs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(asked)], "q long, t string, at long")
    more = {"doc_seq": "id", "query_seq": "at"} if asof else {}
    hits = SS.substring_search(SS.substring_index(docs, "id", "s", 4), docs, "id", "s", qs, ["q"], "t", 4, **more)
    want = {(q, i) for q, t in enumerate(asked) for i, s in enumerate(texts) if t and s and t in s and not (asof and i >= 5)}
    assert sorted((r.q, r.id) for r in hits.collect()) == sorted(want)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Join " in line and "_g#" in line]
    assert keys and not any("(gram#" in line for line in plan.splitlines() if "Join " in line)


def test_range_buckets_are_searched_without_lambdas(spark):
    """the bucket of a row is compiled code, whatever the number of boundaries; nulls and ties as before."""
    rows = [(None if i % 7 == 0 else i // 3, i % 5, i) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, i long")
    key = F.struct(F.col("a").alias("k0"), F.col("b").alias("k1"))
    schema = "array<struct<k0:bigint,k1:bigint>>"
    for n in (1, 2, 3, 4, 7, 8, 9, 31):
        bounds = [(4 * j, j % 3) for j in range(1, n + 1)]
        both = scan.with_search_bucket(df, key, bounds, schema).withColumn("want", scan.search_bucket(key, bounds, schema))
        assert both.where(~F.col(scan.BUCKET).eqNullSafe(F.col("want"))).count() == 0, n
    got, nb = scan.add_range_bucket(df, ["i"], min_buckets=16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert nb == 16 and "lambda" not in plan and got.columns == [*df.columns, scan.BUCKET]
    sums = scan.running_sums(df, {"n": F.lit(1).cast("long"), "s": F.col("i")}, ["i"], min_buckets=16, inclusive=False)
    shuffled = [x for x in sums._jdf.queryExecution().executedPlan().toString().splitlines() if "RoundRobin" not in x and "_v_" in x and "Project" in x]
    assert [(r.n, r.s) for r in sums.orderBy("i").collect()] == [(i, i * (i - 1) // 2) for i in range(400)] and shuffled

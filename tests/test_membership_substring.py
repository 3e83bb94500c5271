import random

from pyspark.sql import functions as F

from driftwood.operators import membership as M
from driftwood.operators import substring as SS

_RNG = random.Random(11)
STRINGS = ["".join(_RNG.choice("pqrs") for _ in range(_RNG.randint(3, 14))) for _ in range(10)]


def test_bloom_no_false_negatives_and_fpp(spark):
    rng = random.Random(1)
    data = rng.sample(range(1_000_000), 1000)
    dset = set(data)
    queries = [q for q in range(0, 40000)]
    d = spark.createDataFrame([(v,) for v in data], "v long")
    q = spark.createDataFrame([(v,) for v in queries + data], "v long")
    bits = M.bloom_build(d, "v", 1000, 0.01)
    assert bits.count() <= M.bloom_size(1000, 0.01)[0]
    res = M.bloom_probe(bits, q, "v", ["v"], 1000, 0.01).collect()
    assert all(r.maybe for r in res if r.v in dset)  # no false negatives
    neg = [r for r in res if r.v not in dset]
    fp = sum(r.maybe for r in neg) / len(neg)
    assert fp <= 0.03
    for r in res[:50]:
        start = "MAYBE, filter probably contains " if r.maybe else "NO, filter definitely does not contain "
        assert r.answer == f"{start}{r.v}"


def test_bloom_string_values_and_merge(spark):
    a = spark.createDataFrame([("x",), ("y",)], "v string")
    b = spark.createDataFrame([("z",)], "v string")
    bits = M.bloom_merge(M.bloom_build(a, "v"), M.bloom_build(b, "v"))
    q = spark.createDataFrame([("x",), ("z",), ("y",)], "v string")
    assert all(r.maybe for r in M.bloom_probe(bits, q, "v", ["v"]).collect())
    assert M.bloom_bitmap(bits).count() >= 1


def test_bloom_asof_query_before_data(spark):
    data = spark.createDataFrame([(10, 5)], "seq long, v long")
    q = spark.createDataFrame([(1, 5, 3), (2, 5, 20)], "qid int, v long, qseq long")
    got = {r.qid: r.maybe for r in M.bloom_probe_asof(data, "v", "seq", q, "v", "qseq", ["qid"]).collect()}
    assert got == {1: False, 2: True}


def test_bloom_nulls_duplicate_ids_and_large_filters(spark, monkeypatch):
    data = spark.createDataFrame([(1, 5), (2, 2_147_483_652), (3, None)], "seq long, v long")
    q = spark.createDataFrame([(1, 5, 9), (1, 6, 9), (2, None, 9), (1, 5, 9), (4, 2_147_483_652, 1)], "id int, v long, s long")
    n, fpp = 50, 1e-8  # k is not capped: 27 hashes
    assert M.bloom_size(n, fpp)[1] == 27
    for limit in (M.LITERAL_BITS, 0):
        monkeypatch.setattr(M, "LITERAL_BITS", limit)
        monkeypatch.setattr(M, "LITERAL_FIRST", limit)
        bits = M.bloom_build(data, "v", n, fpp)
        got = sorted((r.id, r.maybe, r.answer) for r in M.bloom_probe(bits, q, "v", ["id"], n, fpp).collect())
        assert [(i, m) for i, m, _ in got] == [(1, False), (1, True), (1, True), (2, False), (4, True)]
        assert got[3][2] == "NO, filter definitely does not contain null"
        asof = M.bloom_probe_asof(data, "v", "seq", q, "v", "s", ["id"], n, fpp).collect()
        assert sorted((r.id, r.maybe) for r in asof) == [(1, False), (1, True), (1, True), (2, False), (4, False)]


def test_bloom_rate_on_the_tables(spark):
    cust = spark.read.parquet("/root/testdata/sf0.1/customer.parquet")
    members = cust.where("c_mktsegment = 'MACHINERY'")
    n = M.distinct_values(members, "c_custkey")
    got = M.bloom_probe(M.bloom_build(members, "c_custkey", n), cust, "c_custkey", ["c_custkey", "c_mktsegment"], n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # bits are tested in place
    rows = got.groupBy("c_mktsegment").agg(F.avg(F.col("maybe").cast("double")).alias("p")).collect()
    rate = {r.c_mktsegment: r.p for r in rows}
    assert rate.pop("MACHINERY") == 1 and max(rate.values()) <= 0.03


def _search(spark, strings, queries, q=4, seqs=None):
    docs = spark.createDataFrame([(i, s, (seqs or {}).get(i, i)) for i, s in enumerate(strings)],
                                 "id int, s string, dseq long")
    qs = spark.createDataFrame([(j, t, 10 ** 9) for j, t in enumerate(queries)], "qid int, t string, qseq long")
    idx = SS.substring_index(docs, "id", "s", q)
    hits = SS.substring_search(idx, docs, "id", "s", qs, ["qid"], "t", q)
    lists = {r.qid: r.ids for r in SS.substring_search_lists(hits, ["qid"]).collect()}
    return [lists.get(j, []) for j in range(len(queries))]


def test_substring_search_matches_brute_force(spark):
    strings = STRINGS * 3 + ["pq", "", "p"]
    queries = [STRINGS[0][:3], STRINGS[1][1:5], "pp", "q", "", STRINGS[2] + "x", STRINGS[3], STRINGS[4][-5:], "zz"]
    got = _search(spark, strings, queries)
    for qs, ids in zip(queries, got):
        assert ids == [i for i, s in enumerate(strings) if qs in s], qs


def test_substring_index_positions(spark):
    docs = spark.createDataFrame([(7, "abcde")], "id int, s string")
    got = sorted((r.gram, r.pos) for r in SS.substring_index(docs, "id", "s", 3).collect())
    assert got == [("abc", 1), ("bcd", 2), ("cde", 3)]


def test_bloom_blocks(spark):
    """Blocked filters: no false negatives, a rate within three times the target, no k rows a query."""
    n, fpp = 20_000, 0.01  # 6 blocks
    data = spark.range(n).select(F.col("id").alias("v"), (F.col("id") * 2).alias("seq"))
    bits = M.bloom_build(data, "v", n, fpp, blocked=True)
    assert bits.count() == -(-M.bloom_size(n, fpp)[0] // M.BLOCK_BITS)
    halves = M.bloom_merge(M.bloom_build(data.filter("v < 9000"), "v", n, fpp, blocked=True), M.bloom_build(data.filter("v >= 9000"), "v", n, fpp, blocked=True))
    assert {(r.block, bytes(r.bits)) for r in halves.collect()} == {(r.block, bytes(r.bits)) for r in bits.collect()}
    q = spark.range(3 * n).select(F.col("id").alias("v"), F.lit(n).alias("qs"))
    probed = M.bloom_probe(bits, q, "v", ["v"], n, fpp)
    plan = probed._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "Generate" not in plan.split("Join")[-1].split("Aggregate")[0]  # only the filter's side explodes
    got = {r.v: r.maybe for r in probed.collect()}
    assert len(got) == 3 * n and all(got[v] for v in range(n))
    assert sum(got[v] for v in range(n, 3 * n)) / (2 * n) <= 3 * fpp
    # as of: exactly the filter of the values that came earlier
    seen = M.bloom_build(data.filter(f"seq < {n}"), "v", n, fpp, blocked=True)
    want = {r.v: r.maybe for r in M.bloom_probe(seen, q, "v", ["v"], n, fpp).collect()}
    assert {r.v: r.maybe for r in M.bloom_probe_asof(data, "v", "seq", q, "v", "qs", ["v"], n, fpp, blocked=True).collect()} == want
    parts = [M.bloom_first_seen(data.filter(c), "v", "seq", n, fpp, blocked=True) for c in ("v % 2 = 0", "v % 2 = 1")]
    split = M.probe_first_seen(M.merge_first_seen(*parts), q, "v", "qs", ["v"], n, fpp)
    assert {r.v: r.maybe for r in split.collect()} == want

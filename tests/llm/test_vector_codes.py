import hashlib
import math
import random

import numpy as np
import pytest

from driftwood.llm import vector_codes as vc

INF = float("inf")


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain loops over Python integers: {row number: (code, error)}, label errors, digest."""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1]))
    size = len(order[0][1]) // parts
    cut = lambda v, p: v[p * size:(p + 1) * size]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]

    def near(v, p):
        return min((far(cut(v, p), c), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            of = [near(v, p)[1] for _, v, _ in kept]
            new.append([[sum(col) // len(col) for col in zip(*[cut(v, p) for (_, v, _), o in zip(kept, of) if o == k])] or c
                        for k, c in enumerate(books[p])])
        books = new
    codes = [(i, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)), sum(near(v, p)[0] for p in range(parts)), lab) for i, v, lab in kept]
    total = {}
    for _, _, e, lab in codes:
        total[lab] = total.get(lab, 0) + e
    text = ",".join(str(x) for b in books for c in b for x in c)
    return sorted(((i, c, e, total[lab], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, lab in codes), key=str)


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return df.withColumn("v", F.lit("clash")).withColumn("code", F.lit(1)).withColumn("slot", F.lit(2)).repartition(5)


def as_rows(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dim, spread, seed=1):
    rng = random.Random(seed)
    return [[float(np.float32(rng.uniform(-spread, spread))) for _ in range(dim)] for _ in range(n)]


@pytest.mark.parametrize("bits", [10, 24, 27])
def test_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    top = 1 << bits
    x, c = rng.integers(-top + 1, top, (40, 16)), rng.integers(-top + 1, top, (30, 16))
    x[0], c[0] = top - 1, 1 - top
    want = [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in c] for r in x]
    assert vc.exact_dots(x, c).tolist() == want
    width = vc.limb_bits(16)
    assert 16 * (1 << 2 * width) <= 1 << 53
    assert len(vc.limbs(x, width)) == (1 if bits < 25 else 2)
    back = sum(part.astype(np.int64) << (width * k) for k, part in enumerate(vc.limbs(x, width)))
    assert (back == x).all()
    k, d = vc.nearest(x, c)
    for row, at, dist in zip(x.tolist(), k, d):
        far = [sum((a - b) ** 2 for a, b in zip(row, s)) for s in c.tolist()]
        assert (min(far), far.index(min(far))) == (dist, at)


def test_report_equals_loops(spark):
    rows = [(k, v, k % 3) for k, v in enumerate(vectors(120, 8, 2.0))]
    rows += [(200, rows[3][1], None), (201, rows[3][1], None), (5, rows[5][1], 2), (5, rows[6][1], 2), (None, rows[7][1], 1),
             (-1, [0.5, None] + [0.0] * 6, 1), (-2, [float("nan")] + [0.0] * 7, 1), (-3, [INF] + [1.0] * 7, 1),
             (-4, [-INF] + [1.0] * 7, 1), (-5, None, 1), (300, [0.0] * 8, 9)]
    got = as_rows(vc.code_report(frame(spark, rows), entries=16))
    assert got == brute(rows, entries=16)
    # many labels: the salted join
    assert as_rows(vc.code_report(frame(spark, rows), entries=16, broadcast_rows=1)) == got


def test_ties_take_the_lower_index_and_large_numbers_stay_exact(spark):
    same = [1.0, -2.0, 0.25, 7.0]
    rows = [(k, same, 0) for k in range(9)]
    assert {r[1] for r in as_rows(vc.code_report(frame(spark, rows)))} == {"00000000"}
    big = [(k, v, k) for k, v in enumerate(vectors(40, 64, 120_000.0))]  # two limbs
    assert as_rows(vc.code_report(frame(spark, big), entries=8, rounds=2)) == brute(big, entries=8, rounds=2)
    with pytest.raises(Exception, match="exact 64-bit"):
        vc.code_report(frame(spark, [(1, [3e5] * 64, 0)])).collect()


def test_odd_tables(spark):
    assert vc.code_report(frame(spark, []).where("false")).collect() == []
    assert vc.code_report(frame(spark, [(1, None, 1), (2, [float("nan")] * 4, 1)])).collect() == []
    only = as_rows(vc.code_report(frame(spark, [(None, [1.0] * 4, 1)])))
    assert only[0][:4] == (None, None, None, None)
    mixed = [(1, [1.0] * 4, 0), (2, [2.0] * 8, 0), (3, [1.5] * 4, 0), (4, [], 0)]
    got = {r[0]: r[1:3] for r in as_rows(vc.code_report(frame(spark, mixed)))}
    assert got == {1: ("00000000", 0), 2: (None, None), 3: ("01010101", 0), 4: (None, None)}
    with pytest.raises(ValueError, match="equal parts"):
        vc.train(frame(spark, [(1, [1.0] * 6, 0)]))

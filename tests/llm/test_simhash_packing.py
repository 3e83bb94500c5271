import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftwood.llm import packing, simhash, training_order
from driftwood.llm.components import components
from driftwood.llm.tokens import bpe, default_paths
from tests.llm.conftest import ODD


def brute_fingerprint(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_brute_force(docs_of):
    texts = [t for _, t in ODD] + ["A b\tC\x0bd e  f", "É é É", "one two", "a b c d e f g h i j " * 40]
    for t in texts:
        if len(t or "") < 10_000:
            assert simhash.fingerprint(t) == brute_fingerprint(t), t
    long = " ".join(str(k % 977) for k in range(5000))
    assert simhash.fingerprint(long, chunk=100) == simhash.fingerprint(long) == brute_fingerprint(long)


def brute_components(fps, bits):
    values = sorted(set(fps))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("limit,bits", [(64, 2), (1, 2), (3, 2), (2, 1), (64, 0)])
def test_links_match_brute_force(spark, limit, bits):
    rng = random.Random(limit * 10 + bits)
    values = set()
    for _ in range(25):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    signed = [v - (1 << 64) if v >> 63 else v for v in values] + [0, -1]
    fps = spark.createDataFrame([(v,) for v in set(signed)], "fp bigint")
    got = {(r.a, r.b) for r in simhash.links(fps, bits, cell_limit=limit).collect()}
    s = sorted(set(signed))
    expected = {(a, b) for i, a in enumerate(s) for b in s[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert got == expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_and_odd_rows(docs_of):
    text = " ".join(f"w{k}" for k in range(400))
    rows = [(50, text), (20, text), (30, text.upper()), (40, "something else altogether here now"), *ODD]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert {c for d in (20, 30, 50) for _, c in by[d]} == {20}
    assert by[1] == by[2] == by[3] == {("0" * 16, 1)}
    fps = [int(r.fingerprint, 16) for r in got]
    assert {r.doc_id: r.fingerprint for r in got if r.doc_id == 40}[40] == f"{brute_fingerprint(rows[3][1]):016x}"
    roots = brute_components(fps, 2)
    groups = defaultdict(set)
    for r in got:
        groups[roots[int(r.fingerprint, 16)]].add(r.doc_id)
    for r in got:
        ids = [d for d in groups[roots[int(r.fingerprint, 16)]] if d is not None]
        assert r.component_id == (min(ids) if ids else None)
    assert simhash.near_duplicates(docs_of(rows).limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(docs_of(rows))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs_of(rows).columns and ids.count(4) == 1 and {20, 40, 1} <= set(ids) and not {30, 50, 2, 3} & set(ids)
    assert ids.count(None) == 2  # rows without an id stay


def test_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    exact, own = Tokenizer.from_file(default_paths()[0]), bpe(default_paths())
    rng = random.Random(2)
    alphabet = "aé ß'sll\n\t   　\x85\x1c.1²Ⅷ漢🙂<|endoftext|>"
    texts = [t or "" for _, t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["a <|endoftext|> b", "  two  spaces  ", "\n\n x", "it's we'll I'D"]
    for t in texts:
        assert own.ids(t) == exact.encode(t, add_special_tokens=False).ids, t


def check_pieces(rows, lengths):
    """Every id lies in one piece; sequences are gapless and need no padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0
    for d, n in lengths.items():
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == n
            at += p["length"]
        assert at == n


def test_packing_is_whole(docs_of):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "zz9"]) for _ in range(int(rng.paretovariate(0.7) * 20) % 9000)))
            for k in range(300)] + [(1000, None), (1001, ""), (1002, ODD[-1][1])]
    encode = bpe(default_paths()).ids
    for max_open in (2048, 3):
        got = [r.asDict() for r in packing.pack(docs_of(rows).repartition(3), max_open=max_open, with_ids=True).collect()]
        ids = {d: np.array(encode(t or "") + [0], dtype="<u4") for d, t in rows}
        check_pieces(got, {d: len(x) for d, x in ids.items()})
        for p in got:
            own = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]].tobytes()
            assert p["ids"] == own and p["ids_crc32"] == zlib.crc32(own)
    assert packing.pack(docs_of(rows).limit(0)).count() == 0
    assert sum(r.length for r in packing.pack(docs_of(ODD)).collect()) == sum(len(encode(t or "")) + 1 for _, t in ODD)


def test_packing_takes_the_level_of_least_squares():
    rng = random.Random(9)
    p = packing.Packer(32, 10_000, 0)
    for k in range(400):
        size = rng.randint(1, 31)
        counts = {h: len(w) for h, w in p.open.items() if w}

        def squares(h):
            c = dict(counts)
            if h:
                c[h] -= 1
            if h + size < 32:
                c[h + size] = c.get(h + size, 0) + 1
            return sum(v * v for v in c.values())

        options = [0] + [h for h, v in counts.items() if v and h + size <= 32]
        level = p._level(size)
        assert level in options and squares(level) == min(map(squares, options))
        p.add(k, np.zeros(size, dtype="<u4"))


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 10, 1000, 4097):
        p = training_order.Permutation(n, key=n)
        y = p(np.arange(n))
        assert sorted(y) == list(range(n)) and (p.inverse(y) == np.arange(n)).all()
    wide = training_order.Permutation(3_000_000 << 32, 1)
    x = np.arange(0, 1 << 40, (1 << 40) // 999)
    assert (wide.inverse(wide(x)) == x).all()
    with pytest.raises(ValueError):
        training_order.Permutation(1000, 1)(np.arange(1000, 1024))
    assert (training_order.Permutation(1000, 1)(np.arange(1000)) != training_order.Permutation(1000, 2)(np.arange(1000))).any()


def test_training_order_round_trip(docs_of, spark, tmp_path):
    rng = random.Random(6)
    rows = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(300)))) for k in range(120)] + ODD[:8]
    df = docs_of(rows).coalesce(3)
    path = str(tmp_path / "order")
    training_order.write_shards(df, path, length=128, shards=5, block=4)
    all_rows = sorted(training_order.read_slots(spark, path).collect(), key=lambda r: r.slot)
    assert [r.slot for r in all_rows] == list(range(len(all_rows)))
    encode = bpe(default_paths()).ids
    assert sum(r.n_ids for r in all_rows) == sum(len(encode(t or "")) + 1 for _, t in rows)
    assert sum(r.n_ids < 128 for r in all_rows) <= 3  # only a task's last sequence is padded
    ids = {d: encode(t or "") + [0] for d, t in rows}
    for r in all_rows:
        own = ids[r.first_doc][r.first_start:r.first_start + 128][:r.n_ids]
        assert r.ids[:len(own)] == own
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids[:r.n_ids], dtype="<u4").tobytes())
    # a sequence's slot is the image of its dense number under the permutation of 0 .. N-1
    tasks = {}
    for r in df.withColumn("p", F.spark_partition_id()).collect():
        tasks.setdefault(r.p, []).extend(encode(r.text or "") + [0])
    dense = [run[k:k + 128] for _, run in sorted(tasks.items()) for k in range(0, len(run), 128)]
    slots = training_order.Permutation(len(all_rows), 42)(np.arange(len(dense)))
    assert len(dense) == len(all_rows) and all(all_rows[s].ids[:all_rows[s].n_ids] == ids for s, ids in zip(slots, dense))
    assert {r.slot - r.place for r in all_rows} == {k * -(-len(dense) // 5) for k in range(5)}
    part = sorted(training_order.read_slots(spark, path, 37, 81).collect(), key=lambda r: r.slot)
    assert part == all_rows[37:81]
    again = str(tmp_path / "again")
    training_order.write_shards(df, again, length=128, shards=5, block=4)
    assert sorted(training_order.read_slots(spark, again).collect(), key=lambda r: r.slot) == all_rows
    assert training_order.order_report(df.limit(0)).count() == 0


def test_near_duplicates_of_one_id_are_dropped_row_by_row(docs_of):
    text, other, third = (" ".join(f"{c}{k}" for k in range(400)) for c in "abc")
    rows = [(1, text), (7, text.upper()), (7, other), (7, other), (7, third), (9, third), (None, text)]
    kept = [(r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs_of(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(1, text), (7, other), (7, third), (None, text)], key=str)

"""Bloom-filter membership (D1-D3) as table operators.

A filter is the table of its set bit positions ``(pos)``: at most ``m``
rows, where ``m = floor(-n ln p / ln^2 2)`` is fixed by the parameters.
Partial filters combine by OR (union + distinct).  ``bloom_bitmap`` gives the
compact sharded form ``(shard, bits binary)`` built with Spark's bitmap aggregates.

Positions come from double hashing with two 60-bit parts of the MD5 of the
value's text, ``(h1 + i h2) mod m`` for i < k, so any type, any ``m`` below 2^57 and any ``k``
work.  Guarantees: no false negatives; false-positive rate about ``fpp`` for ``n``
distinct values.  ``distinct_values`` gives the ``n`` to size a filter for a table.

Probing needs no shuffle while the filter is small: up to ``LITERAL_BITS`` bits
(``LITERAL_FIRST`` first arrivals) go into the plan as one array literal and
every row tests its bits in place.  Larger filters are blocked: a value's bits
all lie in one block of ``BLOCK_BITS``, a filter is the table ``(block, bits)`` of
Spark bitmaps, and a probe shuffles one row a query, on its block.  The k positions of a
value only exist inside a task.  Blocks hold about 3,400 values at 1 %, so their
loads differ by a few per cent and the rate stays near ``fpp``.  First arrivals
in blocks are kept as one row per distinct value ``(block, step_a, step_b, first_seq)``.
A null value is never inserted, and is answered NO.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.plans import scan

#: Size bounds of the in-plan filters: 2 MB of bits, 2 MB of arrival numbers.
LITERAL_BITS, LITERAL_FIRST = 1 << 24, 1 << 18
#: Bits of a block: those of one Spark bitmap (4 KB).
BLOCK_BITS = 1 << 15
#: What places a value in a blocked filter.
_PLACE = ["block", "step_a", "step_b"]


def bloom_size(n: int = 1000, fpp: float = 0.01) -> tuple[int, int]:
    """(m bits, k hashes) for ``n`` expected insertions at false-positive rate ``fpp``."""
    m = max(1, int(-n * math.log(fpp) / (math.log(2) ** 2))) if n > 0 else 1
    return m, max(1, int(round(m / max(1, n) * math.log(2))))


def distinct_values(df: DataFrame, col: str) -> int:
    """Number of distinct non-null values: what a filter of the column holds."""
    return df.agg(F.countDistinct(col)).first()[0]


def bloom_positions(value: Column, m: int, k: int) -> Column:
    """Array of the ``k`` bit positions of a value (null for null)."""
    digest = F.md5(value.cast("string").cast("binary"))

    def part(at: int) -> Column:
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") % F.lit(m).cast("bigint")

    # every step stays below 2 m, whatever k is
    pair = F.struct(part(1).alias("a"), part(16).alias("b"))
    walk = F.transform(F.array(pair), lambda p: F.aggregate(
        F.sequence(F.lit(1), F.lit(k)), F.struct(p["a"].alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda acc, _: F.struct(((acc["at"] + p["b"]) % F.lit(m).cast("bigint")).alias("at"),
                                F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"]))
    return F.when(value.isNotNull(), F.get(walk, 0))


def _place(value: Column, m: int) -> list[Column]:
    """``block, step_a, step_b`` of a value: its bits are ``(step_a + i step_b) mod BLOCK_BITS`` of that block."""
    digest = F.md5(value.cast("string").cast("binary"))

    def part(at: int, digits: int) -> Column:
        return F.conv(F.substring(digest, at, digits), 16, 10).cast("bigint")

    blocks = -(-m // BLOCK_BITS)
    return [(part(1, 14) % F.lit(blocks).cast("bigint")).alias("block"), (part(15, 8) % BLOCK_BITS).alias("step_a"),
            (part(23, 8).bitwiseOR(F.lit(1).cast("bigint")) % BLOCK_BITS).alias("step_b")]  # odd: k different bits


def _block_bits(k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.col("step_a") + i * F.col("step_b")) % BLOCK_BITS)


def bloom_build(df: DataFrame, col: str, n: int = 1000, fpp: float = 0.01, blocked: bool | None = None) -> DataFrame:
    """The filter holding ``df[col]``: set positions ``(pos)``, or blocks ``(block, bits)`` if ``blocked``
    (None: above ``LITERAL_BITS``)."""
    m, k = bloom_size(n, fpp)
    if not (m > LITERAL_BITS if blocked is None else blocked):
        return df.select(F.explode(bloom_positions(F.col(col), m, k)).alias("pos")).distinct()
    placed = df.filter(F.col(col).isNotNull()).select(*_place(F.col(col), m))
    # partial bitmaps of 4 KB are shuffled, not positions
    return (placed.select("block", F.explode(_block_bits(k)).alias("_p"))
            .groupBy("block").agg(F.bitmap_construct_agg("_p").alias("bits")))


def bloom_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Partial filters combine by OR."""
    both = a.unionByName(b)
    return both.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")) if "block" in a.columns else both.distinct()


def bloom_bitmap(bits: DataFrame) -> DataFrame:
    """Compact form ``(shard, bits)`` of set positions: 32768-bit chunks via Spark's bitmap aggregates."""
    p = F.col("pos") + 1  # bitmap positions are 1-based
    return (bits.groupBy(F.bitmap_bucket_number(p).alias("shard"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(p)).alias("bits")))


def _bit_words(bits: DataFrame, m: int) -> Column:
    """The filter as an array literal of 62-bit words."""
    words = [0] * (m // 62 + 1)
    rows = bits.groupBy(F.expr("pos div 62").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pos % 62 as int))")).alias("b"))
    for r in rows.collect():  # at most m / 62 rows
        words[r["w"]] = r["b"]
    return F.from_json(F.lit(json.dumps(words)), "array<bigint>")


def answer(maybe: Column, value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit("null"))
    return F.when(maybe, F.concat(F.lit("MAYBE, filter probably contains "), text)).otherwise(
        F.concat(F.lit("NO, filter definitely does not contain "), text))


def _answered(df: DataFrame, id_cols: Sequence[str], col: str) -> DataFrame:
    maybe = F.coalesce(F.col("_maybe"), F.lit(False))
    return df.select(*id_cols, maybe.alias("maybe"), answer(maybe, F.col(col)).alias("answer"))


def _placed(queries: DataFrame, col: str, m: int) -> DataFrame:
    """Queries with their place as ``_block, _step_a, _step_b``; null for null."""
    return queries.select("*", *[F.when(F.col(col).isNotNull(), c).alias(f"_{n}") for n, c in zip(_PLACE, _place(F.col(col), m))])


def _probe_blocks(bits: DataFrame, queries: DataFrame, col: str, m: int, k: int) -> DataFrame:
    """``_maybe``: one row a query meets its block; bit p is bit p mod 8 of byte p div 8."""
    blocks = bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))

    def is_set(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    met = _placed(queries, col, m).join(blocks, "_block", "left")
    inside = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.col("_step_a") + i * F.col("_step_b")) % BLOCK_BITS)
    return met.withColumn("_maybe", F.when(F.col("_bits").isNotNull(), F.forall(inside, is_set)))


def _complete_at(first: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``(place..., complete_at)`` per asked place: the arrival that set the last of its k bits.

    Rows ``(place..., first_seq)`` and asked places meet by block, one row a distinct value on
    either side; a task goes through its blocks one after the other with one array of a block's first arrivals.
    """
    never = np.iinfo(np.int64).max
    rows = first.select(*_PLACE, F.col("first_seq").cast("bigint").alias("first_seq"), F.lit(0).alias("_ask")).unionByName(
        asked.select(*_PLACE, F.lit(None).cast("bigint").alias("first_seq"), F.lit(1).alias("_ask")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrivals, current = np.full(BLOCK_BITS, never), None
        steps = np.arange(k, dtype=np.int64)
        for batch in batches:
            block, a, b, ask = (batch.column(c).to_numpy(zero_copy_only=False) for c in (*_PLACE, "_ask"))
            seq = batch.column("first_seq").fill_null(never).to_numpy(zero_copy_only=False)
            bits = (a[:, None] + steps * b[:, None]) % BLOCK_BITS
            done = np.full(len(block), never)
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(ask) != 0)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(block)]):
                if s == e:
                    continue
                if block[s] != current:
                    arrivals[:], current = never, block[s]
                if ask[s]:
                    done[s:e] = arrivals[bits[s:e]].max(axis=1)
                else:
                    np.minimum.at(arrivals, bits[s:e].ravel(), np.repeat(seq[s:e], k))
            keep = pa.array(ask == 1)
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in _PLACE), pa.array(done)], names=[*_PLACE, "complete_at"])
            yield out.filter(keep)

    dealt = rows.repartition("block").sortWithinPartitions("block", "_ask")
    answers = dealt.mapInArrow(run, "block bigint, step_a bigint, step_b bigint, complete_at bigint")
    return answers.filter(F.col("complete_at") < F.lit(never))


def bloom_probe(bits: DataFrame, queries: DataFrame, col: str, id_cols: Sequence[str],
                n: int = 1000, fpp: float = 0.01) -> DataFrame:
    """``(id..., maybe, answer)`` per row; ``maybe`` is true iff all k bits are set."""
    m, k = bloom_size(n, fpp)
    q = queries.select(*dict.fromkeys([*id_cols, col]))
    if "block" not in bits.columns:
        positions = bloom_positions(F.col(col), m, k)
        words = _bit_words(bits, m)
        found = q.withColumn("_ps", positions).withColumn("_maybe", F.forall("_ps", lambda p: F.call_function(
            "shiftright", F.get(words, F.floor(p / 62).cast("int")), (p % 62).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1))
    else:
        found = _probe_blocks(bits, q, col, m, k)
    return _answered(found, id_cols, col)


def bloom_first_seen(df: DataFrame, col: str, seq: str, n: int = 1000, fpp: float = 0.01,
                     blocked: bool | None = None) -> DataFrame:
    """First arrivals: per bit ``(pos, first_seq)``, or per value ``(block, step_a, step_b, first_seq)`` if
    ``blocked`` (None: above ``LITERAL_FIRST``)."""
    m, k = bloom_size(n, fpp)
    if m > LITERAL_FIRST if blocked is None else blocked:
        placed = df.filter(F.col(col).isNotNull()).select(*_place(F.col(col), m), F.col(seq).alias("_s"))
        return placed.groupBy(*_PLACE).agg(F.min("_s").alias("first_seq"))
    return (df.select(F.col(seq).alias("_s"), F.explode(bloom_positions(F.col(col), m, k)).alias("pos"))
            .groupBy("pos").agg(F.min("_s").alias("first_seq")))


def merge_first_seen(a: DataFrame, b: DataFrame) -> DataFrame:
    """First arrivals of two parts of the data combine by minimum."""
    return a.unionByName(b).groupBy(*[c for c in a.columns if c != "first_seq"]).agg(F.min("first_seq").alias("first_seq"))


def probe_first_seen(first: DataFrame, queries: DataFrame, col: str, seq: str, id_cols: Sequence[str],
                     n: int = 1000, fpp: float = 0.01) -> DataFrame:
    """D3 against a table of first arrivals: all k bits were set before ``seq``."""
    m, k = bloom_size(n, fpp)
    q = queries.select(*dict.fromkeys([*id_cols, col]), F.col(seq).alias("_qs"))
    if "block" not in first.columns:
        positions = bloom_positions(F.col(col), m, k)
        seen: list = [None] * m
        for r in first.collect():  # at most m rows
            seen[r["pos"]] = r["first_seq"]
        array = F.from_json(F.lit(json.dumps(seen)), "array<bigint>")
        found = q.withColumn("_ps", positions).withColumn("_maybe", F.forall("_ps", lambda p: F.coalesce(
            F.get(array, p.cast("int")) < F.col("_qs"), F.lit(False))))
    else:
        # a value asked many times is answered once; its rows meet the answer by value
        own = [f"_{c}" for c in _PLACE]
        placed = _placed(q, col, m)
        asked = placed.filter(F.col(col).isNotNull()).select(*[F.col(f"_{c}").alias(c) for c in _PLACE]).distinct()
        done = _complete_at(first, asked, k).select(*[F.col(c).alias(f"_{c}") for c in _PLACE], "complete_at")
        found = scan.null_safe_join(placed, done, own, "left").withColumn("_maybe", F.col("complete_at") < F.col("_qs"))
    return _answered(found, id_cols, col)


def bloom_probe_asof(data: DataFrame, data_col: str, data_seq: str, queries: DataFrame,
                     query_col: str, query_seq: str, id_cols: Sequence[str], n: int = 1000,
                     fpp: float = 0.01, blocked: bool | None = None) -> DataFrame:
    """D3: a query sees only data that arrived before it (``first_seq < query seq``)."""
    return probe_first_seen(bloom_first_seen(data, data_col, data_seq, n, fpp, blocked), queries, query_col, query_seq,
                            id_cols, n, fpp)

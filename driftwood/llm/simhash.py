"""SimHash near-duplicates by segment-popcount embedding (operator 2).

1. Fingerprint: XXH64 (seed 42) of every word shingle; a bit of the fingerprint
   is 1 if it is set in more than half of the hashes.
2. Embedding: a fingerprint's 16 segments of 4 bits become their bit counts, a
   point of {0..4}^16.  A differing bit moves one count by one, so the Manhattan
   distance of two points is a lower bound of the bit distance.
3. Grid range join: two points at Manhattan distance 2 or less have a common
   grid point within distance 1 of both.  So every distinct fingerprint goes
   to its own cell and the cells one step away (33 at most), and only
   fingerprints that share a cell can be near.
4. Exact check inside a cell: pairs of at most ``cell_limit`` fingerprints are
   compared by the bits of their XOR.  A fuller cell is parted further, not cut
   off: fingerprints within 2 bits have a common neighbour within 1 bit, so its
   members go to the 65 keys (itself, one bit turned), and a key has 65 members
   at most.  So no group of candidates grows with the data.
5. Components of the links among distinct fingerprints, then back to documents.

Copies share a fingerprint and are grouped before any join, so thousands of
copies count as one point.  Nothing but round counters reaches the driver.

Defined results: a null or word-free text has fingerprint 0 and is linked like
any other; repeated rows give one row each; ``component_id`` is the least
non-null id reachable (null if there is none); empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import row_key, text_rows, written
from driftwood.llm.components import components

SEGMENTS, SEGMENT_BITS, SEED = 16, 4, 42


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 255 * 255  # sums of 255 zeros and ones fit a byte
    total = bits[full:].sum(axis=0, dtype=np.uint8).astype(np.int64)
    if full:
        total += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int = 3, chunk: int = 1 << 16) -> int:
    """64-bit SimHash (unsigned) of a text's word shingles."""
    from xxhash import xxh64_intdigest as h

    # bytes.split() cuts at space and 0x09-0x0D, bytes.lower() turns A-Z only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, chunk):
        part = words[at:at + min(chunk, n - at) + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        counts += _bit_counts(np.array([h(b" ".join(g), SEED) for g in grams], dtype=np.uint64))
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 rows: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (bigint with the fingerprint's bits) of every row; with ``rows`` its ``row`` (hash of id and text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])

    texts = text_rows(df, id_col, text_col)
    if rows:
        return texts.withColumn("row", row_key()).mapInArrow(run, "doc_id bigint, fp bigint, row bigint")
    return texts.mapInArrow(run, "doc_id bigint, fp bigint")


def _segment_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, k * SEGMENT_BITS).bitwiseAND(F.lit(15).cast("bigint")))
            for k in range(SEGMENTS)]


def grid(fps: DataFrame, radius: int) -> DataFrame:
    """(cell, fp): each fingerprint in the cells within ``radius`` (0 or 1) steps.

    A cell is the point with 3 bits a count.
    """
    counted = fps.select("fp", *[c.cast("bigint").alias(f"c{k}") for k, c in enumerate(_segment_counts(F.col("fp")))])
    home = sum((F.shiftleft(F.col(f"c{k}"), 3 * k) for k in range(1, SEGMENTS)), F.col("c0"))
    counted = counted.withColumn("home", home)
    steps = []
    for k in range(SEGMENTS if radius else 0):
        one = F.lit(1 << (3 * k)).cast("bigint")
        steps += [F.when(F.col(f"c{k}") < SEGMENT_BITS, F.col("home") + one),
                  F.when(F.col(f"c{k}") > 0, F.col("home") - one)]
    return counted.select(F.explode(F.array(F.col("home"), *steps)).alias("cell"), "fp").where("cell is not null")


def _pairs(groups: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs (a < b) inside bounded lists ``fps``."""
    each = groups.select(F.explode("fps").alias("a"), "fps")
    near = F.filter("fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= max_bits))
    return each.select("a", F.explode(near).alias("b"))


def links(fps: DataFrame, max_bits: int = 2, cell_limit: int = 64) -> DataFrame:
    """Distinct pairs (a, b) of distinct fingerprints ``fp`` within ``max_bits`` bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the grid of one step reaches at most 2 differing bits")
    cells = grid(fps, 1 if max_bits else 0)
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    near = written(cells.join(shared, "cell"), "simhash-cells")
    small = near.where(F.col("n") <= cell_limit).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
    dense = near.where(F.col("n") > cell_limit).select("fp").distinct()
    turned = [F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("bigint")) for k in range(64)]
    keys = dense.select(F.explode(F.array(F.col("fp"), *turned)).alias("key"), "fp")
    shared_keys = keys.groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return _pairs(small, max_bits).unionAll(_pairs(shared_keys, max_bits)).distinct()


def _grouped(docs: DataFrame, max_bits: int, cell_limit: int) -> DataFrame:
    """``docs`` (doc_id, fp, row) with ``least``: doc_id and row of the first row of the group (null if none has an id)."""
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row")))
    fps = written(docs.groupBy("fp").agg(first.alias("least")), "simhash-fps")
    roots = components(links(fps.select("fp"), max_bits, cell_limit))
    # only fingerprints with a link to another one have a root
    linked = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("first"))
    named = written(linked.join(least, "root").select(F.col("fp").alias("_fp"), F.col("first").alias("least")), "simhash-roots")
    return docs.join(named, docs.fp == named._fp).drop("_fp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, cell_limit: int = 64) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    docs = written(fingerprints(df, id_col, text_col, shingle).withColumn("row", F.lit(0).cast("bigint")), "simhash-docs")
    return _grouped(docs, max_bits, cell_limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2, cell_limit: int = 64) -> DataFrame:
    """One row (the least id's) of each group, all columns; rows without an id stay. Rows are told apart by id and text."""
    docs = written(fingerprints(df, id_col, text_col, shingle, rows=True), "simhash-docs")
    found = _grouped(docs, max_bits, cell_limit).where("doc_id is not null")
    first = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("row") == F.col("least.row"))
    gone = found.where(~first).select(F.col("doc_id").alias("_gone"), F.col("row").alias("_gone_row")).distinct()
    mine, own = F.col(f"`{id_col}`").cast("bigint"), row_key(id_col, text_col)
    left = df.join(gone, (mine == F.col("_gone")) & (own == F.col("_gone_row")), "left_anti")
    twice = written(found.where(first).groupBy("doc_id", "row").count().where("count > 1").select(
        F.col("doc_id").alias("_twice"), F.col("row").alias("_twice_row")), "simhash-repeated")
    if twice.isEmpty():
        return left
    repeated = (mine == F.col("_twice")) & (own == F.col("_twice_row"))
    once = left.join(twice, repeated, "left_semi").withColumn("_own", own).dropDuplicates([id_col, "_own"]).drop("_own")
    return left.join(twice, repeated, "left_anti").unionAll(once)

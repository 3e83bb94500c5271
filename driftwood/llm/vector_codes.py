"""Vector code compression with exact integer products (operator 12).

A product quantiser: every component x becomes the integer floor(scale * x), a
vector is cut into ``parts`` equal consecutive parts, and each part is coded by
the nearest entry of its codebook.  The codebooks start as the vectors of the
smallest ids and are refined by rounds of assignment and mean; every number is
an integer, so the result does not depend on how the rows are dealt out.

Limb-split products.  Distances come from |x|^2 - 2 x.c + |c|^2.  The dot
products are done by BLAS in float64, which is exact only while every partial sum
stays below 2^53.  So integers are broken into limbs of ``limb_bits`` bits (the
top one signed) with length * 2^(2 * limb_bits) <= 2^53; one product per pair of
limbs is exact, and the products are put together by shifts in int64.  There are as
many limbs as the largest integer at hand needs.  The first arg-min gives
the lowest index among equal distances.

On Spark: every round is one pass over the rows (cleaning and reading pruned to
two columns); a task sends one row per used codebook entry with the count and the
componentwise sums, which are added per entry.  The driver holds the codebooks
(parts x entries x length integers) only, and a broadcast carries them to the tasks.

Defined results: rows whose vector is null or holds null, NaN or infinite
components are dropped.  The length is that of the vector with the smallest kept
id (ties: the smaller vector) and must divide by ``parts``, else ValueError; rows of another length
are returned with null code and error and take no part.  Null ids are coded but
start no codebook entry; repeated rows count each.  With fewer rows than entries
the codebooks are smaller.  Integers must stay below 2^m in size, m = (61 - log2(length)) // 2, 27 at 64
components (beyond it an error may not fit in 64 bits): ValueError.  A label's sum
beyond 64 bits is Spark's overflow error.
An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.llm.common import written


def limb_bits(length: int) -> int:
    """The widest limbs whose products stay exact over ``length`` components."""
    return (53 - max(length - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs, lowest first: x = sum of limb k * 2^(bits k); the last is signed."""
    out, top = [], int(np.abs(x).max()) if x.size else 0
    while top >> bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
        top >>= bits
    return [*out, x.astype(np.float64)]


def exact_dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 matrices, exactly, through float64 BLAS products of limbs."""
    bits = limb_bits(x.shape[1])
    left, right = limbs(x, bits), limbs(c, bits)
    out = np.zeros((len(x), len(c)), dtype=np.int64)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest row of ``c`` for every row of ``x``, and the squared distance."""
    d = (c * c).sum(axis=1)[None, :] - 2 * exact_dots(x, c)
    k = d.argmin(axis=1)
    return k, d[np.arange(len(x)), k] + (x * x).sum(axis=1)


def integers(values: np.ndarray, scale: int, bound: int) -> np.ndarray:
    v = np.floor(values.astype(np.float64) * scale)
    if v.size and np.abs(v).max() >= bound:
        raise ValueError(f"components of {bound / scale:g} or more in size do not fit exact 64-bit distances")
    return v.astype(np.int64)


def _bound(length: int) -> int:
    return 1 << ((61 - max(length - 1, 0).bit_length()) // 2)


def _matrix(column: pa.Array, length: int, scale: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the right length as a mask, and their integers."""
    sizes = np.diff(column.offsets.to_numpy())
    fits = sizes == length
    values = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
    return fits, integers(values.reshape(int(fits.sum()), length), scale, bound)


def usable(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """``vec_id, v`` (array<double>) and the columns ``more``; rows with null or non-finite components go."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(v.isNotNull()).where(fine).select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v"),
                                                      *[F.col(f"`{c}`").alias(n) for n, c in (m.split("=") for m in more)])


def smallest(rows: DataFrame, n: int) -> list:
    """The ``n`` rows of the smallest ids (ties: the smaller vectors), without sending n vectors of every task to the driver.

    A task keeps its n smallest ids; 1,024 tasks' ids meet in one group; the n-th of what is left cuts the rows.
    """
    def least(df: DataFrame, *order: str) -> DataFrame:
        groups = df.withColumn("_g", F.floor(F.spark_partition_id() / 1024))
        ranked = groups.withColumn("_k", F.row_number().over(Window.partitionBy("_g").orderBy(*order)))
        return ranked.where(F.col("_k") <= n).drop("_g", "_k").orderBy(*order).limit(n)

    known = rows.where("vec_id is not null")
    cut = least(known.select("vec_id"), "vec_id").agg(F.max("vec_id").alias("m")).first()["m"]
    return [] if cut is None else least(known.where(F.col("vec_id") <= cut), "vec_id", "v").collect()


def train(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> np.ndarray | None:
    """The codebooks, int64 of shape (parts, entries, length / parts); None without rows."""
    rows = usable(df, id_col, vector_col)
    start = smallest(rows, entries)
    if not start:
        return None
    length = len(start[0]["v"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    if any(len(r["v"]) != length for r in start):
        start = smallest(rows.where(F.size("v") == length), entries)
    size, bound = length // parts, _bound(length)
    books = integers(np.array([r["v"] for r in start]).reshape(len(start), parts, size), scale, bound).transpose(1, 0, 2)
    for _ in range(rounds):
        shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(books))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            count = np.zeros(c.shape[:2], dtype=np.int64)
            total = np.zeros(c.shape, dtype=np.int64)
            for b in batches:
                _, x = _matrix(b.column(0), length, scale, bound)
                for p in range(parts):
                    part = x[:, p * size:(p + 1) * size]
                    k, _ = nearest(part, c[p])
                    order = np.argsort(k, kind="stable")
                    used, at = np.unique(k[order], return_index=True)
                    if len(used) and size:
                        total[p, used] += np.add.reduceat(part[order], at, axis=0)
                    count[p] += np.bincount(k, minlength=c.shape[1])
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(p * c.shape[1] + e, pa.int64()), pa.array(count[p, e], pa.int64()),
                                              pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], names=["slot", "n", "s"])

        used = rows.select("v").mapInArrow(sums, "slot bigint, n bigint, s array<bigint>").groupBy("slot").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(size)]).cast("array<bigint>").alias("s"))
        books = books.copy()
        for r in used.collect():  # at most parts x entries rows
            books[r["slot"] // books.shape[1], r["slot"] % books.shape[1]] = [s // r["n"] for s in r["s"]]
        shared.unpersist()
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(df: DataFrame, books: np.ndarray, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str | None = None) -> DataFrame:
    """``vec_id, code, error`` (and ``label``) of every usable row."""
    parts, _, size = books.shape
    length, bound = parts * size, _bound(parts * size)
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(books))
    rows = usable(df, id_col, vector_col, *([f"label={label_col}"] if label_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        hexed = np.array([f"{k:0{max(2, len(f'{c.shape[1] - 1:x}'))}x}" for k in range(c.shape[1])])
        for b in batches:
            fits, x = _matrix(b.column(1), length, scale, bound)
            error = np.zeros(len(x), dtype=np.int64)
            code = np.full(len(x), "", dtype=object)
            for p in range(parts):
                k, d = nearest(x[:, p * size:(p + 1) * size], c[p])
                error += d
                code = code + hexed[k].astype(object)
            place = pa.array(np.where(fits, np.cumsum(fits) - 1, 0), mask=~fits)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(code, pa.string()).take(place),
                                              pa.array(error, pa.int64()).take(place), *b.columns[2:]],
                                             names=["vec_id", "code", "error", *b.schema.names[2:]])

    kind = f", label {rows.schema['label'].dataType.simpleString()}" if label_col else ""
    return rows.mapInArrow(run, f"vec_id bigint, code string, error bigint{kind}")


def code_report(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id",
                vector_col: str = "embedding", label_col: str = "label", broadcast_rows: int = 100_000,
                salts: int = 16) -> DataFrame:
    """Code and error of every usable row, the error per label and the digest of the codebooks.

    The labels' sums are broadcast if they are at most ``broadcast_rows``; beyond that
    they are joined with ``salts`` copies each, so a frequent label is spread out.
    """
    books = train(df, parts, entries, rounds, scale, id_col, vector_col)
    if books is None:  # no id to start from
        return usable(df, id_col, vector_col).select(
            "vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"),
            F.lit(None).cast("bigint").alias("label_error"), F.lit(digest(np.zeros(0))).alias("codebooks_sha256"))
    coded = written(encode(df, books, scale, id_col, vector_col, label_col), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    if sums.limit(broadcast_rows + 1).count() <= broadcast_rows:
        joined = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left")
    else:
        spread = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = coded.withColumn("own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)))
        joined = salted.join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("salt")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle(parts: int = 4, length: int = 16, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    distance = "list_sum(list_transform(list_zip(x.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT rid, part, CAST(arg_min(entry, (d, entry)) AS BIGINT) AS entry, min(d) AS d
  FROM (SELECT x.rid, x.part, b.entry, CAST({distance} AS BIGINT) AS d FROM cut x JOIN book{r} b USING (part))
  GROUP BY rid, part)""")
        if r < rounds:
            steps.append(f"""mean{r} AS MATERIALIZED (
  SELECT part, entry, list(m ORDER BY i) AS w FROM (
    SELECT n.part, n.entry, g.i, CAST(CASE WHEN sum(x.w[g.i]) >= 0 THEN sum(x.w[g.i]) // count(*)
      ELSE -((count(*) - 1 - sum(x.w[g.i])) // count(*)) END AS BIGINT) AS m
    FROM near{r} n JOIN cut x USING (rid, part), range(1, {length + 1}) g(i) GROUP BY n.part, n.entry, g.i)
  GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.w, b.w) AS w FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT rid, p.part, list_slice(v, p.part * {length} + 1, (p.part + 1) * {length}) AS w FROM kept, range({parts}) p(part)),
book0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, w FROM cut WHERE rid <= {entries}),
{", ".join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid),
books AS (
  SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


ORACLE = _oracle()

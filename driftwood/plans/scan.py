"""Two-level ordered scan: the shared plan for every running operator.

A plain ``Window.orderBy(...)`` with no ``partitionBy`` sends the whole table
to one task, and a keyed window sends a whole key to one task (a hot key
holding a third of the rows would then be a third of the job in one task).
Instead every running operator here is planned as:

1. ``_bucket`` = range bucket of the (composite) order key.  The number of
   buckets grows with the rows (``rows_per_bucket`` each, no cap).  Boundaries are
   quantiles of a sample of the order key: the row count comes from the files'
   footers, so the sample is the one pass over the order columns.  The bucket is
   found by a binary search over one array literal: ``log2(buckets)``
   comparisons per row, each a compiled projection.  Any boundary
   set gives correct results; boundaries only affect balance.
2. Running aggregates inside ``partitionBy(*keys, _bucket)``: a single hash
   exchange of the rows, so a hot key is spread over all order buckets.
3. One summary row per ``(keys, _bucket)`` group, combined by a window over
   the (small) summary table into a carry-in per group.
4. The carry-in is joined back on ``(keys, _bucket)``.  The data side is
   already hash-partitioned on those columns, so only the summary side
   moves; the global form broadcasts it (one row per bucket).  With one bucket (keys
   none of which is hot) nothing is carried: no summary, no join.

Keys are compared null-safely everywhere: rows with a null key form one group.
Order columns must form a unique, non-null key (ties are not broken
otherwise); every caller passes a unique tie-breaker.
"""

from __future__ import annotations

import decimal
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.plans.parallelism import input_bytes, spread

BUCKET = "_bucket"

DEFAULT_ROWS_PER_BUCKET = 1_000_000
DEFAULT_OVERSAMPLE = 24
#: Sampled keys on the driver; with more buckets than that, one key a bucket.
SAMPLE_KEYS = 200_000


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null meets null; the result has the key columns once.

    ``right`` may share no other column name with ``left``.
    """
    keys = list(keys)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = one if cond is None else cond & one
    out = left.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def _plain(value):
    """A boundary value as JSON."""
    return str(value) if isinstance(value, decimal.Decimal) else value


def _search_value(df: DataFrame, name: str) -> Column:
    """An order column as searched: times as integers, which no time zone moves."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(F.col(name))
    if kind == "date":
        return F.unix_date(F.col(name))
    return F.col(name).cast("string") if kind == "timestamp_ntz" else F.col(name)


def _bounds_array(bounds: Sequence[tuple], schema: str) -> Column:
    """The boundaries as one array, which the optimizer folds into a literal."""
    names = [f"k{i}" for i in range(len(bounds[0]))]
    return F.from_json(F.lit(json.dumps([dict(zip(names, map(_plain, b))) for b in bounds])), schema)


def search_bucket(key: Column, bounds: Sequence[tuple], schema: str) -> Column:
    """Number of boundaries <= key as one Column, by binary search over one folded array literal.

    Lambdas are not compiled: for whole tables ``with_search_bucket`` is several times faster."""
    array = _bounds_array(bounds, schema)

    def halve(acc, _):
        # the answer lies in lo .. hi
        mid = F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
        open_ = acc["lo"] < acc["hi"]
        below = open_ & (F.get(array, mid - 1) <= key)
        return F.struct(F.when(below, mid).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~below, mid - 1).otherwise(acc["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def with_search_bucket(df: DataFrame, key: Column, bounds: Sequence[tuple], schema: str, name: str = BUCKET) -> DataFrame:
    """Append the number of boundaries <= key: the binary search as one compiled projection a step.

    The key is formed once a row; a step of half the width of the one before is one comparison."""
    array = _bounds_array(bounds, schema)
    out = df.select("*", key.alias("_search_key"), F.lit(0).alias("_search_at"))
    at = F.col("_search_at")
    for i in reversed(range(len(bounds).bit_length())):
        # beyond the last boundary ``get`` gives null: the step is not taken
        upto = F.get(array, at + F.lit((1 << i) - 1))
        out = out.withColumn("_search_at", at + F.when(upto <= F.col("_search_key"), F.lit(1 << i)).otherwise(F.lit(0)))
    return out.select(*df.columns, at.alias(name))


def choose_buckets(spark, n_rows: int, rows_per_bucket: int, min_buckets: int | None) -> int:
    if min_buckets is None:
        min_buckets = spark.sparkContext.defaultParallelism
    nb = max(min_buckets, -(-n_rows // max(1, rows_per_bucket)))
    return int(max(1, min(nb, n_rows)))


def add_range_bucket(df: DataFrame, order_cols, *, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                     min_buckets: int | None = None, oversample: int = DEFAULT_OVERSAMPLE,
                     seed: int = 29, key_cols=()) -> tuple[DataFrame, int]:
    """Append ``_bucket``: a monotone range bucket of the order key.

    With ``key_cols`` only *hot* keys are split: a key holding more rows than
    one bucket's worth (``max(rows_per_bucket, n / buckets)``) gets range
    buckets, every other key stays in bucket 0, so the per-(key, bucket)
    summary stays about one row per key.  At most ``n / threshold`` keys can
    be hot, so the hot-key list is a proven-bounded broadcast.
    """
    order_cols, key_cols = _as_list(order_cols), _as_list(key_cols)
    n = df.count()
    nb = choose_buckets(df.sparkSession, n, rows_per_bucket, min_buckets)
    if nb <= 1:
        return df.withColumn(BUCKET, F.lit(0)), 1
    hot = None
    src = df
    if key_cols:
        threshold = max(int(rows_per_bucket), n // nb)
        counted = (df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
                   .filter(F.col("_n") > threshold).withColumn("_hot", F.lit(True)).collect())
        if not counted:  # at most n / threshold <= buckets rows
            return df.withColumn(BUCKET, F.lit(0)), 1
        n = sum(r["_n"] for r in counted)
        hot = F.broadcast(df.sparkSession.createDataFrame(
            counted, df.select(*key_cols, F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_hot")).schema).drop("_n"))
        src = null_safe_join(df, hot.select(*key_cols), key_cols, "left_semi")
    want = nb * max(1, min(oversample, SAMPLE_KEYS // nb))
    # Only boundaries are estimated from the sample, every row is processed.
    searched = src.select(*[_search_value(df, c).alias(f"k{i}") for i, c in enumerate(order_cols)])
    sample = searched.na.drop().sample(False, min(1.0, want / n), seed).collect()
    keys = sorted(tuple(r) for r in sample)
    bounds = []
    for i in range(1, nb):
        if not keys:
            break
        k = keys[min(len(keys) - 1, (i * len(keys)) // nb)]
        if not bounds or k > bounds[-1]:
            bounds.append(k)
    if not bounds:
        return df.withColumn(BUCKET, F.lit(0)), 1
    schema = "array<" + searched.schema.simpleString() + ">"
    key = F.struct(*[_search_value(df, c).alias(f"k{i}") for i, c in enumerate(order_cols)])
    if hot is not None:
        j = with_search_bucket(null_safe_join(df, hot, key_cols, "left"), key, bounds, schema)
        return j.withColumn(BUCKET, F.when(F.col("_hot"), F.col(BUCKET)).otherwise(F.lit(0))).drop("_hot"), len(bounds) + 1
    return with_search_bucket(df, key, bounds, schema), len(bounds) + 1


def _carry_window(key_cols: list[str], exclusive: bool = True):
    w = Window.partitionBy(*key_cols).orderBy(BUCKET)
    return w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)


def _join_carry(local: DataFrame, carry: DataFrame, key_cols: list[str]) -> DataFrame:
    if not key_cols:
        # Global form: one row per bucket.
        carry = F.broadcast(carry)
    return null_safe_join(local, carry, [*key_cols, BUCKET])


def running_sums(df: DataFrame, sums: Mapping[str, Column], order_cols, key_cols=(), *,
                 inclusive: bool = True, **bucket_opts) -> DataFrame:
    """Append one running sum per entry of ``sums`` (per key, in order).

    ``inclusive=False`` gives the sum over strictly earlier rows (0 first).
    """
    order_cols, key_cols = _as_list(order_cols), _as_list(key_cols)
    names = list(sums)
    # the values are formed on both sides of the exchange, which carries the rows alone
    rows, nb = add_range_bucket(df, order_cols, key_cols=key_cols, **bucket_opts)
    values = [sums[n].alias(f"_v_{n}") for n in names]
    g = [*key_cols, BUCKET]
    w = Window.partitionBy(*g).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding,
                                                               Window.currentRow)
    local = spread(rows, *g, size=input_bytes(df)).select("*", *values).select(
        "*", *[F.sum(f"_v_{n}").over(w).alias(f"_l_{n}") for n in names])
    # Bucket totals straight from the rows: partial aggregation map-side.
    summ = rows.select(*g, *values).groupBy(*g).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    wc = _carry_window(key_cols)
    carry = summ.select(*g, *[F.coalesce(F.sum(f"_t_{n}").over(wc), F.lit(0)).alias(f"_c_{n}")
                              for n in names])
    if nb > 1:
        out = _join_carry(local, carry, key_cols)
    else:
        out = local.select("*", *[F.lit(0).cast(carry.schema[f"_c_{n}"].dataType).alias(f"_c_{n}") for n in names])
    cols = [F.col(c) for c in df.columns]
    for n in names:
        total = F.col(f"_c_{n}") + F.col(f"_l_{n}")
        if not inclusive:
            total = total - F.col(f"_v_{n}")
        cols.append(total.alias(n))
    return out.select(*cols)


def row_position(df: DataFrame, order_cols, key_cols=(), name: str = "pos",
                 **bucket_opts) -> DataFrame:
    """0-based dense position in order (per key), without a one-task window."""
    out = running_sums(df, {name: F.lit(1).cast("long")}, order_cols, key_cols, **bucket_opts)
    return out.withColumn(name, F.col(name) - F.lit(1))


def _kadane_parts(df: DataFrame, x: Column, order_cols, key_cols, bucket_opts):
    order_cols, key_cols = _as_list(order_cols), _as_list(key_cols)
    base = df.select("*", x.cast("long").alias("_x"))
    base, _ = add_range_bucket(base, order_cols, key_cols=key_cols, **bucket_opts)
    g = [*key_cols, BUCKET]
    w = Window.partitionBy(*g).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding,
                                                               Window.currentRow)
    zero = F.lit(0).cast("long")
    l1 = spread(base, *g, size=input_bytes(df)).withColumn("_pl", F.sum("_x").over(w))
    l2 = (l1.withColumn("_d", F.col("_pl") - F.least(zero, F.min("_pl").over(w)))
          .withColumn("_mx", F.max("_pl").over(w)))
    local = l2.withColumn("_lb", F.max("_d").over(w))
    # Summaries from the windowed rows: same exchange, no new shuffle.
    summ = local.groupBy(*g).agg(
        F.sum("_x").alias("_T"),
        (F.sum("_x") - F.least(zero, F.min("_pl"))).alias("_A"),
        F.max("_d").alias("_B"),
        F.max("_pl").alias("_C"),
    )
    wprev = Window.partitionBy(*key_cols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    s1 = (summ.withColumn("_S", F.coalesce(F.sum("_T").over(wprev), zero))
          .withColumn("_S1", F.col("_S") + F.col("_T")))
    s2 = s1.withColumn(
        "_h_in",
        F.col("_S") + F.greatest(zero, F.coalesce(F.max(F.col("_A") - F.col("_S1")).over(wprev),
                                                  zero)))
    return local, s2, wprev, key_cols


def running_kadane(df: DataFrame, x: Column, order_cols, key_cols=(), *, h_name: str = "h",
                   m_name: str = "m", **bucket_opts) -> DataFrame:
    """Running maximum subarray (Kadane) per key in order.

    ``h`` = best sum of a run ending here (clamped at 0), ``m`` = best so far
    (starts at 0, so an all-negative input gives 0).

    Inside a bucket with local prefix ``Pl``: ``d = Pl - least(0, min Pl)``,
    ``lb`` = running max of ``d``, ``mx`` = running max of ``Pl``.  With the
    carry ``(h_in, m_in)`` of all earlier buckets:
    ``h = greatest(d, h_in + Pl)``, ``m = greatest(m_in, lb, h_in + mx)``.
    A bucket maps ``h_in`` to ``greatest(A, h_in + T)`` with
    ``T`` = total and ``A = T - least(0, min Pl)``; unrolled over buckets
    ``h_in_b = S_b + greatest(0, max_{j<b}(A_j - S_{j+1}))`` where ``S`` is
    the running sum of ``T``, and ``m_in_b = max_{j<b} greatest(B_j, h_in_j + C_j)``
    with ``B`` = max ``d`` and ``C`` = max ``Pl`` of bucket ``j``.
    """
    local, s2, wprev, key_cols = _kadane_parts(df, x, order_cols, key_cols, bucket_opts)
    zero = F.lit(0).cast("long")
    carry = s2.select(
        *key_cols, BUCKET, "_h_in",
        F.coalesce(F.max(F.greatest("_B", F.col("_h_in") + F.col("_C"))).over(wprev),
                   zero).alias("_m_in"))
    out = _join_carry(local, carry, key_cols)
    h = F.greatest(F.col("_d"), F.col("_h_in") + F.col("_pl"))
    m = F.greatest(F.col("_m_in"), F.col("_lb"), F.col("_h_in") + F.col("_mx"))
    return out.select(*[F.col(c) for c in df.columns], h.alias(h_name), m.alias(m_name))


def kadane_final(df: DataFrame, x: Column, order_cols, key_cols=(), *,
                 name: str = "max_subarray", **bucket_opts) -> DataFrame:
    """Final maximum subarray per key: only bucket summaries leave the window."""
    _, s2, _, key_cols = _kadane_parts(df, x, order_cols, key_cols, bucket_opts)
    zero = F.lit(0).cast("long")
    best = F.greatest(zero, F.max(F.greatest("_B", F.col("_h_in") + F.col("_C"))))
    return s2.groupBy(*key_cols).agg(best.alias(name))

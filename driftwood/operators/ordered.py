"""Running (ordered) operators: Kadane, recursive least squares,
follow-the-leader, positional zip, first-n.

Every operator takes ``order_cols`` (a unique order key) and optional
``key_cols``; all of them run on the two-level ordered scan in
``driftwood.plans.scan`` so neither a whole stream nor a whole key ever
lands in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.plans import scan
from driftwood.plans.parallelism import input_bytes, spread
from driftwood.plans.scan import BUCKET, _as_list, _join_carry


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- Kadane

def running_max_subarray(df: DataFrame, x, order_cols, key_cols=(), *,
                         best_name: str = "max_subarray", here_name: str = "max_ending_here",
                         **bucket_opts) -> DataFrame:
    """One output per input, ``h=max(0,h+x); m=max(m,h)``; both start at 0.

    Integer input (bigint state).  ``key_cols=()`` is the reference's single
    unkeyed stream (C2).
    """
    return scan.running_kadane(df, _c(x), order_cols, key_cols, h_name=here_name,
                               m_name=best_name, **bucket_opts)


def max_subarray(df: DataFrame, x, order_cols, key_cols=(), *, name: str = "max_subarray",
                 **bucket_opts) -> DataFrame:
    """Final maximum subarray per key (0 for all-negative input)."""
    return scan.kadane_final(df, _c(x), order_cols, key_cols, name=name, **bucket_opts)


# ---------------------------------------------------------------- RLS

def rls_weights(df: DataFrame, x, y, order_cols, key_cols=(), *, x0: float = 1.0,
                y0: float = 10.0, **bucket_opts) -> DataFrame:
    """1-D recursive least squares, one row per (x, y) pair.

    The recursion ``theta <- theta - theta^2 x^2/(1+x^2 theta)``,
    ``w <- w - theta x (w x - y)`` from ``theta=1, w=y0/x0`` (0 if x0=0) has
    the closed form ``theta_t = 1/(1+sum x^2)``,
    ``w_t = (w0 + sum x*y) * theta_t``: two running sums.
    Appends ``theta``, ``weight`` and ``prediction`` (= w_t * x_t).
    """
    w0 = 0.0 if x0 == 0 else float(y0) / float(x0)
    xx, yy = _c(x).cast("double"), _c(y).cast("double")
    out = scan.running_sums(df, {"_sxx": xx * xx, "_sxy": xx * yy}, order_cols, key_cols,
                            **bucket_opts)
    theta = F.lit(1.0) / (F.lit(1.0) + F.col("_sxx"))
    weight = (F.lit(w0) + F.col("_sxy")) * theta
    return (out.withColumn("theta", theta).withColumn("weight", weight)
            .withColumn("prediction", F.col("weight") * xx).drop("_sxx", "_sxy"))


def rls_predict(df: DataFrame, x, y, order_cols, key_cols=(), **kw) -> DataFrame:
    """The prediction stream only (after the update with the same pair)."""
    out = rls_weights(df, x, y, order_cols, key_cols, **kw)
    return out.drop("theta", "weight")


# ---------------------------------------------------------------- FTL

def hypothesis_bank(slopes: Sequence[float] = tuple(range(31))) -> list[Callable[[Column], Column]]:
    """C11: hypotheses ``a*x`` (default a = 0..30)."""
    return [(lambda v, a=a: v * F.lit(float(a))) for a in slopes]


def absolute_loss(pred: Column, y: Column) -> Column:
    return F.abs(pred - y)


def hypothesis_table(spark, slopes: Sequence[float] = tuple(range(31))) -> DataFrame:
    """C11 as a table ``(idx, a)``."""
    return spark.createDataFrame([(i, float(a)) for i, a in enumerate(slopes)], "idx int, a double")


class _Bank:
    """Hypotheses as array expressions: a linear bank maps over one array of slopes, any
    other list of functions becomes an array of their Columns."""

    def __init__(self, hypotheses, loss):
        self.loss = loss
        self.hyps = None if hypotheses is None else list(hypotheses)
        self.slopes = F.array(*[F.lit(float(a)) for a in range(31)]) if hypotheses is None else None
        self.size = 31 if hypotheses is None else len(self.hyps)

    def losses(self, x: Column, y: Column) -> Column:
        """array<double>: the loss of every hypothesis on one pair."""
        if self.hyps is None:
            return F.transform(self.slopes, lambda a: self.loss(x * a, y))
        return F.array(*[self.loss(h(x), y).cast("double") for h in self.hyps])

    def zeros(self) -> Column:
        return F.array_repeat(F.lit(0.0), self.size)

    def leader(self, sums: Column, x: Column) -> tuple[Column, Column]:
        """(index of the least sum, the lowest of equals; its prediction)."""
        idx = (F.array_position(sums, F.array_min(sums)) - 1).cast("int")
        if self.hyps is None:
            return idx, F.get(self.slopes, idx) * x
        return idx, F.get(F.array(*[h(x).cast("double") for h in self.hyps]), idx)


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _summed(df: DataFrame, keys, col: str, n: int, *more: Column) -> DataFrame:
    """Element-wise sums of the array ``col`` by ``keys``: plain partial aggregates."""
    each = df.groupBy(*keys).agg(*more, *[F.sum(F.get(F.col(col), F.lit(i))).alias(f"_t{i}") for i in range(n)])
    return each.withColumn(col, F.array(*[F.col(f"_t{i}") for i in range(n)])).drop(*[f"_t{i}" for i in range(n)])


def _running_arrays(df: DataFrame, col: str, first: str, name: str, size: int) -> DataFrame:
    """Running element-wise sums of ``col`` in the order of each partition's rows, from anew where ``first`` is true.

    Thirty window sums cost a wide row each; numpy adds whole rows of numbers.
    """
    names = list(df.columns)
    at, new = names.index(col), names.index(first)

    def run(batches):
        carry = np.zeros(size)
        for b in batches:
            values = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, size).copy()
            starts = np.flatnonzero(b.column(new).to_numpy(zero_copy_only=False))
            if len(values) and (len(starts) == 0 or starts[0] > 0):
                values[0] += carry
            for s, e in zip(np.concatenate(([0], starts)), np.concatenate((starts, [len(values)]))):
                np.cumsum(values[s:e], axis=0, out=values[s:e])
            if len(values):
                carry = values[-1].copy()
            sums = pa.ListArray.from_arrays(np.arange(0, values.size + 1, size, dtype=np.int32), values.ravel())
            yield pa.RecordBatch.from_arrays([*b.columns, sums], names=[*names, name])

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, schema)


def follow_the_leader(df: DataFrame, x, y, order_cols, key_cols=(), *, hypotheses=None,
                      loss: Callable[[Column, Column], Column] = absolute_loss,
                      window: int | None = None, **bucket_opts) -> DataFrame:
    """Follow-the-leader prediction per row.

    At step t the pair ``(x_{t-1}, y_t)`` joins the past (``x_0 = 0``); the
    leader is the hypothesis with the least total loss over the past (ties
    go to the lowest index) and the output is ``leader(x_t)``.  With
    ``window=w`` only the last ``w`` pairs count (the bounded past the
    reference meant to keep), whatever its length.  Appends ``leader`` (hypothesis index) and
    ``prediction``.
    """
    bank = _Bank(hypotheses, loss)
    order_cols, key_cols = _as_list(order_cols), _as_list(key_cols)
    xx, yy = _c(x).cast("double"), _c(y).cast("double")
    base = df.select("*", xx.alias("_x"), yy.alias("_y"))
    if window is None:
        out = ftl_sums(base, bank, order_cols, key_cols, bucket_opts)
    else:
        out = _ftl_sliding(base, bank, int(window), order_cols, key_cols, bucket_opts)
    idx, pred = bank.leader(F.col("_S"), F.col("_x"))
    return out.select(*[F.col(c) for c in df.columns], idx.alias("leader"),
                      pred.alias("prediction"))


def ftl_sums(base, bank: _Bank, order_cols, key_cols, bucket_opts):
    """``base`` (with ``_x, _y``) and ``_S``, the summed losses of every hypothesis up to each row.

    One bucketed pass: sums inside a bucket use the in-bucket previous x; the
    first row of each bucket is corrected with the previous bucket's last x.
    """
    size = input_bytes(base)
    base, nb = scan.add_range_bucket(base, order_cols, key_cols=key_cols, **bucket_opts)
    g = [*key_cols, BUCKET]
    wl = Window.partitionBy(*g).orderBy(*order_cols)
    local = spread(base, *g, size=size).withColumns({"_px": F.lag("_x", 1).over(wl), "_first": F.row_number().over(wl) == 1})
    local = local.withColumn("_e", F.when(F.col("_first"), bank.zeros()).otherwise(bank.losses(F.col("_px"), F.col("_y"))))
    if nb == 1:  # nothing is carried but a key's first pair, its x_0 = 0
        local = local.withColumn("_fy", F.first("_y").over(wl))
        rows = local.sortWithinPartitions(*g, *order_cols).drop("_px", BUCKET)
        summed = _running_arrays(rows, "_e", "_first", "_l", bank.size).drop("_e", "_first")
        return summed.withColumn("_S", _added(bank.losses(F.lit(0.0), F.col("_fy")), F.col("_l"))).drop("_fy", "_l")
    okey = F.struct(*[F.col(c) for c in order_cols])
    # bucket totals are plain sums of the per-row losses (hash aggregate)
    summ = _summed(local, g, "_e", bank.size, F.min_by("_y", okey).alias("_fy"), F.max_by("_x", okey).alias("_lx"))
    wk = Window.partitionBy(*key_cols).orderBy(BUCKET)
    s = summ.withColumn("_plx", F.lag("_lx", 1, 0.0).over(wk))
    s = s.withColumn("_F", bank.losses(F.col("_plx"), F.col("_fy"))).withColumn("_B", _added(F.col("_e"), F.col("_F")))
    wprev = wk.rowsBetween(Window.unboundedPreceding, -1)
    carry = s.select(*g, F.array(*[
        F.coalesce(F.sum(F.get("_B", F.lit(i))).over(wprev), F.lit(0.0)) + F.get("_F", F.lit(i)) for i in range(bank.size)]).alias("_C"))
    # the window has left the rows in this order already
    rows = local.sortWithinPartitions(*g, *order_cols).drop("_px")
    summed = _running_arrays(rows, "_e", "_first", "_l", bank.size).drop("_e", "_first")
    return _join_carry(summed, carry, key_cols).withColumn("_S", _added(F.col("_C"), F.col("_l"))).drop("_C", "_l")


#: Rows of a run in the sliding form, at least; a run is read together with the ``window`` rows before it.
RUN_ROWS = 100_000
SHORT_WINDOW = 32


def _ftl_sliding(base, bank: _Bank, win, order_cols, key_cols, bucket_opts, run_rows: int | None = None):
    """Bounded past: ``base`` and ``_S``, the summed losses of the last ``win`` pairs.

    Rows are cut into runs by exact position, and the last ``win`` rows of a run are also
    dealt to the next one (a tenth of the rows at most), so a run never looks outside
    itself.  The plan and the work per row are the same for every window length.
    """
    size = max(run_rows or RUN_ROWS, 10 * win)
    placed = scan.row_position(base, order_cols, key_cols, name="_pos", **bucket_opts)
    run = F.floor(F.col("_pos") / size).cast("bigint")
    ahead = F.col("_pos") % size >= size - win
    dealt = placed.withColumn("_run", F.explode(F.when(ahead, F.array(run, run + 1)).otherwise(F.array(run))))
    w = Window.partitionBy(*key_cols, "_run").orderBy("_pos")
    # the first x of a stream is 0; the first row lent by an earlier run lies outside every window of this one
    losses = bank.losses(F.coalesce(F.col("_px"), F.lit(0.0)), F.col("_y"))
    rows = (dealt.withColumns({"_px": F.lag("_x", 1).over(w), "_first": F.row_number().over(w) == 1})
            .withColumn("_e", F.transform(losses, lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))).drop("_px"))
    own = F.floor(F.col("_pos") / size) == F.col("_run")
    # the window has left the rows in this order already
    summed = _sliding_arrays(rows.sortWithinPartitions(*key_cols, "_run", "_pos"), "_e", "_first", "_S", bank.size, win)
    return summed.filter(own).drop("_e", "_first", "_run", "_pos")


def _sliding_arrays(df: DataFrame, col: str, first: str, name: str, size: int, win: int) -> DataFrame:
    """Element-wise sums of ``col`` over the last ``win`` rows, from anew where ``first`` is true.

    A window is the end of one stretch of ``win`` rows and the start of the next: sums from
    the right of the former, sums from the left of the latter.  Nothing is subtracted, so large
    past values leave no error behind, and a row costs two additions a hypothesis whatever ``win`` is.
    Windows up to ``SHORT_WINDOW`` add whole shifted batches instead, one addition a row of the window.
    """
    names = list(df.columns)
    at, new = names.index(col), names.index(first)

    def short(batches):
        tail = np.zeros((win - 1, size))  # the rows before, of the same run
        for b in batches:
            values = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            starts = np.flatnonzero(b.column(new).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.concatenate(([0], starts, [len(values)])))
            out = np.empty_like(values)
            for s, e in zip(cuts[:-1], cuts[1:]):
                if s in starts:
                    tail = np.zeros((win - 1, size))
                rows = np.concatenate((tail, values[s:e]))
                total = rows[:e - s].copy()
                for k in range(1, win):
                    total += rows[k:k + e - s]
                out[s:e], tail = total, rows[len(rows) - win + 1:]
            yield summed(b, out)

    def summed(b, out):
        sums = pa.ListArray.from_arrays(np.arange(0, out.size + 1, size, dtype=np.int32), out.ravel())
        return pa.RecordBatch.from_arrays([*b.columns, sums], names=[*names, name])

    def run(batches):
        ends = np.zeros((win + 1, size))  # sums of the last rows of the full stretch before: ends[i] leaves out i rows
        now, fill, total = np.empty((win, size)), 0, np.zeros(size)
        for b in batches:
            values = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            starts = set(np.flatnonzero(b.column(new).to_numpy(zero_copy_only=False)).tolist())
            out, row = np.empty_like(values), 0
            edges = iter(sorted(starts | {len(values)}))
            edge = next(edges)
            while row < len(values):
                if row in starts:
                    ends[:], fill = 0.0, 0
                while edge <= row:
                    edge = next(edges)
                if fill == 0:
                    total = np.zeros(size)
                take = min(edge - row, win - fill)
                now[fill:fill + take] = values[row:row + take]
                left = np.cumsum(values[row:row + take], axis=0) + total
                out[row:row + take] = left + ends[fill + 1:fill + take + 1]
                total, row, fill = left[-1], row + take, fill + take
                if fill == win:
                    ends[:win] = np.cumsum(now[::-1], axis=0)[::-1]
                    ends[win], fill = 0.0, 0
            yield summed(b, out)

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(short if win <= SHORT_WINDOW else run, schema)


# ---------------------------------------------------------------- B3, B4

def zip_by_position(left: DataFrame, right: DataFrame, left_order, right_order, *,
                    key_cols=(), **bucket_opts) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` (per key).

    Positions come from the two-level scan; the pairing is an equi-join on
    ``(key, pos)`` (unique, so no skew); it ends at the shorter side.
    """
    key_cols = _as_list(key_cols)
    lp = scan.row_position(left, left_order, key_cols, name="pos", **bucket_opts)
    rp = scan.row_position(right, right_order, key_cols, name="pos", **bucket_opts)
    return scan.null_safe_join(lp, rp, [*key_cols, "pos"])


def take_first(df: DataFrame, n: int, order_cols) -> DataFrame:
    """First ``n`` rows in order (top-k per partition, then merged)."""
    return df.orderBy(*_as_list(order_cols)).limit(int(n))

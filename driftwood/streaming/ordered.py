"""Streaming forms of the running operators.

Each is a ``foreachBatch`` step over a per-key state table (see
``runner``); inside a micro-batch the batch operator runs unchanged on the
two-level ordered scan, and the state enters as a join on the key:

* Kadane (C4): state ``(h, m)`` enters as two virtual lead rows per key
  (``x = m`` then ``x = h - m``), which restore exactly that state.
* RLS (C7): state ``(sum x^2, sum x*y)`` is added to the batch running sums.
* FTL (C10): state ``(last x, loss sum per hypothesis)``: a virtual lead row
  carries the last x; its own pair's loss is removed and the carried sums
  added.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.operators import ordered
from driftwood.plans import scan
from driftwood.session import written

_PRE, _VI = "_pre", "_vi"


def _cols(key_cols, order_cols) -> list:
    return list(dict.fromkeys([*key_cols, *order_cols]))


def _last_per_key(df: DataFrame, key_cols, order_cols, cols) -> DataFrame:
    okey = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(*key_cols).agg(*[F.max_by(c, okey).alias(c) for c in cols])


def _with_state(out: DataFrame, batch: DataFrame, key_cols, order_cols, cols) -> DataFrame:
    """``out`` with ``cols`` of each key's last row of the batch in ``_state``, null elsewhere."""
    okey = F.struct(*[F.col(c) for c in order_cols])
    last = batch.groupBy(*key_cols).agg(F.max(okey).alias("_last"))
    met = scan.null_safe_join(out, last, key_cols) if key_cols else out.join(F.broadcast(last))
    return met.withColumn("_state", F.when(okey == F.col("_last"), F.struct(*cols))).drop("_last")


def _state_of(out: DataFrame, key_cols, order_cols) -> DataFrame:
    """The states in an epoch's written output, one row per key."""
    rows = _last_per_key(out.where(F.col("_state").isNotNull()), key_cols, order_cols, ["_state"])
    return rows.select(*key_cols, "_state.*")


def _keep_old(state: DataFrame | None, new: DataFrame, key_cols) -> DataFrame:
    """The batch's keys replace their old rows; a global state stays if the batch was empty."""
    if state is None:
        return new
    if not key_cols:
        # the aggregate of an empty batch is one row of nulls
        new = new.where(F.coalesce(*[F.col(c).isNotNull() for c in new.columns]))
        return new.unionByName(state).limit(1) if new.isEmpty() else new
    return new.unionByName(scan.null_safe_join(state, new.select(*key_cols), key_cols, "left_anti"))


def _state_for_batch(state: DataFrame | None, batch: DataFrame, key_cols) -> DataFrame | None:
    if state is None:
        return None
    if not key_cols:
        return state
    return scan.null_safe_join(state, batch.select(*key_cols).distinct(), key_cols, "left_semi")


def kadane_step(x: str, order_cols: Sequence[str], key_cols: Sequence[str] = (), **bucket_opts):
    """C4: streaming running maximum subarray (keyed or global)."""
    order_cols, key_cols = list(order_cols), list(key_cols)
    full_order = [_PRE, _VI, *order_cols]

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        real = batch.select(*_cols(key_cols, order_cols), F.col(x).cast("long").alias("x"),
                            F.lit(1).alias(_PRE), F.lit(0).alias(_VI))
        rows = real
        st = _state_for_batch(state, batch, key_cols)
        if st is not None:
            nulls = [F.lit(None).cast(real.schema[c].dataType).alias(c) for c in order_cols
                     if c not in key_cols]
            v1 = st.select(*key_cols, *nulls, F.col("m").alias("x"), F.lit(0).alias(_PRE),
                           F.lit(0).alias(_VI))
            v2 = st.select(*key_cols, *nulls, (F.col("h") - F.col("m")).alias("x"),
                           F.lit(0).alias(_PRE), F.lit(1).alias(_VI))
            rows = real.unionByName(v1).unionByName(v2)
        out = ordered.running_max_subarray(rows, "x", full_order, key_cols,
                                           best_name="m", here_name="h", **bucket_opts)
        out = _with_state(out.filter(F.col(_PRE) == 1), batch, key_cols, order_cols, ["h", "m"])
        result = out.select(*_cols(key_cols, order_cols), "x", F.col("h").alias("max_ending_here"),
                            F.col("m").alias("max_subarray"), "_state")
        return result, lambda done: _keep_old(state, _state_of(done, key_cols, order_cols), key_cols)

    return step


def rls_step(x: str, y: str, order_cols: Sequence[str], key_cols: Sequence[str] = (),
             x0: float = 1.0, y0: float = 10.0, **bucket_opts):
    """Streaming RLS; state per key ``(sxx, sxy)``."""
    order_cols, key_cols = list(order_cols), list(key_cols)
    w0 = 0.0 if x0 == 0 else float(y0) / float(x0)

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        b = batch.select(*_cols(key_cols, order_cols), F.col(x).cast("double").alias("_xx"),
                         F.col(y).cast("double").alias("_yy"))
        s = scan.running_sums(b, {"_a": F.col("_xx") * F.col("_xx"), "_b": F.col("_xx") * F.col("_yy")},
                              order_cols, key_cols, **bucket_opts)
        st = _state_for_batch(state, batch, key_cols)
        if st is not None and key_cols:
            s = scan.null_safe_join(s, st, key_cols, "left")
        else:
            one = st.first() if st is not None else None  # global: a single state row
            s = (s.withColumn("sxx", F.lit(one.sxx if one else 0.0))
                 .withColumn("sxy", F.lit(one.sxy if one else 0.0)))
        sxx = F.col("_a") + F.coalesce("sxx", F.lit(0.0))
        sxy = F.col("_b") + F.coalesce("sxy", F.lit(0.0))
        s = s.select(*_cols(key_cols, order_cols), "_xx", sxx.alias("_sxx"), sxy.alias("_sxy"))
        theta = F.lit(1.0) / (F.lit(1.0) + F.col("_sxx"))
        weight = (F.lit(w0) + F.col("_sxy")) * theta
        out = s.select(*_cols(key_cols, order_cols), theta.alias("theta"), weight.alias("weight"),
                       (weight * F.col("_xx")).alias("prediction"), F.col("_sxx").alias("sxx"), F.col("_sxy").alias("sxy"))
        out = _with_state(out, batch, key_cols, order_cols, ["sxx", "sxy"]).drop("sxx", "sxy")
        return out, lambda done: _keep_old(state, _state_of(done, key_cols, order_cols), key_cols)

    return step


def ftl_step(x: str, y: str, order_cols: Sequence[str], key_cols: Sequence[str] = (),
             hypotheses=None, loss: Callable[[Column, Column], Column] = ordered.absolute_loss,
             **bucket_opts):
    """Streaming follow-the-leader; state per key ``(last_x, S)``, S the summed losses."""
    order_cols, key_cols = list(order_cols), list(key_cols)
    bank = ordered._Bank(hypotheses, loss)
    full_order = [_PRE, *order_cols]

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        real = batch.select(*_cols(key_cols, order_cols), F.col(x).cast("double").alias("_x"),
                            F.col(y).cast("double").alias("_y"), F.lit(1).alias(_PRE))
        rows = real
        st = _state_for_batch(state, batch, key_cols)
        if st is not None:
            nulls = [F.lit(None).cast(real.schema[c].dataType).alias(c) for c in order_cols
                     if c not in key_cols]
            rows = real.unionByName(st.select(*key_cols, *nulls, F.col("last_x").alias("_x"),
                                              F.lit(0.0).alias("_y"), F.lit(0).alias(_PRE)))
        sums = ordered.ftl_sums(rows, bank, full_order, key_cols, bucket_opts)
        sums = sums.filter(F.col(_PRE) == 1)
        if st is not None:
            carry = st.select(*key_cols, F.col("S").alias("_K"))
            if key_cols:
                sums = scan.null_safe_join(sums, carry, key_cols, "left")
            else:  # global: a single state row
                sums = sums.join(F.broadcast(carry))
            # remove the virtual row's own pair (x_prev = 0, y = 0), add the carried sums
            own = bank.losses(F.lit(0.0), F.lit(0.0))
            moved = F.zip_with(ordered._added(F.col("_S"), F.col("_K")), own, lambda a, b: a - b)
            sums = sums.withColumn("_S", F.when(F.col("_K").isNotNull(), moved).otherwise(F.col("_S"))).drop("_K")
        idx, pred = bank.leader(F.col("_S"), F.col("_x"))
        out = sums.select(*_cols(key_cols, order_cols), F.col("_x").alias("last_x"), F.col("_S").alias("S"),
                          idx.alias("leader"), pred.alias("prediction"))
        out = _with_state(out, batch, key_cols, order_cols, ["last_x", "S"]).drop("last_x", "S")
        return out, lambda done: _keep_old(state, _state_of(done, key_cols, order_cols), key_cols)

    return step


def zip_step(side: str, left: str, right: str, order_cols: Sequence[str], append: bool = False, **bucket_opts):
    """B3 on a stream: the i-th row of one side meets the i-th row of the other, whatever their rates.

    ``side`` says whether a row belongs to ``left`` or ``right``; each side comes in order of ``order_cols`` over
    the epochs.  Output ``pos`` and the two rows as structs ``x`` and ``y``.  The state is what waits
    for its partner, with its position, and one row per side with the number of rows so far; positions come
    from the two-level scan and pairs from a join on them, so no task sees a whole stream.

    ``append`` (with ``StatefulBatches(..., append_state=True)``): an epoch adds its own rows to the state and reads
    those earlier ones whose partners came, by position; what waits is not written again."""
    order_cols = list(order_cols)

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        spark = batch.sparkSession
        payload = [c for c in batch.columns if c != side]
        row = F.struct(*[F.col(f"`{c}`") for c in payload])
        counts = {left: 0, right: 0}
        if state is not None:  # one row per side
            marks = state.where("row is null").groupBy(side).agg(F.max("pos").alias("pos"))
            counts |= {r[side]: r.pos for r in marks.collect()}
        new = {}
        parts = []
        for s in (left, right):
            own = batch.where(F.col(side) == s)
            new[s] = counts[s] + own.count()
            placed = scan.row_position(own, order_cols, name="_pos", **bucket_opts) if new[s] > counts[s] else own.withColumn(
                "_pos", F.lit(0).cast("bigint"))
            parts.append(placed.select(F.lit(s).alias(side), (F.col("_pos") + counts[s]).alias("pos"), row.alias("row")))
        rows = arrived = written(parts[0].unionByName(parts[1]), "zip-rows")  # pairs and state read them
        paired = min(new.values())
        if state is not None:
            rows = rows.unionByName(state.where(F.col("row").isNotNull() & (F.col("pos") >= min(counts.values()))))
        both = rows.where(F.col("pos") < paired)
        x = both.where(F.col(side) == left).select("pos", F.col("row").alias("x"))
        y = both.where(F.col(side) == right).select("pos", F.col("row").alias("y"))
        marks = spark.createDataFrame([(s, n) for s, n in new.items()], f"{side} string, pos long").withColumn(
            "row", F.lit(None).cast(rows.schema["row"].dataType))
        kept = arrived if append else rows.where(F.col("pos") >= paired)
        return x.join(y, "pos"), kept.unionByName(marks)

    return step

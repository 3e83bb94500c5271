"""Keyed streams whose state lives in Spark's state store.

A recurrence over a key's rows per operator; an epoch reads and writes the state of the keys that
occur in it and no others, whatever the number of keys seen before (any state store
keeps them; RocksDB, see ``session.get_spark``, off the heap).  Spark checkpoints the state with the query's offsets, so a
restarted query goes on where it ended.  What the tasks run travels by value: nothing is
imported from this package outside the driver.

A key's rows of an epoch come in chunks of any order, so they are put in order first:
an epoch's rows of one key must fit a task, which the source's rate limit decides.  Where one key may hold
most of a stream, ``streaming.ordered`` runs the same recurrences as parallel scans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout


def _applied(stream: DataFrame, keys: Sequence[str], order_cols: Sequence[str], state: str, start: tuple,
             advance: Callable[[tuple, pd.DataFrame], tuple[tuple, pd.DataFrame]], **more: T.DataType) -> DataFrame:
    """``advance`` over every key's rows in order, from ``start`` or the key's ``state`` (schema) of the epochs before."""
    order = list(order_cols)
    join = pd.concat

    def run(key, rows, held):
        frame = join(list(rows)).sort_values(order, kind="stable")
        new, out = advance(held.get if held.exists else start, frame)
        held.update(new)
        yield out

    schema = T.StructType([*stream.schema.fields, *[T.StructField(n, t) for n, t in more.items()]])
    return stream.groupBy(*keys).applyInPandasWithState(run, schema, state, "append", GroupStateTimeout.NoTimeout)


def running_max_subarray(stream: DataFrame, x: str, order_cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """C4 on a stream, ``h = max(0, h + x)``, ``m = max(m, h)``: appends ``max_ending_here`` and ``max_subarray`` per key."""

    def advance(old, frame):
        h, m = old
        total = np.cumsum(frame[x].to_numpy(dtype=np.int64)) + h
        ending = total - np.minimum(np.minimum.accumulate(total), 0)
        best = np.maximum(np.maximum.accumulate(ending), m)
        return (int(ending[-1]), int(best[-1])), frame.assign(max_ending_here=ending, max_subarray=best)

    return _applied(stream, key_cols, order_cols, "h bigint, m bigint", (0, 0), advance,
                    max_ending_here=T.LongType(), max_subarray=T.LongType())


def rls(stream: DataFrame, x: str, y: str, order_cols: Sequence[str], key_cols: Sequence[str], w0: float = 0.0) -> DataFrame:
    """C7 on a stream, theta = 1 / (1 + sum x^2), w = (w0 + sum xy) theta: appends ``theta, weight, prediction`` per key."""

    def advance(old, frame):
        xs, ys = frame[x].to_numpy(dtype=float), frame[y].to_numpy(dtype=float)
        xx, xy = old[0] + np.cumsum(xs * xs), old[1] + np.cumsum(xs * ys)
        theta = 1.0 / (1.0 + xx)
        weight = (w0 + xy) * theta
        return (float(xx[-1]), float(xy[-1])), frame.assign(theta=theta, weight=weight, prediction=weight * xs)

    return _applied(stream, key_cols, order_cols, "xx double, xy double", (0.0, 0.0), advance,
                    theta=T.DoubleType(), weight=T.DoubleType(), prediction=T.DoubleType())

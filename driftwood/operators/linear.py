"""Linear models (I1-I8): scores, losses, gradients and block gradient descent.

The weight vector (features + bias) is a small parameter, passed to jobs as
a literal array; the distributed core is the gradient sum (I5): a
``posexplode`` + ``groupBy(index).sum`` that combines map-side, so every
task ships one row per weight.  Labels are 0/1; hinge and logistic map 0
to -1 as the reference does; squared and perceptron use the raw label.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.functions import vectors as vec
from driftwood.session import written

LOSSES = ("squared", "hinge", "logistic", "perceptron")


@dataclass(frozen=True)
class Loss:
    """A loss of the user's own, as Columns of label and score; it goes wherever a loss is named.

    ``gradient`` is d loss / d score; ``predict`` the class of a score (1.0 from zero on if not given).
    """

    value: Callable[[Column, Column], Column]
    gradient: Callable[[Column, Column], Column]
    predict: Callable[[Column], Column] | None = None


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _weights(w: Sequence[float] | Column) -> Column:
    if isinstance(w, Column):
        return w
    return F.array(*[F.lit(float(x)) for x in w])


def linear_score(features, weights: Sequence[float] | Column) -> Column:
    """dot(w, [x, 1]); the bias sits at index len(x).  ``weights``: numbers or an array Column."""
    return vec.vec_dot(_weights(weights), vec.append_bias(features))


def linear_score_sparse(features, weights: Sequence[float]) -> Column:
    """I1 of a map ``index -> value`` (0-based): only its entries are touched; the bias is the last weight."""
    w = _weights(weights)
    return F.aggregate(F.map_entries(_c(features)), F.lit(float(weights[-1])),
                       lambda acc, e: acc + F.get(w, e["key"].cast("int")) * e["value"].cast("double"))


def linear_predict(dot, loss: str | Loss = "squared") -> Column:
    """1/0 class from the score."""
    d = _c(dot)
    if isinstance(loss, Loss) and loss.predict is not None:
        return loss.predict(d)
    if loss == "logistic":
        return F.when(F.lit(1.0) / (F.lit(1.0) + F.exp(-d)) > 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(d >= 0, F.lit(1.0)).otherwise(F.lit(0.0))


def _pm1(label: Column, loss: str) -> Column:
    if loss == "logistic":
        return F.when(label <= 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(label == 0, F.lit(-1.0)).otherwise(F.lit(1.0))


def linear_loss(label, dot, loss: str | Loss = "squared") -> Column:
    """Per-example loss."""
    y, d = _c(label).cast("double"), _c(dot)
    if isinstance(loss, Loss):
        return loss.value(y, d)
    if loss in ("squared", "perceptron"):
        return F.lit(0.5) * (d - y) * (d - y)
    if loss == "hinge":
        v = F.lit(1.0) - _pm1(y, loss) * d
        return F.when(v < 0, F.lit(0.0)).otherwise(v)
    if loss == "logistic":
        return F.log(F.lit(1.0) + F.exp(-_pm1(y, loss) * d))
    raise ValueError(loss)


def linear_prob(dot, loss: str | Loss = "squared") -> Column:
    """I4: the reference's ``prob`` = loss(1, dot) (a loss, kept as documented)."""
    return linear_loss(F.lit(1.0), dot, loss)


def loss_gradient(label, dot, loss: str | Loss = "squared") -> Column:
    """d loss / d dot as the reference defines it (perceptron: label - predict)."""
    y, d = _c(label).cast("double"), _c(dot)
    if isinstance(loss, Loss):
        return loss.gradient(y, d)
    if loss == "squared":
        return d - y
    if loss == "hinge":
        l_ = _pm1(y, loss)
        return F.when(l_ * d < 1, -l_).otherwise(F.lit(0.0))
    if loss == "logistic":
        l_ = _pm1(y, loss)
        return -l_ * (F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(-l_ * d)))
    if loss == "perceptron":
        return y - linear_predict(d, loss)
    raise ValueError(loss)


def example_gradient(features, label, weights: Sequence[float], loss: str | Loss = "squared") -> Column:
    """I5 per row: ``-loss'(y, d) * [x, 1]`` as an array."""
    xb = vec.append_bias(features)
    ch = -loss_gradient(label, vec.vec_dot(_weights(weights), xb), loss)
    return F.transform(xb, lambda x: x * ch)


def linear_gradient(df: DataFrame, features: str, label: str, weights: Sequence[float],
                    loss: str | Loss = "squared") -> DataFrame:
    """Summed gradient ``(index, grad)`` over the table, plus ``n``.

    ``features``: a dense array, or a map ``index -> value`` of which only the entries are
    exploded (``n`` then counts rows per index; the bias has all).
    """
    if isinstance(df.schema[features].dataType, T.MapType):
        y = df.select(F.map_entries(features).alias("_e"), _c(label).cast("double").alias("_y"),
                      linear_score_sparse(features, weights).alias("_d"))
        bias = F.struct(F.lit(len(weights) - 1).alias("index"), F.lit(1.0).alias("_x"))
        entries = F.concat(F.transform("_e", lambda e: F.struct(e["key"].cast("int").alias("index"),
                                                                e["value"].cast("double").alias("_x"))), F.array(bias))
        g = y.select((-loss_gradient("_y", "_d", loss)).alias("_ch"), F.inline(entries))
        return g.groupBy("index").agg(F.sum(F.col("_x") * F.col("_ch")).alias("grad"), F.count(F.lit(1)).alias("n"))
    # score once per row, then explode: the change factor is not re-evaluated per element
    d = df.select(vec.append_bias(features).alias("_xb"), _c(label).cast("double").alias("_y"))
    d = d.select("_xb", (-loss_gradient("_y", vec.vec_dot(_weights(weights), "_xb"), loss))
                 .alias("_ch"))
    g = d.select("_ch", F.posexplode("_xb").alias("index", "_x"))
    return g.groupBy("index").agg(F.sum(F.col("_x") * F.col("_ch")).alias("grad"),
                                  F.count(F.lit(1)).alias("n"))


#: A penalty of the user's own: minus its gradient at a weight, by arithmetic that numbers and Columns both have.
Regularizer = str | Callable


def regularize(w, kind: Regularizer = "l2") -> Column:
    """Minus the penalty gradient of a weight: zero, L1 sign (0 -> +1), L2 weight, or a function of the user's own."""
    w = _c(w)
    if callable(kind):
        return kind(w)
    if kind == "zero":
        return F.lit(0.0) * w
    if kind == "l1":
        return -F.when(w >= 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    if kind == "l2":
        return -w
    raise ValueError(kind)


def regularize_py(w: float, kind: Regularizer) -> float:
    if callable(kind):
        return float(kind(w))
    if kind == "zero":
        return 0.0
    if kind == "l1":
        return -(1.0 if w >= 0 else -1.0)
    if kind == "l2":
        return -w
    raise ValueError(kind)


def linear_update(weights: DataFrame, change: DataFrame, scale: float = 1.0) -> DataFrame:
    """``w <- w + scale * change`` joined on ``index``."""
    j = weights.join(change.select("index", F.col("grad").alias("_ch")), "index", "left")
    return j.select("index", (F.col("weight") + F.lit(scale) * F.coalesce("_ch", F.lit(0.0)))
                    .alias("weight"))


def linear_train(df: DataFrame, features: str, label: str, num_features: int,
                 loss: str | Loss = "squared", steps: int = 10, learning_rate: float = 0.1,
                 reg: Regularizer = "zero", reg_param: float = 0.0,
                 init: Sequence[float] | None = None) -> list[float]:
    """I8: block gradient descent, one Spark aggregation per step.

    ``w <- w + lr * (sum(change)/n + reg_param * regularize(w))``; the
    perceptron's per-row change has the sign of an update already, so its
    direction is flipped back (the reference's uphill step, corrected).
    The returned vector has ``num_features + 1`` entries (bias last).
    """
    w = list(init) if init is not None else [0.0] * (num_features + 1)
    sign = -1.0 if loss == "perceptron" else 1.0
    for _ in range(int(steps)):
        rows = linear_gradient(df, features, label, w, loss).collect()  # num_features + 1 rows
        n = max((r["n"] for r in rows), default=0)
        if n == 0:
            break
        g = [0.0] * len(w)
        for r in rows:
            if r["index"] >= len(g):
                raise ValueError(f"a row has feature {r['index'] - 1}, the model has {num_features} features")
            g[r["index"]] = r["grad"]
        w = [wi + learning_rate * (sign * gi / n + reg_param * regularize_py(wi, reg))
             for wi, gi in zip(w, g)]
        if any(math.isnan(x) for x in w):
            break
    return w


def squared_moments(df: DataFrame, group: str, features: str, label: str, num_features: int) -> DataFrame:
    """Per group ``n``, ``xx`` (the sum of x x', row by row) and ``xy`` (the sum of y x) of x with its bias: of these the I5 gradient of the
    squared loss is xy - xx w at any weights w.  The arrays are dense, without nulls and ``num_features`` long."""
    width = num_features + 1

    def moments(t: pa.Table) -> pa.Table:
        x = t["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, width)
        y = t["y"].to_numpy()
        return pa.table({"g": pa.array([t["g"][0].as_py()], pa.int64()), "n": pa.array([t.num_rows], pa.int64()),
                         "xx": pa.array([(x.T @ x).ravel()], pa.list_(pa.float64())), "xy": pa.array([x.T @ y], pa.list_(pa.float64()))})

    rows = df.select(F.col(group).cast("long").alias("g"), vec.append_bias(features).alias("x"), _c(label).cast("double").alias("y"))
    return rows.groupBy("g").applyInArrow(moments, "g long, n long, xx array<double>, xy array<double>").withColumnRenamed("g", group)


def linear_train_epochs(df: DataFrame, epoch: str, features: str, label: str, num_features: int, loss: str | Loss = "squared", steps: int = 1,
                        learning_rate: float = 0.1, reg: Regularizer = "zero", reg_param: float = 0.0,
                        init: Sequence[float] | None = None) -> list[tuple[int, list[float]]]:
    """I8 over epochs (column ``epoch``) in their order, ``steps`` steps each: (epoch, the weights after it) of each that has rows.

    The gradient of the squared loss is linear in the weights, so one job gives all epochs' moments (``squared_moments``) and
    the steps follow one another on the driver, an epoch's moments at a time.  Other losses, maps and vectors with gaps
    take ``linear_train`` epoch by epoch.
    """
    w, out = list(init) if init is not None else [0.0] * (num_features + 1), []
    dense = not isinstance(df.schema[features].dataType, T.MapType) and loss == "squared"
    if dense:
        df = df.filter(F.col(features).isNotNull())  # a row without a vector adds nothing
        odd = (F.size(features) != num_features) | F.exists(features, lambda v: v.isNull()) | F.col(label).isNull()
        dense = df.filter(odd).isEmpty()
    if not dense:
        for (e,) in sorted(df.select(epoch).distinct().collect()):
            w = linear_train(df.filter(F.col(epoch) == e), features, label, num_features, loss, steps, learning_rate, reg, reg_param, w)
            out.append((int(e), w))
        return out
    moments = written(squared_moments(df, epoch, features, label, num_features).orderBy(epoch), "linear-moments")
    for r in moments.orderBy(epoch).toLocalIterator(prefetchPartitions=True):
        xx, xy = np.reshape(r["xx"], (num_features + 1, -1)), np.asarray(r["xy"])
        for _ in range(int(steps)):
            g = xy - xx @ np.asarray(w)
            w = [float(wi + learning_rate * (gi / r["n"] + reg_param * regularize_py(wi, reg))) for wi, gi in zip(w, g)]
            if any(math.isnan(v) for v in w):
                break
        out.append((int(r[epoch]), w))
    return out

"""Test-then-train streams: naive Bayes (F1, F2, F4) and linear models.

An epoch's rows are answered by the model of the epochs before it, then its
labelled rows train.  The model is the stream's state, a table per epoch
(``runner.StatefulBatches``): a replayed epoch reads the same version again, and
any version can be read as a model later.  Scoring and training are the
batch operators.  An epoch is a micro-batch or, with ``rows_per_epoch``, one of many in it, each of that
many consecutive rows in the order: answers and model are those of one micro-batch per epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.operators import bayes, linear
from driftwood.plans import scan
from driftwood.session import written


def _in_epochs(batch: DataFrame, order_cols: Sequence[str], rows_per_epoch: int) -> DataFrame:
    """The rows with their epoch within the micro-batch (``_epoch``, from 0), written: they are read several times."""
    placed = scan.row_position(batch, list(order_cols), name="_pos")
    return written(placed.select(*batch.columns, F.floor(F.col("_pos") / rows_per_epoch).cast("long").alias("_epoch")), "epochs")


def nb_state(model: bayes.NBModel) -> DataFrame:
    """A model as one table ``(kind, label, feature, mass)``."""
    sums = model.feature_sums.select(F.lit("feature").alias("kind"), "label", "feature", "mass")
    none = F.lit(None).cast(sums.schema["feature"].dataType)
    return sums.unionByName(model.class_counts.select(F.lit("class").alias("kind"), "label", none.alias("feature"), F.col("n").alias("mass")))


def nb_model(state: DataFrame) -> bayes.NBModel:
    """The model of a state table."""
    return bayes.NBModel(state.filter("kind = 'class'").select("label", F.col("mass").alias("n")),
                         state.filter("kind = 'feature'").select("label", "feature", "mass"))


def nb_step(id_cols: Sequence[str], features, label: str = "label", smoothing: float = 1.0, num_features: int | None = None,
            order_cols: Sequence[str] = (), rows_per_epoch: int | None = None):
    """Rows -> ``(id..., prediction)``; null while no labelled row has been seen in an earlier epoch."""

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        if rows_per_epoch:
            old = None if state is None else nb_model(state)
            answers, new = bayes.nb_test_then_train(old, _in_epochs(batch, order_cols, rows_per_epoch), "_epoch", id_cols, features, label,
                                                    smoothing, num_features)
            return answers, nb_state(new)
        new = bayes.nb_train(batch.filter(F.col(label).isNotNull()), features, label)
        if state is None or state.filter("kind = 'class'").isEmpty():
            none = F.lit(None).cast(batch.schema[label].dataType).alias("prediction")
            return batch.select(*id_cols, none), nb_state(new)
        old = nb_model(state)
        return bayes.nb_predict(old, batch, id_cols, features, smoothing, num_features, stored=True), nb_state(bayes.nb_merge(old, new))

    return step


def linear_step(id_cols: Sequence[str], features: str, label: str, num_features: int, loss: str | linear.Loss = "squared", steps: int = 1,
                learning_rate: float = 0.1, reg: linear.Regularizer = "zero", reg_param: float = 0.0, init: Sequence[float] | None = None,
                order_cols: Sequence[str] = (), rows_per_epoch: int | None = None):
    """Rows -> ``(id..., score, prediction)``; the labelled rows of an epoch make ``steps`` gradient steps."""
    start = [float(w) for w in init] if init is not None else [0.0] * (num_features + 1)

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        weights = start if state is None else [r["weight"] for r in state.orderBy("index").collect()]  # num_features + 1 rows
        if rows_per_epoch:
            rows = _in_epochs(batch, order_cols, rows_per_epoch)
            after = linear.linear_train_epochs(rows.filter(F.col(label).isNotNull()), "_epoch", features, label, num_features, loss, steps,
                                               learning_rate, reg, reg_param, weights)
            last = rows.agg(F.max("_epoch").alias("e")).first()["e"]
            before, then = [], dict(after)
            for e in range(0 if last is None else last + 1):
                before.append((e, [float(w) for w in weights]))
                weights = then.get(e, weights)
            by = batch.sparkSession.createDataFrame(before, "_epoch long, _w array<double>")  # epochs x weights
            scored = rows.join(F.broadcast(by), "_epoch").select(*id_cols, linear.linear_score(features, F.col("_w")).alias("score"))
            return (scored.withColumn("prediction", linear.linear_predict("score", loss)),
                    batch.sparkSession.createDataFrame(list(enumerate(weights)), "index int, weight double"))
        score = linear.linear_score(features, weights)
        answers = batch.select(*id_cols, score.alias("score")).withColumn("prediction", linear.linear_predict("score", loss))
        new = linear.linear_train(batch.filter(F.col(label).isNotNull()), features, label, num_features, loss, steps, learning_rate,
                                  reg, reg_param, weights)
        return answers, batch.sparkSession.createDataFrame(list(enumerate(new)), "index int, weight double")

    return step

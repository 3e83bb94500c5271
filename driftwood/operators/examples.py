"""Example tables: the long form every learner works on.

Wide form: one row per example with feature columns (or an array column),
a label column and an optional weight.  Long form: one row per
``(id..., feature, value)`` with the label and weight repeated; produced by
``posexplode``/``stack`` so it never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, id_cols: Sequence[str], features, label: str | None = None,
            weight: str | Column | None = None) -> DataFrame:
    """Wide -> long.  ``features`` is a list of numeric columns (feature index =
    list position) or the name of an array column (index = array position)."""
    keep = [F.col(c) for c in id_cols]
    if label is not None:
        keep.append(F.col(label).alias("label"))
    w = F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    keep.append(w.cast("double").alias("weight"))
    if isinstance(features, str):
        ent = F.posexplode(features).alias("feature", "value")
        out = df.select(*keep, ent)
    else:
        arr = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value"))
                        for i, c in enumerate(features)])
        out = df.select(*keep, F.inline(arr))
    return out.withColumn("value", F.col("value").cast("double"))


def code_nominal(col, domain: Sequence[str]) -> Column:
    """Nominal string -> 0-based position in the declared domain (null if unseen)."""
    c = F.col(col) if isinstance(col, str) else col
    pos = F.array_position(F.array(*[F.lit(v) for v in domain]), c)
    return F.when(pos > 0, (pos - 1).cast("double"))

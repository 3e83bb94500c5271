"""Feature-class observers (G1-G10): grouped, mergeable statistics.

Input is the long example form ``(group..., feature, value, label, weight)``
(see ``driftwood.operators.examples.to_long``); ``group`` is usually the
tree leaf.  Every statistic is additive, so Spark's partial aggregation
combines map-side and only one row per group and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions import stats as S
from driftwood.plans.scan import null_safe_join


def _valid(value="value", weight="weight"):
    v, w = F.col(value), F.col(weight)
    return (~F.isnan(v)) & (F.abs(v) != F.lit(float("inf"))) & (w > 0) & v.isNotNull()


def gaussian_stats(long: DataFrame, group_cols: Sequence[str] = ("feature", "label"),
                   value: str = "value", weight: str = "weight", two_pass: bool = True) -> DataFrame:
    """G1: weighted ``n, mean, m2, min, max`` per group.

    Rows with NaN/Inf values or weight <= 0 are skipped in ``n, mean, m2``
    (min/max ignore only non-finite values).  The squares are centred on the
    group mean from a first aggregate (one row per group, broadcast: groups are
    leaves x features x classes), so a variance that is tiny next to the squared
    mean keeps its digits; ``two_pass=False`` reads the data once and takes the power
    sums ``(sum w, sum w x, sum w x^2)`` instead.
    """
    if two_pass:
        first = gaussian_stats(long, group_cols, value, weight, two_pass=False)
        j = null_safe_join(long, F.broadcast(first.select(*group_cols, F.col("mean").alias("_m"))), group_cols, "left")
        ok2 = _valid(value, weight)
        c2 = j.groupBy(*group_cols).agg(F.coalesce(F.sum(F.when(
            ok2, F.col(weight) * F.pow(F.col(value) - F.col("_m"), 2.0))), F.lit(0.0)).alias("_c2"))
        return null_safe_join(first, c2, group_cols).select(*group_cols, "n", "mean",
                                                            F.col("_c2").alias("m2"), "min", "max")
    ok = _valid(value, weight)
    w = F.when(ok, F.col(weight))
    wx = F.when(ok, F.col(weight) * F.col(value))
    wxx = F.when(ok, F.col(weight) * F.col(value) * F.col(value))
    finite = (~F.isnan(value)) & (F.abs(F.col(value)) != F.lit(float("inf")))
    agg = long.groupBy(*group_cols).agg(
        F.coalesce(F.sum(w), F.lit(0.0)).alias("n"),
        F.coalesce(F.sum(wx), F.lit(0.0)).alias("_s1"),
        F.coalesce(F.sum(wxx), F.lit(0.0)).alias("_s2"),
        F.min(F.when(finite, F.col(value))).alias("min"),
        F.max(F.when(finite, F.col(value))).alias("max"))
    mean = F.when(F.col("n") > 0, F.col("_s1") / F.col("n")).otherwise(F.lit(0.0))
    m2 = F.when(F.col("n") > 0, F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * F.col("_s1")
                                           / F.col("n"))).otherwise(F.lit(0.0))
    return agg.select(*group_cols, "n", mean.alias("mean"), m2.alias("m2"), "min", "max")


def merge_gaussian_stats(a: DataFrame, b: DataFrame,
                         group_cols: Sequence[str] = ("feature", "label")) -> DataFrame:
    """Parallel combination of ``(n, mean, m2)``; min/max combine too."""
    u = a.unionByName(b)
    w = Window.partitionBy(*group_cols)
    tot = F.sum("n").over(w)
    u = u.withColumn("_N", tot).withColumn(
        "_mean", F.when(F.col("_N") > 0, F.sum(F.col("n") * F.col("mean")).over(w) / F.col("_N"))
        .otherwise(F.lit(0.0)))
    return u.groupBy(*group_cols).agg(
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2.0)).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"))


def gaussian_density(stats: DataFrame, value_col: str = "x") -> DataFrame:
    """G3 on a table that carries ``n, mean, m2`` and a value column."""
    return stats.withColumn("density", S.gaussian_density(value_col, "n", "mean", "m2"))


def nominal_stats(long: DataFrame, group_cols: Sequence[str] = ("feature", "label"),
                  value: str = "value", weight: str = "weight") -> DataFrame:
    """Class x value weighted counts ``(group..., value, w)``."""
    return long.groupBy(*group_cols, F.col(value).alias("value")).agg(F.sum(weight).alias("w"))


def merge_nominal_stats(a: DataFrame, b: DataFrame,
                        group_cols: Sequence[str] = ("feature", "label")) -> DataFrame:
    """Add counts."""
    return a.unionByName(b).groupBy(*group_cols, "value").agg(F.sum("w").alias("w"))


def nominal_probability(stats: DataFrame, sizes: dict[int, int], smoothing: float = 1.0,
                        group_cols: Sequence[str] = ("feature", "label")) -> DataFrame:
    """``(w + s) / (sum_class + V s)``; 0 when the class has no weight.

    ``sizes`` maps feature -> number of declared values V.
    """
    wc = Window.partitionBy(*group_cols)
    size = F.coalesce(F.try_element_at(
        F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(float(v)))]),
        F.col("feature")), F.lit(1.0)) if sizes else F.lit(1.0)
    tot = F.sum("w").over(wc)
    p = F.when(tot == 0, F.lit(0.0)).otherwise((F.col("w") + smoothing) / (tot + size * smoothing))
    return stats.select("*", p.alias("probability"))


def split_points(gstats: DataFrame, bins: int = 10,
                 group_cols: Sequence[str] = ("feature",)) -> DataFrame:
    """``bins`` equal-width cut points strictly inside (min, max), distinct.

    ``point_idx`` is the ascending position (the order candidates are tried).
    """
    mm = gstats.groupBy(*group_cols).agg(F.min("min").alias("_lo"), F.max("max").alias("_hi"))
    pts = mm.select(*group_cols, "_lo", "_hi",
                    F.explode(F.sequence(F.lit(1), F.lit(int(bins)))).alias("_i"))
    pts = pts.select(*group_cols, "_lo", "_hi",
                     ((F.col("_hi") - F.col("_lo")) * F.col("_i") / F.lit(float(bins)) + F.col("_lo"))
                     .alias("point"))
    pts = pts.filter((F.col("point") > F.col("_lo")) & (F.col("point") < F.col("_hi")))
    pts = pts.select(*group_cols, "point").distinct()
    return pts.withColumn("point_idx", F.dense_rank().over(
        Window.partitionBy(*group_cols).orderBy("point")) - 1)


def gaussian_split_weights(gstats: DataFrame, points: DataFrame,
                           group_cols: Sequence[str] = ("feature",)) -> DataFrame:
    """Expected class weight left (``< cut``) and right of each cut.

    cut < class min -> all right; cut >= class max -> all left; otherwise
    ``left = n * Phi(z)``, ``right = n * (1 - Phi(z))`` (corrected mass).
    Output long post table ``(group..., point, point_idx, branch, label, w)``.
    """
    j = gstats.join(points, list(group_cols))
    sd = F.sqrt(S.gaussian_variance("n", "m2"))
    z = (F.col("point") - F.col("mean")) / sd
    phi = F.when(sd > 0, S.normal_cdf(z)).otherwise(
        F.when(F.col("point") < F.col("mean"), F.lit(0.0)).otherwise(F.lit(1.0)))
    left = (F.when(F.col("point") < F.col("min"), F.lit(0.0))
            .when(F.col("point") >= F.col("max"), F.col("n"))
            .otherwise(F.col("n") * phi))
    right = F.col("n") - left
    both = j.select(*group_cols, "point", "point_idx", "label",
                    F.array(F.struct(F.lit(0).alias("branch"), left.alias("w")),
                            F.struct(F.lit(1).alias("branch"), right.alias("w"))).alias("_b"))
    return both.select(*group_cols, "point", "point_idx", "label", F.inline("_b"))


def nominal_binary_splits(nstats: DataFrame, group_cols: Sequence[str] = ("feature",)) -> DataFrame:
    """For each observed value v: branch 0 = (value == v), branch 1 = the rest.

    Output long post table ``(group..., split_value, branch, label, w)``.
    """
    per_class = nstats.groupBy(*group_cols, "label").agg(F.sum("w").alias("_tot"))
    values = nstats.select(*group_cols, F.col("value").alias("split_value")).distinct()
    grid = values.join(per_class, list(group_cols))
    hit = nstats.select(*group_cols, F.col("value").alias("split_value"), "label",
                        F.col("w").alias("_in"))
    j = grid.join(hit, [*group_cols, "split_value", "label"], "left")
    left = F.coalesce("_in", F.lit(0.0))
    both = j.select(*group_cols, "split_value", "label",
                    F.array(F.struct(F.lit(0).alias("branch"), left.alias("w")),
                            F.struct(F.lit(1).alias("branch"), (F.col("_tot") - left).alias("w")))
                    .alias("_b"))
    return both.select(*group_cols, "split_value", "label", F.inline("_b"))


def nominal_multiway_split(nstats: DataFrame, group_cols: Sequence[str] = ("feature",)) -> DataFrame:
    """Class distribution per value; branch = value."""
    return nstats.select(*group_cols, F.col("value").cast("int").alias("branch"), "label", "w")

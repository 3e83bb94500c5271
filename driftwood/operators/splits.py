"""Split criteria and split decisions (G11-G19) over long "post" tables.

A post table has one row per ``(candidate..., branch, label, w)``; merits
are grouped aggregates per candidate.  Candidate tables hold
leaves x features x cut points rows, never example rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions import stats as S

NEG_INF = float("-inf")


def _xlog2x(c):
    return F.when(c > 0, c * S.log2(c)).otherwise(F.lit(0.0))


def info_gain(post: DataFrame, cand_cols: Sequence[str], min_branch: float = 0.01) -> DataFrame:
    """``entropy(pre) - entropy(post)``; -inf unless >= 2 branches hold
    more than ``min_branch`` of the weight.  ``entropy = log2 S - sum x log2 x / S``."""
    cand = list(cand_cols)
    # every weight once under its branch and once under its class: two groupings on the candidate, no join
    sides = F.array(F.struct(F.lit(True).alias("_by_branch"), F.col("branch").cast("int").alias("_at")),
                    F.struct(F.lit(False).alias("_by_branch"), F.col("label").cast("int").alias("_at")))
    both = post.select(*cand, "w", F.inline(sides)).groupBy(*cand, "_by_branch", "_at").agg(
        F.sum("w").alias("_s"), F.sum(_xlog2x(F.col("w"))).alias("_wl"))
    own, total = F.col("_by_branch"), F.col("S")
    g = both.groupBy(*cand).agg(
        F.sum(F.when(~own, F.col("_s"))).alias("S"), F.sum(F.when(~own, _xlog2x(F.col("_s")))).alias("pl"),
        F.sum(F.when(own, _xlog2x(F.col("_s")))).alias("sl"), F.sum(F.when(own, F.col("_wl"))).alias("wl"),
        F.collect_list(F.when(own, F.col("_s"))).alias("_branches"))
    ent_pre = F.when(total > 0, S.log2(total) - F.col("pl") / total).otherwise(F.lit(0.0))
    ent_post = F.when(total > 0, (F.col("sl") - F.col("wl")) / total).otherwise(F.lit(0.0))
    few = F.size(F.filter("_branches", lambda x: x > total * min_branch)) < 2
    return g.select(*cand, F.when(few, F.lit(NEG_INF)).otherwise(ent_pre - ent_post).alias("merit"))


def gini_merit(post: DataFrame, cand_cols: Sequence[str]) -> DataFrame:
    """``1 - sum_b (S_b / S) * gini_b`` with ``gini_b = 1 - sum_c w^2 / S_b^2``."""
    cand = list(cand_cols)
    b = post.groupBy(*cand, "branch").agg(F.sum("w").alias("sb"), F.sum(F.col("w") * F.col("w")).alias("sq"))
    gini_b = F.lit(1.0) - F.col("sq") / (F.col("sb") * F.col("sb"))
    tot = F.sum("sb").over(Window.partitionBy(*cand))
    bb = b.select(*cand, F.when(F.col("sb") > 0, gini_b * F.col("sb") / tot).otherwise(F.lit(0.0))
                  .alias("g"))
    return bb.groupBy(*cand).agg((F.lit(1.0) - F.sum("g")).alias("merit"))


def variance_reduction(moments: DataFrame, cand_cols: Sequence[str], min_n: float = 5.0) -> DataFrame:
    """On ``(candidate..., branch, n, sum, sumsq)``:
    ``var(pre) - sum_b n_b / n * var(b)`` with ``var = (sumsq - sum^2/n)/n``
    (n truncated to an integer); 0 unless every branch has n >= 5."""
    cand = list(cand_cols)

    def var(n, s, q):
        ni = F.floor(n).cast("double")
        return F.when(ni > 0, (q - s * s / ni) / ni).otherwise(F.lit(float("nan")))

    w = Window.partitionBy(*cand)
    m = moments.select(*cand, "n", "sum", "sumsq",
                       F.sum("n").over(w).alias("_tn"), F.sum("sum").over(w).alias("_ts"),
                       F.sum("sumsq").over(w).alias("_tq"))
    agg = m.groupBy(*cand).agg(
        F.first("_tn").alias("_tn"), F.first("_ts").alias("_ts"), F.first("_tq").alias("_tq"),
        F.sum(F.col("n") / F.col("_tn") * var(F.col("n"), F.col("sum"), F.col("sumsq"))).alias("_wv"),
        F.min("n").alias("_nmin"))
    merit = F.when(F.col("_nmin") < min_n, F.lit(0.0)).otherwise(
        var(F.col("_tn"), F.col("_ts"), F.col("_tq")) - F.col("_wv"))
    return agg.select(*cand, merit.alias("merit"))


@dataclass(frozen=True)
class Criterion:
    """A split criterion for trees: ``merit(post, cand_cols)`` gives ``(cand..., merit)`` of a post table, larger is
    better; ``value_range(classes)`` is the R of the Hoeffding bound.  The merit of "do not split" is that of one branch."""

    merit: Callable[[DataFrame, Sequence[str]], DataFrame]
    value_range: Callable[[int], float]


#: G11, G12 by name.
CRITERIA = {"info_gain": Criterion(info_gain, lambda classes: math.log2(max(classes, 2))),
            "gini": Criterion(gini_merit, lambda classes: 1.0)}


def best_split_per_feature(merits: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                           tie_decimals: int = 12) -> DataFrame:
    """Best candidate per ``group`` (e.g. leaf, feature); the first maximum
    in candidate order wins.  Merits equal to ``tie_decimals`` decimals are
    ties, so float noise between mirror-image candidates cannot pick one."""
    w = Window.partitionBy(*group_cols).orderBy(F.round("merit", tie_decimals).desc(), *order_cols)
    return merits.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def range_merit(criterion: str, num_classes: int) -> float:
    return math.log2(max(num_classes, 2)) if criterion == "info_gain" else 1.0


def no_split_merit(criterion: str, pre_dist: Sequence[float]) -> float:
    """Merit of the "do not split" candidate: the criterion on one branch = pre."""
    if criterion == "info_gain":
        return NEG_INF
    if criterion == "gini":
        s = sum(pre_dist)
        return 1.0 - (1.0 - sum(x * x for x in pre_dist) / (s * s)) if s > 0 else 1.0
    return 0.0


def rank_split_suggestions(best: DataFrame, leaf_cols: Sequence[str], no_split: DataFrame | None, keep: Sequence[str] = ()) -> DataFrame:
    """Per leaf, suggestions ranked by merit (``rank`` 1 = best).

    ``best(leaf..., feature, merit, ...)`` has one row per feature;
    ``no_split(leaf..., merit)`` adds the pre-pruning candidate (feature -1)
    unless None; ``keep`` names columns of ``best`` to go along (null in that candidate).  Ties rank the later candidate first (stable ascending
    sort, last element taken): higher feature index, then "do not split".
    """
    leaf = list(leaf_cols)
    cands = best.select(*leaf, "feature", "merit", *keep, F.col("feature").alias("_ord"))
    if no_split is not None:
        cands = cands.unionByName(no_split.select(*leaf, F.lit(-1).alias("feature"), "merit",
                                                  *[F.lit(None).cast(best.schema[c].dataType).alias(c) for c in keep],
                                                  F.lit(1 << 30).alias("_ord")))
    w = Window.partitionBy(*leaf).orderBy(F.round("merit", 12).desc(), F.col("_ord").desc())
    return cands.withColumn("rank", F.row_number().over(w)).drop("_ord")


def hoeffding_bound(leaves: DataFrame, weight_col: str, criterion: str, num_classes: int,
                    delta: float = 1e-7) -> DataFrame:
    """Per leaf ``sqrt(R^2 ln(1/delta) / (2 n))``."""
    r = range_merit(criterion, num_classes)
    return leaves.withColumn("bound", S.hoeffding_bound(F.lit(r), delta, F.col(weight_col)))


def should_split(ranked: DataFrame, bounds: DataFrame, leaf_cols: Sequence[str],
                 tie_threshold: float = 0.05) -> DataFrame:
    """Per leaf: split if bound < tie or best - second > bound; a
    single suggestion always splits.  Output ``(leaf..., best_feature,
    best_merit, second_merit, bound, split)``."""
    leaf = list(leaf_cols)
    top = ranked.filter(F.col("rank") <= 2).groupBy(*leaf).agg(
        F.max(F.when(F.col("rank") == 1, F.col("feature"))).alias("best_feature"),
        F.max(F.when(F.col("rank") == 1, F.col("merit"))).alias("best_merit"),
        F.max(F.when(F.col("rank") == 2, F.col("merit"))).alias("second_merit"),
        F.count(F.lit(1)).alias("_k"))
    j = top.join(bounds.select(*leaf, "bound"), leaf)
    diff_ok = (F.col("best_merit") - F.col("second_merit")) > F.col("bound")
    split = F.when(F.col("_k") < 2, F.col("_k") > 0).otherwise(
        (F.col("bound") < F.lit(tie_threshold)) | F.coalesce(diff_ok, F.lit(False)))
    return j.select(*leaf, "best_feature", "best_merit", "second_merit", "bound", split.alias("split"))


def poor_features(ranked: DataFrame, bounds: DataFrame, leaf_cols: Sequence[str]) -> DataFrame:
    """Features whose merit trails the best by more than the bound."""
    leaf = list(leaf_cols)
    best = ranked.filter(F.col("rank") == 1).select(*leaf, F.col("merit").alias("_best"))
    j = ranked.filter(F.col("feature") >= 0).join(best, leaf).join(bounds.select(*leaf, "bound"), leaf)
    return j.filter((F.col("_best") - F.col("merit")) > F.col("bound")).select(*leaf, "feature")


def cut_moments(df: DataFrame, x: str, y: str, points: Sequence[float],
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Branch moments ``(group..., point_idx, branch, n, sum, sumsq)`` of target
    ``y`` for the binary cuts ``x < points[i]`` (branch 0) / ``>=`` (branch 1).

    Rows are aggregated once per interval between consecutive cut points
    (partial aggregation map-side), then cumulated over the few intervals:
    no row is ever paired with more than one cut.
    """
    pts = sorted(set(float(p) for p in points))
    grp = list(group_cols)
    if not pts:
        return df.sparkSession.createDataFrame(
            [], "point_idx int, branch int, n double, sum double, sumsq double")
    k = sum((F.when(F.col(x) >= F.lit(p), 1).otherwise(0) for p in pts), F.lit(0))
    mom = df.groupBy(*grp, k.alias("_k")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(y).cast("double")).alias("sum"),
        F.sum(F.col(y).cast("double") * F.col(y).cast("double")).alias("sumsq"))
    per_cut = mom.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(pts) - 1))).alias("point_idx"))
    per_cut = per_cut.withColumn("branch", F.when(F.col("_k") <= F.col("point_idx"), 0).otherwise(1))
    return per_cut.groupBy(*grp, "point_idx", "branch").agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("sumsq").alias("sumsq"))

"""Statistics helpers (K1-K4) as grouped Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions import stats as S
from driftwood.operators.observers import gaussian_stats
from driftwood.plans.scan import null_safe_join


def accuracy_with_error(df: DataFrame, prediction: str, label: str,
                        group_cols: Sequence[str] = ()) -> DataFrame:
    """K1: accuracy per group with binomial standard error sqrt(p(1-p)/n) (0 if n = 0)."""
    correct = F.when(F.col(prediction) == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))
    agg = df.groupBy(*group_cols).agg(F.avg(correct).alias("accuracy"),
                                      F.count(F.lit(1)).alias("n"))
    se = F.when(F.col("n") > 0, F.sqrt(F.col("accuracy") * (F.lit(1.0) - F.col("accuracy"))
                                       / F.col("n"))).otherwise(F.lit(0.0))
    return agg.withColumn("std_error", se)


def gaussian_tail(df: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    """K2: per group, z-score of each value against the group mean / sample sd
    and its normal CDF.  Group moments are a grouped aggregate joined back."""
    mom = df.groupBy(*group_cols).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    j = null_safe_join(df, mom, group_cols)
    z = F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mean")) / F.col("_sd"))
    return j.withColumn("z", z).withColumn("cdf", S.normal_cdf("z")).drop("_mean", "_sd")


def chi_square_test(long: DataFrame, feature: str = "feature", value: str = "value",
                    label: str = "label") -> DataFrame:
    """K3: independence of each nominal feature and the label.

    ``(feature, statistic, dof, p_value)``; the contingency table counts
    every (value, class) cell, zero cells included.
    """
    obs = long.groupBy(feature, value, label).agg(F.count(F.lit(1)).cast("double").alias("o"))
    rows = obs.groupBy(feature, value).agg(F.sum("o").alias("r"))
    cols = obs.groupBy(feature, label).agg(F.sum("o").alias("c"))
    tot = obs.groupBy(feature).agg(F.sum("o").alias("n"))
    cells = rows.join(cols, feature).join(tot, feature)  # values x classes per feature
    cells = cells.join(obs, [feature, value, label], "left").na.fill(0.0, ["o"])
    e = F.col("r") * F.col("c") / F.col("n")
    stat = cells.groupBy(feature).agg(
        F.sum(F.pow(F.col("o") - e, 2.0) / e).alias("statistic"),
        F.countDistinct(value).alias("_r"), F.countDistinct(label).alias("_c"))
    dof = ((F.col("_r") - 1) * (F.col("_c") - 1)).cast("bigint")
    return stat.select(feature, "statistic", dof.alias("dof"),
                       S.chi2_pvalue(F.col("statistic"), dof).alias("p_value"))


def anova_f_test(long: DataFrame, feature: str = "feature", value: str = "value",
                 label: str = "label") -> DataFrame:
    """K4: one-way ANOVA F ratio of each numeric feature across classes, and p.

    Only one row per (feature, class) is shuffled: ``n``, mean and the squares about the class
    mean (G1), so a large mean takes no digits.  Null, NaN and infinite values do not count.
    """
    own = long.select(feature, label, F.col(value).cast("double").alias("_v"), F.lit(1.0).alias("_w"))
    cls = gaussian_stats(own, [feature, label], "_v", "_w").where("n > 0")
    of_all = Window.partitionBy(feature)  # one row per class
    centred = cls.withColumn("_g", F.sum(F.col("n") * F.col("mean")).over(of_all) / F.sum("n").over(of_all))
    agg = centred.groupBy(feature).agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum("m2").alias("_in"),
        F.sum(F.col("n") * (F.col("mean") - F.col("_g")) * (F.col("mean") - F.col("_g"))).alias("_between"))
    between, within = F.col("_between"), F.col("_in")
    df1 = (F.col("k") - 1).cast("bigint")
    df2 = (F.col("n") - F.col("k")).cast("bigint")
    f = (between / df1) / (within / df2)
    out = agg.select(feature, f.alias("f_stat"), df1.alias("df_between"), df2.alias("df_within"))
    return out.withColumn("p_value", S.f_test_pvalue("f_stat", "df_between", "df_within"))

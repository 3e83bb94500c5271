"""Synthetic sources (A7, A8), for demos and tests; registered queries use the
driver's tables instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.functions.stats import uniform_from_text
from driftwood.plans import scan


def random_ints(spark: SparkSession, n: int, lo: int, hi: int, seed: int = 7) -> DataFrame:
    """``(seq, x)`` with n ints uniform in [lo, hi) (hash of seq: stable on recompute)."""
    u = uniform_from_text(F.col("id"), seed=seed)
    return spark.range(n).select(F.col("id").alias("seq"),
                                 (F.floor(u * (hi - lo)) + F.lit(lo)).cast("long").alias("x"))


def random_ints_stream(spark: SparkSession, lo: int, hi: int, rows_per_second: int = 10,
                       seed: int = 7) -> DataFrame:
    """A7 streaming form: the ``rate`` source."""
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    u = uniform_from_text(F.col("value"), seed=seed)
    return r.select(F.col("value").alias("seq"),
                    (F.floor(u * (hi - lo)) + F.lit(lo)).cast("long").alias("x"))


def noisy_ramp(spark: SparkSession, n: int, y0: float = 0.0, step: float = 10.0,
               sigma: float = 5.0, seed: int = 11, **bucket_opts) -> DataFrame:
    """``x = 0,1,2,...``; ``y_t = y_{t-1} + step + U(-sigma/2, sigma/2)`` (a random
    walk), i.e. ``y0`` plus a running sum, from the two-level ordered scan."""
    u = uniform_from_text(F.col("id"), seed=seed)
    base = spark.range(n).select(F.col("id").alias("seq"), F.col("id").cast("double").alias("x"),
                                 (F.when(F.col("id") == 0, F.lit(0.0)).otherwise(
                                     F.lit(step) + u * sigma - sigma / 2.0)).alias("_inc"))
    out = scan.running_sums(base, {"_cum": F.col("_inc")}, ["seq"], **bucket_opts)
    return out.select("seq", "x", (F.lit(y0) + F.col("_cum")).alias("y"))

"""Input parallelism guard for per-row heavy stages that run before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files for which a shuffle of its rows gets one partition.
BYTES_PER_PARTITION = 8 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as listed by their file system."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def spread(df: DataFrame, *keys: str, size: int | None = None) -> DataFrame:
    """``df`` partitioned by ``keys``: one partition for each ``BYTES_PER_PARTITION`` of the input (``size`` bytes, else those of its
    files), so that what one task sorts or groups does not grow with the table.

    The number is given whenever it exceeds the cores: partitions of a number that the session sets may be merged at run time
    up to a size of shuffled bytes, and rows that are taken apart after the shuffle make many times that. Smaller inputs are left
    to the session: merged partitions still number the cores."""
    n = -(-(input_bytes(df) if size is None else size) // BYTES_PER_PARTITION)
    spark = df.sparkSession
    if n > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism):
        return df.repartition(n, *keys)
    return df.repartition(*keys)


def ensure_parallelism(df: DataFrame, factor: int = 1) -> DataFrame:
    """Round-robin ``df`` when it comes from fewer files than the cluster has cores.

    A large input has far more files than cores, so this is a no-op at scale; a
    single-file input (one row group is one split) is spread before the
    expensive per-row work instead of running in one task.  Only the file
    list is looked at: nothing runs while the plan is built.
    """
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if 0 < len(df.inputFiles()) < target:
        return df.repartition(target)
    return df

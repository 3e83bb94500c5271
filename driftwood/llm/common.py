"""Shared helpers of the training-data operators.

Every operator projects its input to the named columns first, so extra input
columns (whatever their names) never clash with its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.session import scratch_path


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (null becomes the empty string), nothing else."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Hash of id and text: names a row where ids repeat, and rows equal in both alike."""
    return F.xxhash64(F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def written(df: DataFrame, name: str, partitions: Column | str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read: a lost
    executor costs only its own tasks, never the work above the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_index(lit_size: Column) -> Column:
    """0 .. size-1 as an array; empty for size 0."""
    return F.when(lit_size > 0, F.sequence(F.lit(0), lit_size - 1)).otherwise(
        F.array().cast("array<int>"))

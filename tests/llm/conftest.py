import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like table of (doc_id, text) pairs, with extra columns whose names clash with internal ones."""
    def make(rows, **more):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
        for name in ("fp", "row", "key", "h", "slot", "size", "spans", "start", "id", "sha1"):
            df = df.withColumn(name, F.lit("clash"))
        return df.select("*", *[F.lit(v).alias(k) for k, v in more.items()])

    return make


#: Rows that every operator takes: nulls, empty texts, ties, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "lost id"), (None, None),
       (5, "ünïcode ſ K “quoted” 漢字 🙂 <|endoftext|> end"), (6, "word " * 60_000), (7, "x" * 120_000)]

"""Streaming Bloom membership (D4): a data stream and a query stream share one
filter; data rows pass through unchanged.

State = the filter's first arrivals, by bit (at most m rows) or, beyond the in-plan size, by distinct value.
With ``append`` an epoch adds the arrivals of its own rows and rewrites no others; run it with
``StatefulBatches(..., append_state=True, merge=earliest)``, which joins the epochs' runs now and then.
Within a micro-batch a query sees the state plus the batch's data rows with a
smaller sequence number, exactly as the batch as-of probe (D3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.operators import membership as M


def earliest(first: DataFrame) -> DataFrame:
    """First arrivals gathered from several epochs."""
    return first.groupBy(*[c for c in first.columns if c != "first_seq"]).agg(F.min("first_seq").alias("first_seq"))


def bloom_step(kind: str = "kind", value: str = "value", seq: str = "seq",
               n: int = 1000, fpp: float = 0.01, append: bool = False):
    """Rows ``(kind in {'data','query'}, seq, value)`` -> data echo + query answers."""

    def step(batch: DataFrame, state: DataFrame | None, epoch: int):
        data = batch.filter(F.col(kind) == "data")
        queries = batch.filter(F.col(kind) == "query")
        own = M.bloom_first_seen(data, value, seq, n, fpp)
        first = own if state is None else M.merge_first_seen(own, state)
        answers = M.probe_first_seen(first, queries, value, seq, [seq, value], n, fpp)
        answers = answers.select(F.lit("query").alias(kind), seq, value, "maybe", "answer")
        echo = data.select(kind, seq, value, F.lit(None).cast("boolean").alias("maybe"),
                           F.lit(None).cast("string").alias("answer"))
        return echo.unionByName(answers), own if append else first

    return step

"""Sinks (A10): console / memory / files / foreachBatch for streams, and the
batch twin ``show``/``write``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def start_sink(stream: DataFrame, kind: str = "console", *, name: str | None = None,
               path: str | None = None, checkpoint: str | None = None,
               batch_fn: Callable[[DataFrame, int], None] | None = None,
               output_mode: str = "append", available_now: bool = True):
    """Start a streaming query into ``console``, ``memory`` (table ``name``),
    ``parquet`` (``path``) or ``foreach_batch`` (``batch_fn``)."""
    w = stream.writeStream.outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if kind == "console":
        w = w.format("console").option("truncate", "false")
    elif kind == "memory":
        w = w.format("memory").queryName(name or "driftwood_out")
    elif kind == "parquet":
        w = w.format("parquet").option("path", path)
    elif kind == "foreach_batch":
        w = w.foreachBatch(batch_fn)
    else:
        raise ValueError(kind)
    return w.start()

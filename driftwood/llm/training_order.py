"""Training-order materialisation of token ids (operator 1).

1. A task runs its documents' ids (each followed by the end id) together and
   cuts them into sequences of ``length`` ids; only a task's last one is padded. The sequences
   are written once, as a table ``(task, place, ...)``.
2. The tasks' counts (one row a task) number the N sequences densely, by task and place.
3. A Feistel network keyed by ``key`` permutes 2^(2h) >= N numbers; numbers that land outside
   0 .. N-1 walk on along their cycle until they are inside. The image of a sequence's
   number is its global slot.
4. Ranges of slots are the shards, of ``shard_bytes`` at most. A task sorts its range and
   writes it as blocks of ``block`` sequences of fixed stride (``length``
   ids of 2 bytes, 4 for vocabularies beyond 65,536), uncompressed: slot s lies in shard
   s // w (w: slots a shard), its k-th sequence (k = s mod w) in block k // block at byte
   k % block * stride.
5. A manifest has each shard's first slot. ``read_slots`` reads on from any slot, through
   the blocks that hold it and what follows.

Tokenising runs once, and ids go through one shuffle, zstd-compressed by sequence; shards take even
shares of it whatever the documents hold.  The order depends on ``key`` and on how
the input is cut into tasks, not on the run: the table of sequences is fixed once written, lost
tasks write the same again.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are sequences like any others; an empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm.common import text_rows
from driftwood.llm.tokens import bpe, default_paths
from driftwood.session import scratch_path

_U = np.uint64


class Permutation:
    """Keyed bijection of 0 .. size-1 by a balanced Feistel network with cycle walking."""

    def __init__(self, size: int, key: int, rounds: int = 6):
        if not 0 < size <= 1 << 62:
            raise ValueError("size must be in 1 .. 2^62")
        self.size, self._half = size, max(1, -(-(size - 1).bit_length() // 2))
        self._keys = [self._mix(np.array([(key + 0x9E3779B97F4A7C15 * (r + 1)) % (1 << 64)], dtype=_U))[0] for r in range(rounds)]

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = np.asarray(x, dtype=np.int64)
        if len(x) and not 0 <= x.min() <= x.max() < self.size:
            raise ValueError(f"a number is outside 0 .. {self.size - 1}")
        x = step(x.astype(_U))
        outside = np.flatnonzero(x >= _U(self.size))
        while len(outside):
            x[outside] = step(x[outside])
            outside = outside[x[outside] >= _U(self.size)]
        return x.astype(np.int64)

    def _forwards(self, x: np.ndarray) -> np.ndarray:
        mask = _U((1 << self._half) - 1)
        left, right = x >> _U(self._half), x & mask
        for k in self._keys:
            left, right = right, left ^ (self._mix(right ^ k) & mask)
        return (left << _U(self._half)) | right

    def _backwards(self, x: np.ndarray) -> np.ndarray:
        mask = _U((1 << self._half) - 1)
        left, right = x >> _U(self._half), x & mask
        for k in reversed(self._keys):
            left, right = right ^ (self._mix(left ^ k) & mask), left
        return (left << _U(self._half)) | right

    def __call__(self, x) -> np.ndarray:
        return self._walk(x, self._forwards)

    def inverse(self, y) -> np.ndarray:
        return self._walk(y, self._backwards)


_SEQUENCES = "task bigint, place bigint, n_ids bigint, first_doc bigint, first_start bigint, data binary"
_DEALT = "slot bigint, shard bigint, n_ids bigint, first_doc bigint, first_start bigint, data binary"
_BLOCKS = "shard bigint, block bigint, n bigint, n_ids array<bigint>, first_doc array<bigint>, first_start array<bigint>, data binary"


def _sequences(docs: DataFrame, length: int, dtype: str, end_id: int, paths) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe(paths).ids
        task, made, out = TaskContext.get().partitionId(), 0, []
        held: list[tuple] = []  # (doc, start, ids) not yet in a sequence
        size = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made, held, size
            if size >= length or (last and size):
                ids = np.concatenate([h[2] for h in held])
                starts = np.cumsum([0] + [len(h[2]) for h in held])
                cuts = np.arange(0, len(ids) if last else len(ids) // length * length, length)
                at = np.searchsorted(starts, cuts, side="right") - 1
                for c, k in zip(cuts.tolist(), at.tolist()):
                    part = ids[c:c + length]
                    n = len(part)
                    if n < length:
                        part = np.concatenate((part, np.full(length - n, end_id, dtype=dtype)))
                    out.append((made, n, held[k][0], held[k][1] + c - int(starts[k]), part.tobytes()))
                    made += 1
                end = len(ids) if last else int(cuts[-1]) + length
                k = int(np.searchsorted(starts, end, side="right")) - 1
                if k < len(held) and end < len(ids):
                    doc, start, own = held[k]
                    held = [(doc, start + end - int(starts[k]), own[end - int(starts[k]):].copy()), *held[k + 1:]]
                else:
                    held = []
                size = len(ids) - end
            if out and (last or len(out) >= 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * len(out), pa.int64()), *(pa.array([o[i] for o in out], pa.int64()) for i in range(4)),
                     pa.array([o[4] for o in out], pa.binary())],
                    names=["task", "place", "n_ids", "first_doc", "first_start", "data"])
                out.clear()

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array(encode(text.as_py()) + [end_id], dtype=dtype)
                held.append((doc, 0, ids))
                size += len(ids)
                if size >= 64 * length:
                    yield from emit(False)
        yield from emit(True)

    return docs.mapInArrow(run, _SEQUENCES)


def _slots(sequences: DataFrame, tasks: np.ndarray, before: np.ndarray, order: Permutation, width: int) -> DataFrame:
    """Every sequence's slot and shard; ``before``: the sequences of all tasks before each of ``tasks`` (ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        shrink = z.ZstdCompressor(level=3).compress
        for b in batches:
            task, place = (b.column(c).to_numpy() for c in ("task", "place"))
            slot = order(before[np.searchsorted(tasks, task)] + place)
            data = pa.array([shrink(x) for x in b.column("data").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(slot // width), *(b.column(c) for c in ("n_ids", "first_doc", "first_start")), data],
                names=["slot", "shard", "n_ids", "first_doc", "first_start", "data"])

    return sequences.mapInArrow(run, _DEALT)


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, key: int = 42,
                 shards: int | None = None, block: int = 128, end_id: int = 0, shard_bytes: int = 1 << 30,
                 paths: tuple[str, str] | None = None) -> None:
    """Write the sequences of ``df`` in training order under ``path`` (``sequences``, ``blocks`` and ``manifest``).

    ``shards``: as many (None: of ``shard_bytes`` at most, and at least one a shuffle partition).
    """
    spark, paths = df.sparkSession, paths or default_paths()
    dtype = "<u2" if bpe(paths).size <= 1 << 16 else "<u4"
    stride = length * int(dtype[-1])
    _sequences(text_rows(df, id_col, text_col), length, dtype, end_id, paths).write.option("compression", "zstd") \
        .option("parquet.enable.dictionary", "false").parquet(f"{path}/sequences")
    sequences = spark.read.schema(_SEQUENCES).parquet(f"{path}/sequences")
    counts = sorted((r["task"], r["n"]) for r in sequences.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a task
    tasks, sizes = (np.array([c[i] for c in counts], dtype=np.int64) for i in (0, 1))
    total = int(sizes.sum())
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * stride // shard_bytes))
    width = max(1, -(-total // shards))
    rows = _slots(sequences, tasks, np.cumsum(sizes) - sizes, Permutation(max(1, total), key), width)
    dealt = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")  # a shard a task

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        grow, now, nth, rows = z.ZstdDecompressor().decompress, None, 0, []

        def done() -> pa.RecordBatch:
            nonlocal nth
            made = pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([nth], pa.int64()), pa.array([len(rows)], pa.int64()),
                 *(pa.array([[r[i] for r in rows]], pa.list_(pa.int64())) for i in range(3)),
                 pa.array([b"".join(r[3] for r in rows)], pa.binary())],
                names=["shard", "block", "n", "n_ids", "first_doc", "first_start", "data"])
            nth += 1
            rows.clear()
            return made

        for b in batches:
            for shard, *meta, data in zip(*(c.to_pylist() for c in b.columns[1:])):
                if rows and (shard != now or len(rows) == block):
                    yield done()
                if shard != now:
                    now, nth = shard, 0
                rows.append((*meta, grow(data)))
        if rows:
            yield done()

    dealt.mapInArrow(blocks, _BLOCKS).write.option("compression", "none").option("parquet.enable.dictionary", "false") \
        .parquet(f"{path}/blocks")
    manifest = [(k, k * width, min(width, total - k * width), block, stride, dtype) for k in range(-(-total // width))]
    spark.createDataFrame(manifest, "shard bigint, first_slot bigint, n bigint, block bigint, stride bigint, dtype string") \
        .coalesce(1).write.parquet(f"{path}/manifest")


def read_slots(spark: SparkSession, path: str, start: int = 0, stop: int | None = None, with_ids: bool = True) -> DataFrame:
    """``slot, shard, place, n_ids, first_doc, first_start, ids_crc32`` (and ``ids``, padded) of slots start .. stop-1."""
    manifest = {r["shard"]: r for r in spark.read.parquet(f"{path}/manifest").collect()}
    wanted = [r for r in manifest.values() if r["first_slot"] + r["n"] > start and (stop is None or r["first_slot"] < stop)]
    shards = [r["shard"] for r in wanted]
    rows = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    if len(shards) < len(manifest):
        rows = rows.where(F.col("shard").isin(shards))
    first = {r["shard"]: (r["first_slot"], r["block"], r["stride"], r["dtype"]) for r in wanted}
    names = ["slot", "shard", "place", "n_ids", "first_doc", "first_start", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, nth, n, n_ids, doc, begin, data in zip(*(c.to_pylist() for c in b.columns)):
                slot, block, stride, dtype = first[shard]
                place = nth * block + np.arange(n)
                pick = [k for k in range(n) if slot + place[k] >= start and (stop is None or slot + place[k] < stop)]
                ids = [np.frombuffer(data, dtype=dtype, count=stride // int(dtype[-1]), offset=k * stride) for k in pick]
                columns = [pa.array(slot + place[pick]), pa.array([shard] * len(pick), pa.int64()), pa.array(place[pick]),
                           *(pa.array([x[k] for k in pick], pa.int64()) for x in (n_ids, doc, begin)),
                           pa.array([zlib.crc32(x[:n_ids[k]].astype("<u4").tobytes()) for x, k in zip(ids, pick)], pa.int64())]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names[:7]) + (", ids array<int>" if with_ids else ""))


def order_report(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the shards and list every sequence as read back."""
    path = path or scratch_path(df.sparkSession, "training-order")
    write_shards(df, path, **options)
    return read_slots(df.sparkSession, path, with_ids=False)

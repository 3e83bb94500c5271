"""Sum-of-squares online packing of token sequences (operator 4).

Documents are packed partition by partition, in the order in which the rows come.
A document's ids (then the end id) give full windows of ``capacity`` ids
as they are; the rest, s ids, goes onto the fill level h for which the sum of
the squared numbers of partially filled windows per level becomes least (h = 0
opens a window).  The numbers are kept in an array by level, so one placement
is a vector operation over the levels, whatever the number of documents.

Documents may be cut.  Two rules use that: with ``max_open`` windows open, a
rest that fits nowhere tops up the fullest window and goes on with what is
left (so a task's memory is bounded for any distribution of lengths); and at
the end of a partition the windows still open are strung together and cut into
full windows and, at the very end, pieces of a power of two.  So no sequence
needs padding.

A sequence's id is the partition's number times 2^40 plus a counter: a task
that runs again after a lost executor gives the same ids.

Defined results: a null or empty text is the end id alone; null ids and
repeated rows are packed like any others; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from driftwood.llm.common import text_rows
from driftwood.llm.tokens import bpe, default_paths

_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Packs one partition; ``out`` collects finished pieces."""

    def __init__(self, capacity: int, max_open: int, first_id: int):
        self.capacity, self.max_open, self.next_id = capacity, max_open, first_id
        self.count = np.zeros(capacity + 1, dtype=np.int64)  # open windows by fill level
        self.open: dict[int, list[list]] = {}  # level -> windows; a window is a list of pieces
        self.n_open = 0
        self.out: list[tuple] = []

    def _close(self, window: list) -> None:
        at = 0
        for doc_id, start, total, ids in window:
            self.out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, at, ids))
            at += len(ids)
        self.next_id += 1

    def _level(self, size: int) -> int:
        """The level onto which ``size`` ids go; 0: a new window."""
        c, n = self.capacity, self.count
        gain = np.zeros(c - size + 1, dtype=np.int64)
        gain[1:] = 1 - 2 * n[1:c - size + 1]  # one window less at level h
        gain += 2 * n[size:] + 1  # one more at level h + size ...
        gain[-1] -= 2 * n[c] + 1  # ... but a full window is no longer partially filled
        if size == c:
            gain[0] = 0
        gain[1:][n[1:c - size + 1] == 0] = np.iinfo(np.int64).max
        return len(gain) - 1 - int(np.argmin(gain[::-1]))  # ties: the fullest

    def _take(self, level: int) -> list:
        window = self.open[level].pop()
        self.count[level] -= 1
        self.n_open -= 1
        return window

    def _put(self, level: int, window: list) -> None:
        if level == self.capacity:
            self._close(window)
        else:
            self.open.setdefault(level, []).append(window)
            self.count[level] += 1
            self.n_open += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self._close([(doc_id, start, total, ids[start:start + self.capacity])])
            start += self.capacity
        while start < total:
            rest = ids[start:]
            level = self._level(len(rest))
            if level == 0 and self.n_open >= self.max_open:
                level = int(np.flatnonzero(self.count)[-1])
                rest = rest[:self.capacity - level]
            window = self._take(level) if level else []
            window.append((doc_id, start, total, rest.copy()))
            self._put(level + len(rest), window)
            start += len(rest)

    def finish(self) -> None:
        window, room = [], self.capacity
        for level in sorted(self.open, reverse=True):
            for old in self.open[level]:
                for doc_id, start, total, ids in old:
                    while len(ids):
                        part, ids = ids[:room], ids[room:]
                        window.append((doc_id, start, total, part))
                        start, room = start + len(part), room - len(part)
                        if room == 0:
                            self._close(window)
                            window, room = [], self.capacity
        left = self.capacity - room
        while left:  # powers of two need no padding
            size = 1 << (left.bit_length() - 1)
            cut, room = [], size
            while room:
                doc_id, start, total, ids = window.pop(0)
                cut.append((doc_id, start, total, ids[:room]))
                if len(ids) > room:
                    window.insert(0, (doc_id, start + room, total, ids[room:]))
                room -= len(cut[-1][3])
            self._close(cut)
            left -= size
        self.open, self.n_open = {}, 0
        self.count[:] = 0

    def drain(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0,
         max_open: int = 2048, paths: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``;
    ``with_ids`` adds the ids themselves (little-endian unsigned 32 bits)."""
    paths = paths or default_paths()
    names = _COLUMNS + (("ids",) if with_ids else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe(paths).ids
        packer = Packer(capacity, max_open, TaskContext.get().partitionId() << 40)

        def batch() -> pa.RecordBatch:
            rows = packer.drain()
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_COLUMNS))]
            if with_ids:
                columns.append(pa.array([r[7].tobytes() for r in rows], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=list(names))

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(doc_id, np.array(encode(text.as_py()) + [end_id], dtype="<u4"))
                if len(packer.out) >= 1_000:
                    yield batch()
        packer.finish()
        yield batch()

    schema = ", ".join(f"{c} bigint" for c in _COLUMNS) + (", ids binary" if with_ids else "")
    return text_rows(df, id_col, text_col).mapInArrow(run, schema)

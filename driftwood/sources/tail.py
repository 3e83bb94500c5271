"""Growing files as a stream of lines (A6): what is appended to a file between two triggers is read once.

``spark.readStream.format("line_tail")`` over a file or a folder, after
``register(spark)``.  The offset is the number of bytes read of every file, so a
restarted query goes on where its checkpoint ends.  Only whole lines are taken: an
epoch ends behind the last line feed that a file holds, the rest waits.  A line longer than
``max_line_bytes`` (8192) fails the query, as does a file that has become shorter; nothing is
cut or left out silently.  Appended ranges are read in parallel, in pieces of
``piece_bytes``; a piece owns the lines that start in it.  Files are opened through
``pyarrow.fs``, so any store that it knows will do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "line_tail"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Piece(InputPartition):
    def __init__(self, path: str, first: int, start: int, end: int, stop: int):
        #: bytes [start, end) of a range [first, stop) of whole lines
        self.path, self.first, self.start, self.end, self.stop = path, first, start, end, stop


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, max_line: int, piece: int):
        self.path, self.max_line, self.piece = path, max_line, piece

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def _files(self) -> list[tuple[str, int]]:
        store, root = _open(self.path)
        info = store.get_file_info(root)
        if info.type == pafs.FileType.NotFound:
            return []
        found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root, recursive=True))
        return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))

    def latestOffset(self) -> dict:
        store, _ = _open(self.path)
        ends = {}
        for path, size in self._files():
            with store.open_input_file(path) as f:
                low = max(0, size - self.max_line - 1)
                f.seek(low)
                tail = f.read(size - low)
            cut = tail.rfind(b"\n")
            if cut < 0 and len(tail) > self.max_line:
                raise ValueError(f"{path}: a line of over {self.max_line} bytes ends at byte {size} or later")
            ends[path] = low + cut + 1 if cut >= 0 else 0
        return {"files": json.dumps(ends)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        old, new, out = json.loads(start["files"]), json.loads(end["files"]), []
        for path, stop in new.items():
            first = old.get(path, 0)
            if stop < first:
                raise ValueError(f"{path} has become shorter: {first} bytes were read, whole lines end at {stop} now")
            out += [Piece(path, first, at, min(stop, at + self.piece), stop) for at in range(first, stop, self.piece)]
        return out

    def read(self, part: Piece) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        with store.open_input_file(part.path) as f:
            low = part.start - (part.start > part.first)
            f.seek(low)
            data = f.read(part.end - low)
            at = low
            if part.start > part.first:  # the line that began before belongs to the piece before
                cut = data.find(b"\n")
                if cut < 0:
                    return
                at, data = low + cut + 1, data[cut + 1:]
            while data and not data.endswith(b"\n") and part.end < part.stop:  # the last line's end
                more = f.read(min(self.max_line + 1, part.stop - f.tell()))
                cut = more.find(b"\n")
                data += more if cut < 0 else more[:cut + 1]
                if cut >= 0 or not more or len(more) > self.max_line:
                    break
        lines = data.split(b"\n")
        lines = lines[:-1] if not lines[-1] else lines
        for k in range(0, len(lines), 10_000):
            group = lines[k:k + 10_000]
            starts = []
            for line in group:
                if len(line) > self.max_line:
                    raise ValueError(f"{part.path}: the line at byte {at} has {len(line)} bytes, over {self.max_line}")
                starts.append(at)
                at += len(line) + 1
            yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(group)), pa.array(starts, pa.int64()),
                                              pa.array([x.decode("utf-8", "replace") for x in group])], names=["file", "at", "value"])

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, at bigint, value string"

    def streamReader(self, schema) -> TailReader:
        # option names come in lower case
        return TailReader(self.options["path"], int(self.options.get("max_line_bytes", 8192)),
                          int(self.options.get("piece_bytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TailSource)


def tail_lines(spark: SparkSession, path: str, max_line_bytes: int = 8192, piece_bytes: int = 64 << 20) -> DataFrame:
    """The lines of a growing file or folder as a stream: ``file``, ``at`` (first byte) and ``value``."""
    register(spark)
    return spark.readStream.format(NAME).option("path", path).option("max_line_bytes", max_line_bytes).option(
        "piece_bytes", piece_bytes).load()

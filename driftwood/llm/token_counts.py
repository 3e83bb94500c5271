"""Token counts by a two-tier lookup on the map side (operator 11).

A text is cut into units (pre-tokens) that the tokenizer never merges across, so
its number of tokens is the sum over its units.  Two tiers give a unit's number:

1. a compact table of the frequent units and their numbers of tokens, broadcast.
   It is packed into one buffer (``pack_units``) of at most ``entries`` units of
   ``unit_chars`` characters, whatever the size of the corpus;
2. a cache in each Python worker for the others.  A batch's unknown units are
   encoded together by the tokenizer's own library.  A full cache drops its older
   half; units longer than ``unit_chars`` are encoded and not kept.

No unit is ever shuffled.  The frequent units are found in a pass over all texts:
a task keeps a Misra-Gries summary (``room`` counters, so any unit with over
1/room of the task's units is in it) and sends one packed buffer; the buffers are
merged 64 at a time until one is left.  Its content decides about speed only.

Units.  A SentencePiece model without normalisation, whose pieces hold spaces in
front only and no line feed, is cut before spaces and around line feeds; a unit is
encoded behind a line feed, so no prefix is added to it.  Other SentencePiece
models are counted text by text.  For a ``.json`` file the units are those of the
tokenizer's own pre-tokenizer; texts that hold the string of an added token are
counted whole by the library.

Long texts are cut into slices of about ``slice_chars`` characters at unit borders,
so that a task's memory does not follow the longest text.

Defined results: a null text is empty (0 bytes, 0 tokens); null ids and repeated
rows give a row each; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import text_rows, written

_CUT = re.compile("[ ▁]*+[^ ▁\n]++|[ ▁]++").findall
_BORDER = re.compile("(?<![ ▁])[ ▁]|\n")  # runs of spaces stay together
_FAN = 64


def default_model() -> str:
    import public_tokenizers as p

    return p.path("piece_bpe_32k.model")


class PieceUnits:
    """Units of a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self._sp = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        self.cuts = (not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
                     and rules.escape_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
                     and model.trainer_spec.model_type == 2 and 4 not in kinds  # BPE, no pieces of the user's own
                     and not any("\n" in p.piece or "▁" in p.piece.lstrip("▁") for p in model.pieces))
        if self.cuts:
            self._behind = len(self._sp.encode("\n"))  # the prefix and the line feed

    def whole(self, text: str) -> int | None:
        """The number for texts that cannot be cut, else None."""
        return None if self.cuts else len(self._sp.encode(text))

    def first(self, text: str) -> str:
        return " " + text if text else text  # the library puts a space before a text

    def units(self, text: str) -> tuple[list[str], int]:
        """Units and the number of tokens besides them."""
        return _CUT(text), text.count("\n") * (self._behind - 1)

    def border(self, text: str, at: int) -> int:
        """The first place from ``at`` on where a cut is safe."""
        found = _BORDER.search(text, at)
        return found.start() if found else len(text)

    def numbers(self, units: list[str]) -> list[int]:
        return [len(x) - self._behind for x in self._sp.encode(["\n" + u for u in units], num_threads=1)]


class JsonUnits:
    """Units of a ``tokenizers`` file."""

    cuts = True

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self._added = [t["content"] for t in json.load(f)["added_tokens"]]

    def whole(self, text: str) -> int | None:
        if self._tok.pre_tokenizer is None or any(s in text for s in self._added):
            return len(self._tok.encode(text, add_special_tokens=False).ids)
        return None

    def first(self, text: str) -> str:
        return text

    def units(self, text: str) -> tuple[list[str], int]:
        if self._tok.normalizer is not None:
            text = self._tok.normalizer.normalize_str(text)
        return [u for u, _ in self._tok.pre_tokenizer.pre_tokenize_str(text)], 0

    def border(self, text: str, at: int) -> int:
        return len(text)  # the pre-tokenizer's rules are its own

    def numbers(self, units: list[str]) -> list[int]:
        tokens = self._tok.model.tokenize
        return [len(tokens(u)) for u in units]


_LOADED: dict[str, PieceUnits | JsonUnits] = {}
_CACHES: dict[str, dict[str, int]] = {}


def model_of(path: str) -> PieceUnits | JsonUnits:
    """One instance per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = JsonUnits(path) if path.endswith(".json") else PieceUnits(path)
    return _LOADED[path]


def slices(model, text: str, size: int) -> Iterator[str]:
    text, at = model.first(text), 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else model.border(text, at + size)
        yield text[at:end]
        at = end


def pack_units(counts: dict[str, int]) -> bytes:
    """Units and numbers in one buffer: count, byte lengths, numbers, UTF-8."""
    raw = [u.encode("utf-8", "surrogatepass") for u in counts]
    return b"".join([np.array([len(raw)], "<u4").tobytes(), np.array([len(r) for r in raw], "<u4").tobytes(),
                     np.array(list(counts.values()), "<i8").tobytes(), *raw])


def unpack_units(data: bytes) -> dict[str, int]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = 4 + 12 * n + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)
    starts = [4 + 12 * n, *ends[:-1].tolist()]
    names = [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts, ends.tolist())]
    return dict(zip(names, np.frombuffer(data, "<i8", n, 4 + 4 * n).tolist()))


def thinned(counts: dict[str, int], room: int) -> dict[str, int]:
    """Misra-Gries: at most ``room`` units, every count less by the (room+1)-th largest."""
    if len(counts) <= room:
        return counts
    values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    cut = int(np.partition(values, len(values) - room - 1)[len(values) - room - 1])
    return {u: n - cut for u, n in counts.items() if n > cut}


def frequent_units(df: DataFrame, model: str, entries: int = 32_768, unit_chars: int = 48, text_col: str = "text",
                   slice_chars: int = 1 << 18) -> bytes:
    """The packed table of the most frequent units of all texts and their numbers of tokens."""
    room = 2 * entries

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, counts = model_of(model), Counter()
        for b in batches:
            for text in b.column(0):
                text = text.as_py()
                if m.cuts and m.whole(text) is None:
                    for part in slices(m, text, slice_chars):
                        counts.update(m.units(part)[0])
                if len(counts) > 4 * room:
                    counts = Counter(thinned({u: n for u, n in counts.items() if len(u) <= unit_chars}, room))
        kept = thinned({u: n for u, n in counts.items() if len(u) <= unit_chars and n > 1}, room)
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([pack_units(kept)], pa.binary())], names=["part", "units"])

    def merge(table: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for data in table.column("units"):
            counts.update(unpack_units(data.as_py()))
            if len(counts) > 4 * room:
                counts = Counter(thinned(counts, room))
        return pa.table({"part": table.column("part").slice(0, 1),
                         "units": pa.array([pack_units(thinned(counts, room))], pa.binary())})

    schema = "part bigint, units binary"
    texts = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    level = written(texts.mapInArrow(summary, schema), "unit-summaries")
    n = (level.agg(F.max("part").alias("n")).first()["n"] or 0) + 1
    while n > 1:  # a task merges the summaries of 64 others
        level = level.groupBy((F.col("part") / F.lit(_FAN)).cast("bigint").alias("to")).applyInArrow(merge, schema)
        level = level.withColumn("part", (F.col("part") / F.lit(_FAN)).cast("bigint"))
        n = -(-n // _FAN)
        if n > 1:
            level = written(level, "unit-summaries")
    last = level.first()
    counts = unpack_units(bytes(last["units"])) if last else {}
    names = sorted(counts, key=lambda u: (-counts[u], u))[:entries]
    return pack_units(dict(zip(names, model_of(model).numbers(names))))


class Counts:
    """Numbers of tokens of texts, by the table, then by the worker's cache."""

    def __init__(self, model, table: dict[str, int], cache: dict[str, int], cache_units: int, unit_chars: int, slice_chars: int):
        self.m, self.table, self.cache = model, table, cache
        self.room, self.unit_chars, self.slice_chars = cache_units, unit_chars, slice_chars

    def _missed(self, units: list[str]) -> int:
        cache = self.cache
        found = list(map(cache.get, units))
        if None not in found:
            return sum(found)
        new = list({u for u, n in zip(units, found) if n is None})
        fresh = dict(zip(new, self.m.numbers(new)))
        if len(cache) + len(fresh) > self.room:
            for u in list(cache)[:self.room // 2]:  # the older half
                del cache[u]
        cache.update((u, n) for u, n in fresh.items() if len(u) <= self.unit_chars)
        return sum(fresh[u] if n is None else n for u, n in zip(units, found))

    def count(self, text: str) -> int:
        whole = self.m.whole(text)
        if whole is not None:
            return whole
        total, get = 0, self.table.get
        for part in slices(self.m, text, self.slice_chars):
            units, more = self.m.units(part)
            known = list(map(get, units))
            missed = [u for u, n in zip(units, known) if n is None] if None in known else []
            total += more + sum(filter(None, known)) + (self._missed(missed) if missed else 0)
        return total


def count_tokens(df: DataFrame, model: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text",
                 table: bytes | None = None, entries: int = 32_768, cache_units: int = 1 << 18, unit_chars: int = 48,
                 slice_chars: int = 1 << 18) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``table``: a packed table of another run (``frequent_units``); None: made from ``df``.
    """
    model = model or default_model()
    if table is None:
        table = frequent_units(df, model, entries, unit_chars, text_col, slice_chars)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(model_of(model), unpack_units(shared.value), _CACHES.setdefault(model, {}), cache_units, unit_chars,
                        slice_chars)
        for b in batches:
            numbers = [counts.count(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers, pa.int64()),
                                              pa.array([n > limit for n in numbers], pa.bool_())],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = text_rows(df, id_col, text_col).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")

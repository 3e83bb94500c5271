"""Language identification by compression (operator 9).

Training takes a bounded sample of labelled texts (``sample_docs`` per language,
those with the least hashes) and joins them to one raw-content zstandard
dictionary of at most ``dict_bytes`` per language.  A text is normalised
(lower case, letters only, single spaces), cut into blocks of ``block_bytes``
and every block is compressed with each dictionary; the language with the
smallest total wins.  Blocks keep the dictionary, not the text's own past, the
main context, so whole texts of any length are scored alike and in bounded
memory.

``score`` is the margin (second - best) / second.  ``rejected`` marks texts
without a letter and texts whose margin is below ``min_margin``; the language
is still named for the latter.

Defined results: null or letter-free texts give ``und`` and score 0, as every text
does if nothing was learned; ties go to the language with more training rows,
then by name; null ids are never held out; each input row gives one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def normalised(text: str | None) -> bytes:
    """Lower-case letters with single spaces; empty if there is no letter."""
    out = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    # other numerals (fractions, Roman numbers) pass the pattern but are no letters
    return out.encode("utf-8", "ignore") if any(map(str.isalpha, out)) else b""


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = 300, dict_bytes: int = 1 << 17, total_bytes: int = 1 << 24) -> dict[str, bytes]:
    """Raw dictionary per language, in order of falling numbers of rows.

    The sample is bounded: ``sample_docs`` texts a language, of which ``dict_bytes``
    (less if all languages together would pass ``total_bytes``) are used.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                     F.col(f"`{lang_col}`").alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return {}
    langs = sorted(counts, key=lambda k: (-counts[k], k))
    # about twice the sample by hash, then exactly the sample: no language's rows meet in one task
    h = F.xxhash64(F.col("id").cast("string"), F.length("text"))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, (2 * sample_docs + 50) / counts[k])))])
    some = rows.withColumn("h", h).where((F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))) < share[F.col("lang")])
    least = Window.partitionBy("lang").orderBy("h", "id", "text")
    sample = some.withColumn("r", F.row_number().over(least)).where(F.col("r") <= sample_docs).select("lang", "r", "text")
    size = min(dict_bytes, total_bytes // len(langs))
    parts: dict[str, list[bytes]] = {k: [] for k in langs}
    for r in sorted(sample.collect(), key=lambda r: r["r"]):
        parts[r["lang"]].append(normalised(r["text"]))
    out = {}
    for k in langs:
        # texts share the room, so a single long one does not fill it
        room = max(256, size // max(1, len(parts[k])))
        short = b" ".join(p[:room] for p in parts[k])
        rest = b" ".join(p[room:] for p in parts[k])
        out[k] = (rest[:max(0, size - len(short))] + b" " + short)[-size:]
    return {k: v for k, v in out.items() if len(v) >= 8}


class Sizes:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int, block_bytes: int):
        import zstandard as z

        self.langs, self.block = list(dictionaries), block_bytes
        self._compress = []
        for raw in dictionaries.values():
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self._compress.append(z.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                                   write_content_size=False, write_dict_id=False).compress)

    def __call__(self, data: bytes) -> list[int]:
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(c(b)) for b in blocks) for c in self._compress]

    def best(self, text: str | None) -> tuple[str, float]:
        data = normalised(text)
        if not data or not self.langs:
            return UNKNOWN, 0.0
        sizes = self(data)
        k = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != k]
        return self.langs[k], (min(others) - sizes[k]) / min(others) if others else 1.0


def identify(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             min_margin: float = 0.002, level: int = 5, block_bytes: int = 1 << 13, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` (and the ``keep`` columns) of every row."""
    kept = [F.col(f"`{c}`") for c in keep]
    text = [] if text_col in keep and dict(df.dtypes)[text_col] == "string" else [F.col(f"`{text_col}`").cast("string").alias("_text")]
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), *kept, *text)
    at = len(keep) + 1 if text else 1 + list(keep).index(text_col)  # a kept text goes to Python once
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)  # at most total_bytes of train()
    width = len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value, level, block_bytes)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                found = [sizes.best(t.as_py()) for t in b.column(at)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:width], pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()),
                     pa.array([f[0] == UNKNOWN or f[1] < min_margin for f in found], pa.bool_())],
                    names=[f.name for f in b.schema][:width] + ["lang_pred", "score", "rejected"])

    schema = T.StructType(list(rows.schema)[:width] + [T.StructField("lang_pred", T.StringType()), T.StructField(
        "score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def keep_identified(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """The rows of ``df`` (all columns) that are not rejected."""
    at = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    inner = df.select(*[F.col(f"`{c}`").alias(a) for c, a in at.items()])
    found = identify(inner, dictionaries, at[id_col], at[text_col], keep=tuple(at.values()), **options)
    return found.where(~F.col("rejected")).select(*[F.col(a).alias(c) for c, a in at.items()])

"""Document fingerprints by consistent weighted sampling (operator 3).

A text is a bag of lower-case words with their counts as weights.  For sample
k, every word draws r and c from Gamma(2, 1) and b from U(0, 1), all from a
hash of the word; with weight w it takes the level t = floor(ln w / r + b) and
the value ln a = ln c - r (t - b) - r.  The sample is the (word, t) with the
least value.  Two texts have equal samples with a probability equal to their
generalised Jaccard similarity, sum of minima over sum of maxima of the weights
(Ioffe, "Improved Consistent Sampling, Weighted Minhash and L1 Sketching",
2010).  A fingerprint is ``samples`` 16-bit hashes of the samples, in hex; the
likeness of two is the share of equal ones.

``chain`` brings every document together with the next one (descending id):
documents go to ranges of ids (bounds from approximate quantiles, about
``range_bytes`` of text each); the first document of a range goes to the range before
it as well.  So texts are shuffled once, and a task streams through its sorted ranges holding
two documents at a time.

Defined results: a null text is empty; texts without words have the fingerprint
of zeros and are alike 1 to one another; rows with one id follow each other in
order of text; null ids come last; a single document is its own next; empty
tables give an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import text_rows

_WORDS = re.compile(r"\w+").findall
_NULL = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """Signatures of texts; keeps the draws of up to ``room`` words."""

    def __init__(self, samples: int = 64, seed: int = 42, room: int = 1 << 16):
        self.k, self.seed, self.room = samples, seed, room
        self._row: dict[str, int] = {}
        self._hash = np.zeros(room, dtype=np.uint64)
        # for weight 1 the level is 0 and ln a = ln c + r b - r
        self._one, self._r, self._b, self._c = (np.zeros((room, samples), dtype=np.float32) for _ in range(4))
        # one 64-bit hash gives two uniform numbers
        self._salt = _mix(np.arange(1, (5 * samples + 1) // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _draw(self, words: list[str]) -> None:
        from xxhash import xxh64_intdigest

        at = len(self._row)
        h = np.array([xxh64_intdigest(w.encode("utf-8", "surrogatepass"), self.seed) for w in words], dtype=np.uint64)
        u = _mix(h[:, None] ^ self._salt[None, :]).view(np.uint32)[:, :5 * self.k].astype(np.float32)
        u = ((u + np.float32(0.5)) * np.float32(2.0 ** -32)).reshape(len(words), 5, self.k)
        r, c = -np.log(u[:, 0] * u[:, 1]), np.log(-np.log(u[:, 2] * u[:, 3]))
        rows = slice(at, at + len(words))
        self._hash[rows], self._r[rows], self._c[rows], self._b[rows] = h, r, c, u[:, 4]
        self._one[rows] = self._c[rows] + self._r[rows] * self._b[rows] - self._r[rows]
        self._row.update(zip(words, range(at, at + len(words))))

    def _rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self._row]
        if len(self._row) + len(new) > self.room:
            self._row.clear()
            new = words
        if new:
            self._draw(new)
        return np.fromiter(map(self._row.__getitem__, words), dtype=np.int64, count=len(words))

    def signature(self, text: str) -> np.ndarray:
        """``samples`` unsigned 16-bit values."""
        counts = Counter(_WORDS(text.lower()))
        words = list(counts)
        least = np.full(self.k, np.inf, dtype=np.float32)
        out = np.zeros(self.k, dtype=np.uint64)
        step = self.room // 2
        for at in range(0, len(words), step):  # long texts in parts: the minimum is over all of them
            part = words[at:at + step]
            rows = self._rows(part)
            weights = np.fromiter((counts[w] for w in part), dtype=np.float32, count=len(part))
            a = self._one[rows]
            more = np.flatnonzero(weights > 1)
            level = np.zeros((len(more), self.k), dtype=np.float32)
            if len(more):
                own = rows[more]
                r, b = self._r[own], self._b[own]
                level = np.floor(np.log(weights[more])[:, None] / r + b)
                a[more] = self._c[own] - r * (level - b) - r
            best = a.argmin(axis=0)
            value = a[best, np.arange(self.k)]
            slot = np.full(len(part), -1)
            slot[more] = np.arange(len(more))
            at_level = np.where(slot[best] >= 0, level[np.maximum(slot[best], 0), np.arange(self.k)] if len(more) else 0, 0)
            code = _mix(self._hash[rows[best]] + at_level.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            better = value < least
            least[better], out[better] = value[better], code[better] >> np.uint64(48)
        return out.astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples."""
    return float(np.mean(a == b))


def _ranges(df: DataFrame, range_bytes: int) -> tuple[np.ndarray, dict[int, int], dict[int, int]]:
    """Bounds of the id ranges; by range its largest id and the range that needs that document.

    What reaches the driver is three numbers per ``range_bytes`` of text.
    """
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    # several ranges a partition even out what hashing puts together
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) * 16, -(-size // range_bytes))
    ids = df.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(10_000, 4 * n)).alias("q")).first()["q"]
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)

    def locate(batches):
        for b in batches:
            x = b.column(0).to_numpy()
            k = np.searchsorted(bounds, x)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(x)], names=["k", "doc_id"])

    tops = {r["k"]: r["top"] for r in ids.mapInArrow(locate, "k bigint, doc_id bigint").groupBy("k").agg(
        F.max("doc_id").alias("top")).collect()}
    full = sorted(tops)
    return bounds, tops, {k: full[(i + 1) % len(full)] for i, k in enumerate(full)}


def chain(df: DataFrame, work: Callable[[], Callable], schema: str, id_col: str = "doc_id", text_col: str = "text",
          range_bytes: int = 1 << 25) -> DataFrame:
    """Rows of ``work()(doc_id, text, next_text)`` for every document and the next by descending id.

    ``work()`` is made once a task; each call gives a tuple for ``schema``.
    """
    docs = text_rows(df, id_col, text_col)
    bounds, tops, needed = _ranges(docs, range_bytes)
    top = np.array([tops.get(k, 0) for k in range(len(bounds) + 1)], dtype=np.int64)
    to = np.array([needed.get(k, 0) for k in range(len(bounds) + 1)], dtype=np.int64)

    def deal(batches):
        for b in batches:
            x = b.column(0).fill_null(_NULL).to_numpy()
            k = np.searchsorted(bounds, x)
            first = np.flatnonzero(x == top[k])
            own = [pa.array(k), b.column(0), b.column(1), pa.array(np.zeros(len(k), dtype=bool))]
            yield pa.RecordBatch.from_arrays(own, names=["range", "doc_id", "text", "extra"])
            if len(first):
                pick = pa.array(first)
                yield pa.RecordBatch.from_arrays([pa.array(to[k[first]]), b.column(0).take(pick), b.column(1).take(pick),
                                                  pa.array(np.ones(len(first), dtype=bool))],
                                                 names=["range", "doc_id", "text", "extra"])

    dealt = docs.mapInArrow(deal, "range bigint, doc_id bigint, text string, extra boolean")
    rows = dealt.repartition("range").sortWithinPartitions("range", "extra", F.col("doc_id").desc_nulls_last(), "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, names, held, out = work(), [c.strip().split()[0] for c in schema.split(",")], None, []
        types = [{"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.strip().split()[1]]
                 for c in schema.split(",")]

        def batch():
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        for b in batches:
            for at, doc_id, text, extra in zip(*(c.to_pylist() for c in b.columns)):
                if held is not None and held[0] == at:  # of several extra rows the first is the next document
                    out.append(call(held[1], held[2], text))
                held = None if extra else (at, doc_id, text)
                if len(out) >= 1000:
                    yield batch()
        yield batch()

    return rows.mapInArrow(walk, schema)


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 64,
                      seed: int = 42) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last half replaced by the next document's start)."""
    def work():
        sampler = Sampler(samples, seed)
        last: list = [None, None]  # the next document's signature is wanted again right after

        def signature(text):
            if last[0] != text:
                last[:] = [text, sampler.signature(text)]
            return last[1]

        def row(doc_id, text, following):
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            own, changed = signature(text), sampler.signature(edited)
            after = signature(following)
            return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    own.byteswap().tobytes().hex(), changed.byteswap().tobytes().hex(), likeness(own, changed), likeness(own, after))

        return row

    return chain(df, work, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double", id_col, text_col)

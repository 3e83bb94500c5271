"""Removal of repeated byte strings (operator 6).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the table (in the same document too) is removed.  The method is the
column-wise construction of the Burrows-Wheeler transform and the common-prefix
array of a collection (Bauer, Cox, Rosone 2013; Cox et al. 2016): round j puts
the suffixes of length j of all strings into the sorted order, one symbol per
string.  Over whole documents this needs as many rounds as the longest document
has bytes, each reading the whole transform, so it is applied to the fragments
that can hold a repeat, in collections of bounded size:

1. Anchors.  Of the hashes of all ``gram``-byte strings inside a window of ``length``
   bytes the least is the window's key.  Equal windows have equal keys; windows
   in a row with the same leftmost least gram form a fragment.
2. A key with one fragment in the table cannot hold a repeat.  Fragments of one
   key and equal hash, two or more, are repeated whole.
3. Only keys with several different fragments are left: one copy of each is
   fetched and cut at the anchors of longer grams in the same way; what still differs under
   one key goes through the column-wise construction, the common anchor as one mark.  A window is repeated if its
   common prefix with a neighbour in the sorted order has ``length`` bytes.
   A key whose fragments exceed ``group_bytes`` (a frequent short line in
   many contexts) is not collected: its windows are counted by their 128-bit
   hash instead.
4. The repeated windows of all copies become byte ranges per document.

All groupings are sums or joins that AQE can split; a document's ranges go to the document's
row only.

Defined results: a null text is empty; repeated rows (also with one id, or a
null one) are documents of their own and repeat each other; texts shorter than
``length`` bytes keep everything; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import text_rows, written

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64; kept per process, at most twice the longest text."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.full(max(1 << 16, 2 * n), base, dtype=_U)
        got[0] = 1
        _POWERS[base] = got = np.multiply.accumulate(got)
    return got[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hashes:
    """Hash of any substring from prefix sums of byte * base^position."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        n = len(data)
        self._inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        self._sums = np.zeros(n + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * _powers(base, n), out=self._sums[1:])

    def of(self, start, end) -> np.ndarray:
        """Hashes of data[start:end]; slices of equal length or index arrays."""
        return _mix((self._sums[end] - self._sums[start]) * self._inverse[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self._sums) - 1
        return _mix((self._sums[length:] - self._sums[:n + 1 - length]) * self._inverse[:n + 1 - length])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(_U).max, dtype=_U)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def fragments(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, hash, first window, number of windows) of the fragments of one text."""
    if len(data) < length:
        return tuple(np.zeros(0, dtype=t) for t in (_U, _U, np.int64, np.int64))
    hashes = Hashes(data)
    grams = hashes.all(gram)
    least = _sliding_min(grams, length - gram + 1)
    # the least gram changes, or it was the window's first and is left behind
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[:len(least) - 1] == least[:-1])
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, len(least)))
    return least[start], hashes.of(start, start + windows - 1 + length), start, windows


def sorted_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which of its windows of ``length`` bytes occur again in the collection.

    Column-wise construction: ``bwt`` holds the symbol before every suffix so
    far (0: string start, else byte + 1; UTF-8 leaves room), ``lcp`` the
    common prefix with the suffix before it, ``name`` which suffix it is.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(strings), dtype=np.uint8) + np.uint8(1)
    # longest strings first, so that the strings still growing are the first ones
    by_size = np.argsort(-sizes, kind="stable")
    ends, left = ends[by_size], sizes[by_size]
    bwt = np.where(left > 0, text[ends - 1], 0).astype(np.uint8)
    lcp, name = np.zeros(m + 1, dtype=np.int32), None
    at, ended = np.arange(m), int(np.count_nonzero(left == 0))
    for j in range(1, int(left[0]) + 1 if m else 0):
        growing = int(np.searchsorted(-left, -j, side="right"))
        at = at[:growing]
        order = np.argsort(bwt, kind="stable")
        place = np.empty(len(bwt), dtype=np.int32)
        place[order] = np.arange(len(bwt), dtype=np.int32)
        rank = place[at].astype(np.int64)
        # common prefixes of the new suffixes and of those right after them
        check = np.concatenate((rank, rank + 1))
        check.sort()
        check = check[np.append(check[:-1] != check[1:], True)]
        if check[-1] == len(bwt):
            check = check[:-1]
        here, before = order[check], order[check - 1]
        same = (check > 0) & (bwt[here] == bwt[before])
        common = np.zeros(len(check), dtype=np.int32)
        if same.any():
            # minima over (before, here]; each pair's odd range is thrown away
            lo, hi = before[same] + 1, here[same] + 1
            by = np.argsort(lo, kind="stable")
            pairs = np.empty(2 * len(lo), dtype=np.int64)
            pairs[0::2], pairs[1::2] = lo[by], hi[by]
            least = np.empty(len(lo), dtype=np.int32)
            least[by] = np.minimum.reduceat(lcp, pairs)[0::2]
            common[same] = least + 1
        new_at = m + rank - ended
        old = np.ones(len(bwt) + growing, dtype=bool)
        old[new_at] = False
        more = left[:growing] > j
        before_ended = ended
        ended += growing - int(np.count_nonzero(more))
        old = np.flatnonzero(old)
        grown = np.empty(len(bwt) + growing, dtype=np.uint8)
        grown[old] = bwt
        grown[new_at] = np.where(more, text[ends[:growing] - j - more], 0)
        lcp_ = np.zeros(len(grown) + 1, dtype=np.int32)
        lcp_[old] = lcp[:-1]
        lcp_[m + check - before_ended] = common
        if j >= length:
            name_ = np.full(len(grown), -1, dtype=np.int64)
            if name is not None:
                name_[old] = name
            # the suffix of length j is the window at (size - j)
            name_[new_at] = by_size[:growing] * (1 << 32) + (left[:growing] - j)
            name = name_
        bwt, lcp, at = grown, lcp_, new_at
    if name is None:
        return [np.zeros(max(0, int(s) - length + 1), dtype=bool) for s in sizes]
    again = np.maximum(lcp[:-1], lcp[1:]) >= length
    hit = name[again & (name >= 0)]
    out = [np.zeros(max(0, int(s) - length + 1), dtype=bool) for s in sizes]
    for k in hit:
        out[k >> 32][k & 0xFFFFFFFF] = True
    return out


def repeated_windows(strings: list[bytes], length: int, collection_bytes: int = 1 << 16) -> list[np.ndarray]:
    """For each string, which of its windows occur again among ``strings``.

    The strings are cut at anchors once more, with longer grams: only parts that
    share such an anchor and differ go through the column-wise construction,
    in collections of about ``collection_bytes`` (a key's parts stay together).
    All windows of a part hold the anchor at one place, and equal windows hold it at the same
    place, so the anchor is written as a mark and the number of its group: the construction
    has a round per byte beside the anchor instead of one per byte.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.cumsum(sizes)
    out = [np.zeros(max(0, int(n) - length + 1), dtype=bool) for n in sizes]
    text = b"".join(strings)
    if len(text) < length:
        return out
    gram = length - max(1, length // 10) if length > 1 else 1
    data = np.frombuffer(text, dtype=np.uint8)
    hashes = Hashes(data)
    grams = hashes.all(gram)
    least = _sliding_min(grams, length - gram + 1)
    at = np.arange(len(least))
    owner = np.searchsorted(ends, at, side="right")
    inside = at + length <= ends[owner]
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[:len(least) - 1] == least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    new &= inside
    start = np.flatnonzero(new)
    if not len(start):
        return out
    last = np.append(start[1:], len(least))
    # windows that reach into the next string do not count
    windows = np.minimum(last, ends[owner[start]] - length + 1) - start
    key, digest = least[start], hashes.of(start, start + windows - 1 + length)
    order = np.lexsort((digest, key))
    new_key = np.ones(len(order), dtype=bool)
    new_key[1:] = key[order][1:] != key[order][:-1]
    new_kind = new_key.copy()
    new_kind[1:] |= digest[order][1:] != digest[order][:-1]
    kind = np.cumsum(new_kind) - 1
    copies = np.bincount(kind)
    first = order[new_kind]  # one part of each kind, in order of key
    group = (np.cumsum(new_key) - 1)[new_kind]
    mixed = np.bincount(group)[group] > 1

    def mark(part: int, flags) -> None:
        k = owner[start[part]]
        begin = int(start[part] - (ends[k] - sizes[k]))
        out[k][begin:begin + int(windows[part])] |= flags

    for i in np.flatnonzero(copies[kind] > 1):
        mark(order[i], True)
    todo, size = [], 0
    chosen = np.flatnonzero(mixed)
    begins = start[first[chosen]]
    places = begins[:, None] + np.arange(length - gram + 1)
    anchors = begins + (grams[np.minimum(places, len(grams) - 1)] == key[first[chosen]][:, None]).argmax(axis=1)
    for n, i in enumerate(chosen):
        begin, anchor, end = int(begins[n]), int(anchors[n]), int(begins[n] + windows[first[i]] - 1 + length)
        todo.append((i, text[begin:anchor] + _mark(int(group[i])) + text[anchor + gram:end]))
        size += len(todo[-1][1])
        if n + 1 == len(chosen) or (size >= collection_bytes and group[chosen[n + 1]] != group[i]):
            for (j, _), flags in zip(todo, sorted_windows([t for _, t in todo], length - gram + _MARK_BYTES)):
                if copies[j] == 1 and flags.any():
                    mark(first[j], flags)
            todo, size = [], 0
    return out


_MARK_BYTES = 5


def _mark(group: int) -> bytes:
    """Stands for the anchor of a group: a byte that no UTF-8 text holds, then the number."""
    return bytes((0xFE, group >> 21 & 127, group >> 14 & 127, group >> 7 & 127, group & 127))


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _packed(start, windows):
    """First window and number of windows of a fragment in one number."""
    return start * (1 << 16) + windows


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == _U else x.astype(np.int64))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   gram: int | None = None, group_bytes: int = 1 << 20, collection_bytes: int = 1 << 20,
                   task_bytes: int = 1 << 23) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row (``kept``: the remaining bytes)."""
    gram = gram or max(1, length // 2)
    if not 0 < gram <= length < 1 << 16:
        raise ValueError("0 < gram <= length < 65536 is needed")
    # rows need a name of their own: ids may repeat or be null
    # (rows that are equal in id and text have equal results, so a hash of both will do)
    source = text_rows(df, id_col, text_col).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("row"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fragments(np.frombuffer(t.as_buffer(), dtype=np.uint8), length, gram) for t in b.column(0).cast(pa.binary())]
            of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            ids, rows = (c.to_numpy()[of] for c in b.columns[1:])
            key, digest, start, windows = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, _U) for i in range(4))
            for i in range(0, len(of), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [_long(x[part]) for x in (key, digest, ids, rows, _packed(start, windows))],
                    names=["key", "digest", "id", "row", "place"])

    every = source.select("text", "id", "row").mapInArrow(
        find, "key bigint, digest bigint, id bigint, row bigint, place bigint")
    shared = written(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("_key")),
                     "repeats-keys")
    places = written(every.join(shared, F.col("key") == F.col("_key")).drop("_key"), "repeats-places")
    kinds = places.groupBy("key", "digest").agg(F.count("*").alias("n"), F.min(F.struct("id", "row", "place")).alias("first"))
    per_key = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(
        F.col("first.place").bitwiseAND(F.lit(65535).cast("bigint")) + (length - 1)).alias("bytes"))
    mixed = written(per_key.where("kinds > 1").select(F.col("key").alias("_key"), "bytes"), "repeats-mixed")
    kinds = written(kinds.join(mixed, F.col("key") == F.col("_key")).select(
        "key", "digest", "n", "bytes", F.col("first.id").alias("_id"), F.col("first.row").alias("_row"), F.col("first.place").alias("place")), "repeats-kinds")

    # one copy of each fragment: the texts meet the places wanted from them
    wanted = kinds.groupBy("_id", "_row").agg(F.collect_list(F.struct("key", "digest", "n", "bytes", "place")).alias("wanted"))
    here = (F.col("id") == F.col("_id")) & (F.col("row") == F.col("_row"))
    meet = source.select("text", "id", "row").join(wanted, here)

    def cut(batches):
        for b in batches:
            out = []
            for text, places in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()):
                for p in places:
                    start, windows = p["place"] >> 16, p["place"] & 65535
                    out.append((p["key"], p["digest"], p["n"], p["bytes"], text[start:start + windows - 1 + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["key", "digest", "n", "bytes", "data"])

    # of rows equal in id and text each gives the same fragments: one of them stays
    pieces = meet.select("text", "wanted").mapInArrow(cut, "key bigint, digest bigint, n bigint, bytes bigint, data binary")
    pieces = written(pieces.dropDuplicates(["key", "digest"]), "repeats-pieces")
    total = pieces.agg(F.sum(F.octet_length("data").cast("bigint")).alias("b")).first()["b"] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))

    def construct(batches):
        keys, digests, strings, size = [], [], [], 0

        def flush():
            found = [(k, d, *_runs(flags)) for k, d, flags in zip(keys, digests, repeated_windows(strings, length))]
            found = [(k, d, s.tolist(), e.tolist()) for k, d, s, e in found if len(s)]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                names=["key", "digest", "starts", "ends"])

        for b in batches:
            for k, d, data in zip(*(c.to_pylist() for c in b.columns)):
                if size >= collection_bytes and k != keys[-1]:
                    yield flush()
                    keys, digests, strings, size = [], [], [], 0
                keys.append(k), digests.append(d), strings.append(data)
                size += len(data)
        if strings:
            yield flush()

    ranges = "key bigint, digest bigint, starts array<int>, ends array<int>"
    small = pieces.where(F.col("bytes") <= group_bytes).select("key", "digest", "data").repartition(tasks, "key") \
        .sortWithinPartitions("key", "digest").mapInArrow(construct, ranges)

    def window_hashes(batches):
        for b in batches:
            for k, d, data in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(data, dtype=np.uint8)
                one, two = Hashes(x).all(length), Hashes(x, 0xD6E8FEB86659FD93).all(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), k)), pa.array(np.full(len(one), d)), _long(np.arange(len(one))), _long(one), _long(two)],
                    names=["key", "digest", "window", "h1", "h2"])

    hashed = pieces.where(F.col("bytes") > group_bytes).select("key", "digest", "data").mapInArrow(
        window_hashes, "key bigint, digest bigint, window bigint, h1 bigint, h2 bigint")
    twice = hashed.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    big = hashed.join(twice, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).groupBy("key", "digest").agg(
        F.collect_list(F.col("window").cast("int")).alias("starts")).select(
        "key", "digest", "starts", F.transform("starts", lambda s: s + 1).alias("ends"))
    partly = written(small.unionAll(big), "repeats-ranges")

    # whole fragments: two or more copies, whether or not the key has other fragments
    whole = places.groupBy("key", "digest").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("key").alias("_key"), F.col("digest").alias("_digest"), F.lit(None).cast("array<int>").alias("starts"),
        F.lit(None).cast("array<int>").alias("ends"))
    marks = partly.join(whole, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left_anti").select(
        F.col("key").alias("_key"), F.col("digest").alias("_digest"), "starts", "ends").unionAll(whole)
    marks = written(marks, "repeats-marks")
    start, windows = F.shiftright("place", 16), F.col("place").bitwiseAND(F.lit(65535).cast("bigint"))
    hits = places.join(marks, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest"))).select(
        F.col("id").alias("_id"), F.col("row").alias("_row"), F.when(F.col("starts").isNull(), F.array(F.struct(start.alias("s"), (start + windows - 1 + length).alias("e"))))
        .otherwise(F.zip_with("starts", "ends", lambda s, e: F.struct((start + s).alias("s"), (start + e - 1 + length).alias("e")))).alias("r"))
    # a set: rows equal in id and text bring equal ranges
    per_row = hits.groupBy("_id", "_row").agg(F.flatten(F.collect_set("r")).alias("r"))
    joined = source.join(per_row, here, "left").select(
        "doc_id", "text", F.col("r.s").alias("s"), F.col("r.e").alias("e"))

    def remove(batches):
        for b in batches:
            out = []
            for doc_id, text, s, e in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                                          b.column(2).to_pylist(), b.column(3).to_pylist()):
                cover = np.zeros(len(text) + 1, dtype=np.int64)
                if s:
                    np.add.at(cover, s, 1)
                    np.add.at(cover, e, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                out.append((doc_id, len(text), len(text) - len(kept), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


#: Every window by its digest; removed ranges as islands of repeated windows.
ORACLE = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS MATERIALIZED (SELECT r, i, md5(array_slice(b, i + 1, i + 200)) AS h
  FROM (SELECT r, b, unnest(range(0, octet_length(b) - 199)) AS i FROM d WHERE octet_length(b) >= 200)),
hot AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
edge AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS cut FROM hot),
run AS (SELECT r, i, sum(cut) OVER (PARTITION BY r ORDER BY i) AS k FROM edge),
span AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM run GROUP BY r, k),
piece AS (SELECT d.r, s, e, hex(array_slice(b, coalesce(lag(e) OVER (PARTITION BY d.r ORDER BY s), 0) + 1, s)) AS before
  FROM span JOIN d ON d.r = span.r),
part AS (SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last, string_agg(before, '' ORDER BY s) AS kept
  FROM piece GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(kept || hex(array_slice(b, last + 1, octet_length(b)))) END) AS kept_sha256
FROM d LEFT JOIN part ON part.r = d.r
"""

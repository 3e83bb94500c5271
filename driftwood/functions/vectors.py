"""Vector Column functions (E1-E10), JVM-side higher-order functions only.

Encodings
---------
dense   ``array<double>`` (index = position, out-of-range reads 0)
sparse  ``map<int,double>`` (missing index reads 0)
text    ``map<string,double>`` (missing key reads 0)

Dense two-argument functions run over the left vector's length and read
the right one with ``vec_get`` semantics.  Map functions treat a missing
key as 0; ``map_add`` drops zero entries, ``map_hadamard`` keeps the key
intersection and ``map_set`` overwrites (corrected semantics, see README).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.plans.parallelism import spread


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _zero() -> Column:
    return F.lit(0.0).cast("double")


# ------------------------------------------------------------------ dense

def vec_get(v, i) -> Column:
    """E1 dense: element ``i`` (0-based), 0 when out of range."""
    i = F.lit(i) if isinstance(i, int) else _c(i)
    return F.when(i >= 0, F.coalesce(F.try_element_at(_c(v), i + 1).cast("double"), _zero())) \
        .otherwise(_zero())


def _get_at(b: Column, i: Column) -> Column:
    return F.coalesce(F.try_element_at(b, i + 1).cast("double"), _zero())


def vec_dot(a, b) -> Column:
    """E2 dense: sum over the left length of a_i * b_i."""
    b = _c(b)
    return F.aggregate(F.transform(_c(a), lambda x, i: x.cast("double") * _get_at(b, i)), _zero(),
                       lambda acc, x: acc + x)


def vec_add(a, b) -> Column:
    """E3 dense."""
    b = _c(b)
    return F.transform(_c(a), lambda x, i: x.cast("double") + _get_at(b, i))


def vec_hadamard(a, b) -> Column:
    """E4 dense."""
    b = _c(b)
    return F.transform(_c(a), lambda x, i: x.cast("double") * _get_at(b, i))


def vec_distance(a, b) -> Column:
    """E5 dense Euclidean distance; a null vector is at distance +inf-like max."""
    b = _c(b)
    sq = F.aggregate(F.transform(_c(a), lambda x, i: F.pow(x.cast("double") - _get_at(b, i), 2.0)),
                     _zero(), lambda acc, x: acc + x)
    return F.when(_c(a).isNull() | b.isNull(), F.lit(1.7976931348623157e308)).otherwise(F.sqrt(sq))


def vec_set(v, i: int, value) -> Column:
    """E6 dense: replace element ``i``; ``i == len`` appends; else unchanged."""
    v = _c(v)
    val = F.lit(value) if isinstance(value, (int, float)) else _c(value)
    replaced = F.transform(v, lambda x, j: F.when(j == F.lit(i), val.cast("double"))
                           .otherwise(x.cast("double")))
    return (F.when(F.size(v) == F.lit(i), F.concat(F.transform(v, lambda x: x.cast("double")),
                                                   F.array(val.cast("double"))))
            .otherwise(replaced))


def append_bias(v, value: float = 1.0) -> Column:
    """The bias-term append used by the linear model."""
    return F.concat(F.transform(_c(v), lambda x: x.cast("double")), F.array(F.lit(float(value))))


def vec_map(v, fn: Callable[[Column], Column]) -> Column:
    """E7 dense: apply a Column function element-wise."""
    return F.transform(_c(v), lambda x: fn(x.cast("double")))


def vec_reduce(v, fn: Callable[[Column, Column], Column], zero: float = 0.0) -> Column:
    """E8 dense: fold with ``fn(acc, x)`` from ``zero``."""
    return F.aggregate(_c(v), F.lit(float(zero)), lambda acc, x: fn(acc, x.cast("double")))


def vec_argmax(v) -> Column:
    """Index of the first maximum (0-based); -1 for an empty vector."""
    v = _c(v)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def vec_entries(df: DataFrame, v: str, keep=(), index_name: str = "index",
                value_name: str = "value") -> DataFrame:
    """Long form ``(keep..., index, value)`` of a dense or map vector column."""
    dtype = df.schema[v].dataType.typeName()
    if dtype == "array":
        return df.select(*keep, F.posexplode(v).alias(index_name, value_name)) \
            .withColumn(value_name, F.col(value_name).cast("double"))
    return df.select(*keep, F.explode(v).alias(index_name, value_name))


# ------------------------------------------------------------------ sparse / text (maps)

def sparse_from_arrays(indexes, values) -> Column:
    """Sparse vector from parallel arrays; the first occurrence of an index wins."""
    idx, val = _c(indexes), _c(values)
    pairs = F.arrays_zip(idx.alias("k"), val.alias("v"))
    firsts = F.filter(pairs, lambda e, j: F.array_position(idx, e["k"]) == j + 1)
    return F.map_from_entries(F.transform(firsts, lambda e: F.struct(e["k"].alias("key"),
                                                                      e["v"].cast("double")
                                                                      .alias("value"))))


def dense_to_map(v) -> Column:
    """Dense vector as a sparse map (non-zero entries only), for mixed calls."""
    v = _c(v)
    ent = F.transform(v, lambda x, i: F.struct(i.alias("key"), x.cast("double").alias("value")))
    return F.map_from_entries(F.filter(ent, lambda e: e["value"] != 0))


def map_get(m, k) -> Column:
    """E1 sparse/text."""
    k = F.lit(k) if isinstance(k, (int, str)) else _c(k)
    return F.coalesce(F.try_element_at(_c(m), k).cast("double"), _zero())


def map_dot(a, b) -> Column:
    """E2 sparse/text: sum over the common keys of a_k * b_k.

    ``map_zip_with`` merges the two maps through a hash table (linear in
    their sizes); a lookup per key would scan the other map every time.
    """
    z = F.map_zip_with(_c(a), _c(b), lambda k, x, y: F.coalesce(x * y, _zero()))
    return F.aggregate(F.map_values(z), _zero(), lambda acc, v: acc + v)


def map_add(a, b) -> Column:
    """E3 sparse/text: union of keys, zeros dropped."""
    s = F.map_zip_with(_c(a), _c(b), lambda k, x, y: F.coalesce(x, _zero()) + F.coalesce(y, _zero()))
    return F.map_filter(s, lambda k, v: v != 0)


def map_hadamard(a, b) -> Column:
    """E4 sparse/text: key intersection, zero products dropped."""
    s = F.map_zip_with(_c(a), _c(b), lambda k, x, y: x * y)
    return F.map_filter(s, lambda k, v: v.isNotNull() & (v != 0))


def map_distance(a, b) -> Column:
    """E5 sparse/text Euclidean distance (missing = 0)."""
    s = F.map_zip_with(_c(a), _c(b),
                       lambda k, x, y: F.pow(F.coalesce(x, _zero()) - F.coalesce(y, _zero()), 2.0))
    return F.sqrt(F.aggregate(F.map_values(s), _zero(), lambda acc, x: acc + x))


def map_set(m, k, value) -> Column:
    """E6 sparse/text: set (overwrite) one entry."""
    k = F.lit(k) if isinstance(k, (int, str)) else _c(k)
    val = F.lit(float(value)) if isinstance(value, (int, float)) else _c(value).cast("double")
    return F.map_zip_with(_c(m), F.create_map(k, val), lambda kk, x, y: F.coalesce(y, x))


def map_map(m, fn: Callable[[Column], Column]) -> Column:
    """E7 sparse/text."""
    return F.transform_values(_c(m), lambda k, v: fn(v))


def map_reduce(m, fn: Callable[[Column, Column], Column], zero: float = 0.0) -> Column:
    """E8 sparse/text."""
    return F.aggregate(F.map_values(_c(m)), F.lit(float(zero)), fn)


def word_counts(df: DataFrame, id_col: str, text_col: str, name: str = "tf", dealt: bool = False) -> DataFrame:
    """Text vectors: ``(id, map<word, count>)`` of space-separated tokens.

    One shuffle on the id: rows are hash-partitioned by id, tokens are
    exploded after the shuffle and both groupings reuse that partitioning.  The partitions
    grow with the input's bytes, so a task's hash table does not; ``dealt``: the rows are
    partitioned by id already.
    Whole texts are used; an empty or null text has an empty map.
    """
    rows = df.select(id_col, text_col)
    rows = rows if dealt else spread(rows, id_col)
    words = F.filter(F.split(F.col(text_col), " "), lambda w: w != "")
    toks = rows.select(id_col, F.explode_outer(words).alias("_w"))
    counts = toks.groupBy(id_col, "_w").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    entry = F.when(F.col("_w").isNotNull(), F.struct(F.col("_w").alias("key"), F.col("_n").alias("value")))
    return counts.groupBy(id_col).agg(F.map_from_entries(F.collect_list(entry)).alias(name))

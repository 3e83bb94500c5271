"""Filter interaction audit by the Hart-Mas-Colell potential (operator 13).

Five filters run over the documents in an order; a filter removes what fails it and
is still there.  Which filter removes how much depends on the order, so all 120
orders are reported, with the Shapley value of each filter.

A document is described by the set of filters that it fails (32 masks), so the
corpus is one row of counts per part: v[S] = the documents that fail a filter of
the coalition S (all, good and toxic ones apart).  Everything follows from these 32
coalitions: a step of filter f after the filters P removes v[P+f] - v[P].  The
potential of the removal game is computed recursively, smaller coalitions first,

    P(empty) = 0,   |S| P(S) = v[S] + sum over f in S of P(S - f),

and the Shapley value of f is P(all) - P(all - f).  In integers: with
Q(S) = |S|! P(S), Q(S) = (|S| - 1)! v[S] + sum of Q(S - f); the removals of f summed
over all n! orders are Q(all) - n Q(all - f).  No order is simulated.

Exact copies without hot groups: every document is cut down to (id, part, mask,
SHA-256) and repeated rows are counted; the least id per digest is a partial
aggregate; it meets the rows again on (digest, id), a key that a frequent text does
not make frequent.  Labels are joined on the id, rows without an id stay out of
that join.

Defined results: a null text is empty, a null source is the part ''; rows with equal id and
text are no copies of each other; rows without an id fail no copy filter, make no other
row fail it, and have no labels; several labels of one id count if one of them says
so; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
COPY = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at the text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": F.size(words) < 50,
            "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
            "C": capitals * 100 > F.length(text) * 5,
            "D": text.rlike("[#$%&*|]")}


def fail_masks(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text",
               part_col: str | None = "source", filters=text_filters) -> tuple[DataFrame, str]:
    """Counts per ``part, mask, good, toxic``, and the filters' letters; bit k of the mask is letter k.

    ``filters`` gives the failure conditions of a text column by letter; the copy filter is the last letter.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")) if part_col else F.lit("")
    checks = filters(F.col("_text"))
    letters = "".join(checks) + COPY
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(checks.values())), F.lit(0))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), part.alias("_part"), text.alias("_text"))
    reduced = rows.select("_id", "_part", bits.cast("int").alias("_mask"), F.unhex(F.sha2("_text", 256)).alias("_sha"))
    reduced = written(reduced.groupBy("_id", "_part", "_mask", "_sha").agg(F.count("*").alias("_n")), "filter-rows")

    with_id = reduced.where("_id is not null")
    least = with_id.groupBy(F.col("_sha").alias("_sha1")).agg(F.min("_id").alias("_id1"))
    marked = with_id.join(least, (F.col("_sha") == F.col("_sha1")) & (F.col("_id") == F.col("_id1")), "left")
    copied = F.when(F.col("_id1").isNull(), 1 << len(checks)).otherwise(0)
    marked = marked.select("_id", "_part", (F.col("_mask") + copied).alias("_mask"), "_n")
    if labels is None:
        marked = marked.withColumn("_good", F.lit(0)).withColumn("_toxic", F.lit(0))
    else:
        said = labels.select(F.col("doc_id").cast("bigint").alias("_of"), "quality", "toxic").where("_of is not null").groupBy("_of").agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("_good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_toxic"))
        marked = marked.join(said, F.col("_id") == F.col("_of"), "left")
    kept = ["_part", "_mask", "_n", F.coalesce("_good", F.lit(0)).alias("_good"), F.coalesce("_toxic", F.lit(0)).alias("_toxic")]
    lost = reduced.where("_id is null").select("_part", "_mask", "_n", F.lit(0).alias("_good"), F.lit(0).alias("_toxic"))
    return marked.select(*kept).unionByName(lost).groupBy("_part", "_mask", "_good", "_toxic").agg(F.sum("_n").alias("_n")), letters


def coalition_counts(masks: DataFrame, n: int) -> DataFrame:
    """Per part: ``_all`` documents, arrays ``_v, _g, _t`` over the 2^n coalitions: documents that fail one of its filters."""
    def game(weight: Column) -> Column:
        return F.array(*[F.sum(F.when(F.col("_mask").bitwiseAND(s) != 0, weight).otherwise(0)) for s in range(1 << n)])

    return masks.groupBy("_part").agg(F.sum("_n").alias("_all"), game(F.col("_n")).alias("_v"),
                                      game(F.col("_n") * F.col("_good")).alias("_g"), game(F.col("_n") * F.col("_toxic")).alias("_t"))


def potentials(v: str, n: int) -> Column:
    """Q(S) = |S|! P(S) of the coalitions in ascending order; a coalition's subsets come before it."""
    factor = F.array(*[F.lit(math.factorial(max(bin(s).count("1") - 1, 0))) for s in range(1 << n)])

    def step(acc: Column, s: Column) -> Column:
        smaller = sum((F.when(s.bitwiseAND(1 << k) != 0, F.get(acc, s.bitwiseXOR(F.lit(1 << k)))).otherwise(F.lit(0)) for k in range(n)),
                      F.lit(0).cast("bigint"))
        return F.concat(acc, F.array(F.get(factor, s) * F.get(F.col(v), s) + smaller))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("bigint")), step)


def orders(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, mask of the filters before, number of the step's filter) of all orders."""
    out = []
    for p in permutations(range(len(letters))):
        before = 0
        for step, k in enumerate(p, 1):
            out.append(("".join(letters[j] for j in p), step, before, k))
            before |= 1 << k
    return out


def audit(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", part_col: str | None = "source",
          filters=text_filters) -> DataFrame:
    """One row per part, order and step with the counts of the step."""
    masks, letters = fail_masks(docs, labels, id_col, text_col, part_col, filters)
    n = len(letters)
    everything = (1 << n) - 1
    games = coalition_counts(masks, n).withColumn("_q", potentials("_v", n))
    table = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"),
                               F.lit(b | 1 << k).alias("after"), F.lit(1 << k).alias("bit")) for o, s, b, k in orders(letters)])
    rows = games.select("*", F.explode(table).alias("_o"))

    def at(game: str, place: Column) -> Column:
        return F.get(F.col(game), place)

    before, after, bit = F.col("_o.before"), F.col("_o.after"), F.col("_o.bit")
    others = F.lit(everything).bitwiseXOR(bit)
    removed = at("_v", after) - at("_v", before)
    return rows.select(
        F.col("_part").alias("part"), F.col("_o.filter_order").alias("filter_order"), F.col("_o.step").alias("step"),
        (F.col("_all") - at("_v", after)).alias("kept"), removed.alias("removed"),
        (at("_v", bit) - removed).alias("redundant"), (at("_v", F.lit(everything)) - at("_v", others)).alias("unique_fails"),
        (at("_g", after) - at("_g", before)).alias("good_lost"), (at("_t", after) - at("_t", before)).alias("toxic_lost"),
        (at("_q", F.lit(everything)) - n * at("_q", others)).alias("shapley"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
failed AS MATERIALIZED (
  SELECT part, doc_id,
    (len(w) < 50)::INT AS A, (100 * len(list_distinct(w)) < 65 * len(w))::INT AS B,
    (100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t))::INT AS C,
    regexp_matches(t, '[#$%&*|]')::INT AS D, (coalesce(doc_id > least, FALSE))::INT AS E FROM words),
said AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS MATERIALIZED (
  SELECT part, l.f, max(CASE l.f WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END) AS bad,
    A, B, C, D, E, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM failed LEFT JOIN said USING (doc_id), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) l(f)
  GROUP BY part, l.f, A, B, C, D, E, good, toxic),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, s.step::INT AS step, filter_order[s.step] AS f, filter_order[1:s.step - 1] AS earlier
  FROM orders, range(1, 6) s(step)),
counted AS (
  SELECT part, filter_order, step, k.f,
    sum(n) FILTER (WHERE NOT gone AND bad = 0) AS kept,
    sum(n) FILTER (WHERE NOT gone AND bad = 1) AS removed,
    sum(n) FILTER (WHERE gone AND bad = 1) AS redundant,
    sum(n) FILTER (WHERE bad = 1 AND A + B + C + D + E = 1) AS unique_fails,
    sum(n) FILTER (WHERE NOT gone AND bad = 1 AND good = 1) AS good_lost,
    sum(n) FILTER (WHERE NOT gone AND bad = 1 AND toxic = 1) AS toxic_lost
  FROM (SELECT *, (contains(earlier, 'A') AND A = 1) OR (contains(earlier, 'B') AND B = 1) OR (contains(earlier, 'C') AND C = 1)
      OR (contains(earlier, 'D') AND D = 1) OR (contains(earlier, 'E') AND E = 1) AS gone
    FROM steps JOIN fails USING (f)) k
  GROUP BY part, filter_order, step, k.f)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""

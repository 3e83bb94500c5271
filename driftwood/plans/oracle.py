"""Oracle SQL (DuckDB dialect) for the registered queries.

Every string runs over the pre-registered views of the driver's tables and
computes the operator the direct way (whole-table windows, cross joins with
small parameter tables, GROUP BY), independent of the Spark plans.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_EV_ORDER = "ts, event_id"
_LI_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

_EV_INTS = "SELECT user_id, event_id, ts, CAST(round(value * 100) AS BIGINT) - 5000 AS x FROM events"


def _kadane_sql(part: str, cols: str) -> str:
    over = f"({part} ORDER BY {_EV_ORDER} {_RUN})"
    return f"""
WITH b AS ({_EV_INTS}),
p AS (SELECT *, sum(x) OVER {over} AS pf FROM b),
h AS (SELECT *, pf - least(0, min(pf) OVER {over}) AS hh FROM p)
SELECT {cols}, x, CAST(hh AS BIGINT) AS max_ending_here,
       CAST(max(hh) OVER {over} AS BIGINT) AS max_subarray
FROM h"""


ORACLE["running_max_subarray"] = _kadane_sql("PARTITION BY user_id", "user_id, event_id")
ORACLE["running_max_subarray_global"] = _kadane_sql("", "event_id")
ORACLE["max_subarray"] = f"""
WITH k AS ({_kadane_sql("PARTITION BY user_id", "user_id, event_id")})
SELECT user_id, max(max_subarray) AS max_subarray FROM k GROUP BY user_id"""

_LI_XY = f"SELECT {_LI_ORDER}, l_quantity AS x, l_extendedprice / 1000.0 AS y FROM lineitem"

ORACLE["rls_weights"] = f"""
WITH b AS ({_LI_XY}),
s AS (SELECT *, sum(x * x) OVER (ORDER BY {_LI_ORDER} {_RUN}) AS sxx,
                sum(x * y) OVER (ORDER BY {_LI_ORDER} {_RUN}) AS sxy FROM b)
SELECT {_LI_ORDER}, 1.0 / (1.0 + sxx) AS theta,
       round((10.0 + sxy) / (1.0 + sxx), 6) AS weight,
       round((10.0 + sxy) / (1.0 + sxx) * x, 6) AS prediction
FROM s"""

ORACLE["rls_predict"] = f"""
WITH b AS ({_LI_XY}),
s AS (SELECT *, sum(x * x) OVER (PARTITION BY l_suppkey ORDER BY {_LI_ORDER} {_RUN}) AS sxx,
                sum(x * y) OVER (PARTITION BY l_suppkey ORDER BY {_LI_ORDER} {_RUN}) AS sxy FROM b)
SELECT {_LI_ORDER}, round((10.0 + sxy) / (1.0 + sxx) * x, 6) AS prediction
FROM s"""

_LI_FTL = f"SELECT {_LI_ORDER}, l_quantity AS x, round(l_extendedprice / 1000.0) AS y FROM lineitem"


def _ftl_sql(part: str, frame: str) -> str:
    return f"""
WITH b AS ({_LI_FTL}),
p AS (SELECT *, coalesce(lag(x) OVER ({part} ORDER BY {_LI_ORDER}), 0) AS px FROM b),
h AS (SELECT range AS a FROM range(31)),
l AS (SELECT p.*, h.a,
             sum(abs(h.a * p.px - p.y)) OVER (PARTITION BY h.a {(',' + part.replace('PARTITION BY', '')) if part else ''}
                                              ORDER BY {_LI_ORDER} {frame}) AS cum
      FROM p CROSS JOIN h),
r AS (SELECT *, row_number() OVER (PARTITION BY {_LI_ORDER} ORDER BY cum, a) AS rn FROM l)
SELECT {_LI_ORDER}, CAST(a AS INTEGER) AS leader, CAST(a AS DOUBLE) * x AS prediction
FROM r WHERE rn = 1"""


ORACLE["follow_the_leader"] = _ftl_sql("", _RUN)
ORACLE["follow_the_leader_sliding"] = _ftl_sql("", "ROWS BETWEEN 4 PRECEDING AND CURRENT ROW")
ORACLE["follow_the_leader_long_window"] = _ftl_sql("", "ROWS BETWEEN 999 PRECEDING AND CURRENT ROW")
ORACLE["follow_the_leader_keyed"] = _ftl_sql("PARTITION BY l_suppkey", _RUN)

ORACLE["zip_by_position"] = f"""
WITH l AS (SELECT row_number() OVER (ORDER BY {_LI_ORDER}) - 1 AS pos,
                  l_orderkey, l_linenumber, l_quantity FROM lineitem),
o AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
             o_orderkey, o_totalprice FROM orders)
SELECT l.pos, l_orderkey, l_linenumber, l_quantity, o_orderkey, o_totalprice
FROM l JOIN o ON l.pos = o.pos"""

ORACLE["take_first"] = f"""
SELECT event_id, user_id, value FROM events ORDER BY {_EV_ORDER} LIMIT 100"""

# ------------------------------------------------------------------ vectors
_EMB_PAIRS = """(SELECT a.vec_id, a.embedding, b.embedding AS other FROM embeddings a
                 JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""
ORACLE["vec_get"] = """
SELECT vec_id, coalesce(embedding[4]::DOUBLE, 0.0) AS v3,
       coalesce(embedding[65]::DOUBLE, 0.0) AS v64 FROM embeddings"""
ORACLE["vec_dot"] = f"""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE
                 * coalesce(other[i]::DOUBLE, 0.0))), 6) AS dot FROM {_EMB_PAIRS}"""
ORACLE["vec_add"] = f"""
SELECT vec_id, list_transform(embedding, lambda x, i: x::DOUBLE + coalesce(other[i]::DOUBLE, 0.0))
       AS vec_sum FROM {_EMB_PAIRS}"""
ORACLE["vec_hadamard"] = f"""
SELECT vec_id, list_transform(embedding, lambda x, i: x::DOUBLE * coalesce(other[i]::DOUBLE, 0.0))
       AS vec_prod FROM {_EMB_PAIRS}"""
ORACLE["vec_distance"] = f"""
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x, i:
       pow(x::DOUBLE - coalesce(other[i]::DOUBLE, 0.0), 2)))), 6) AS distance FROM {_EMB_PAIRS}"""
ORACLE["vec_set"] = """
SELECT vec_id,
       list_transform(embedding, lambda x, i: CASE WHEN i = 1 THEN label::DOUBLE ELSE x::DOUBLE END)
         AS vec_first_set,
       list_append(list_transform(embedding, lambda x: x::DOUBLE), 1.0) AS vec_bias
FROM embeddings"""
ORACLE["vec_map"] = """
SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 2.0 + 1.0) AS vec_mapped FROM embeddings"""
ORACLE["vec_reduce"] = """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS sum_sq
FROM embeddings"""
ORACLE["vec_entries"] = """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS index,
       unnest(embedding)::DOUBLE AS value FROM embeddings"""
ORACLE["vec_argmax"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax
FROM embeddings"""

_WORD_LENGTHS = """(SELECT doc_id, length(w) AS k, CAST(count(*) AS DOUBLE) AS v
   FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) t WHERE w <> '' GROUP BY doc_id, length(w))"""
ORACLE["sparse_vec_ops"] = f"""
WITH t AS MATERIALIZED {_WORD_LENGTHS},
p AS (SELECT DISTINCT a.doc_id FROM t a JOIN t b ON b.doc_id = a.doc_id + 1),
j AS (SELECT coalesce(a.doc_id, b.doc_id - 1) AS doc_id, coalesce(a.k, b.k) AS k,
             coalesce(a.v, 0.0) AS av, coalesce(b.v, 0.0) AS bv
      FROM t a FULL OUTER JOIN t b ON b.doc_id = a.doc_id + 1 AND b.k = a.k)
SELECT doc_id, round(sum(av * bv), 6) AS dot, round(sqrt(sum(pow(av - bv, 2))), 6) AS distance,
       coalesce(max(CASE WHEN k = 5 THEN av END), 0.0) AS a5,
       CAST(count(CASE WHEN av + bv <> 0 THEN 1 END) AS INTEGER) AS n_add,
       CAST(count(CASE WHEN av * bv <> 0 THEN 1 END) AS INTEGER) AS n_prod,
       round(sum(abs(av)), 6) AS l1
FROM p JOIN j USING (doc_id) GROUP BY doc_id"""

_DOC_TF = """(SELECT doc_id, w AS word, CAST(count(*) AS DOUBLE) AS n
   FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) t
   WHERE w <> '' GROUP BY doc_id, w)"""
_DOC_PAIRS = """(SELECT DISTINCT a.doc_id FROM (SELECT DISTINCT doc_id FROM tf) a
                 JOIN (SELECT DISTINCT doc_id FROM tf) b ON b.doc_id = a.doc_id + 1)"""
ORACLE["text_vec_dot"] = f"""
WITH tf AS {_DOC_TF}, pairs AS {_DOC_PAIRS},
a AS (SELECT tf.* FROM tf JOIN pairs USING (doc_id)),
b AS (SELECT tf.doc_id - 1 AS doc_id, word, n FROM tf JOIN pairs ON pairs.doc_id = tf.doc_id - 1),
j AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.word, b.word) AS word,
             coalesce(a.n, 0.0) AS an, coalesce(b.n, 0.0) AS bn
      FROM a FULL OUTER JOIN b ON a.doc_id = b.doc_id AND a.word = b.word)
SELECT doc_id, sum(an * bn) AS dot, round(sqrt(sum(pow(an - bn, 2))), 6) AS distance,
       coalesce(max(CASE WHEN word = 'the' THEN an END), 0.0) AS n_the
FROM j GROUP BY doc_id"""
ORACLE["text_vec_add"] = f"""
WITH tf AS {_DOC_TF}, pairs AS {_DOC_PAIRS},
a AS (SELECT tf.* FROM tf JOIN pairs USING (doc_id)),
b AS (SELECT tf.doc_id - 1 AS doc_id, word, n FROM tf JOIN pairs ON pairs.doc_id = tf.doc_id - 1)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.word, b.word) AS word,
       coalesce(a.n, 0.0) + coalesce(b.n, 0.0) AS value
FROM a FULL OUTER JOIN b ON a.doc_id = b.doc_id AND a.word = b.word"""
ORACLE["text_vec_hadamard"] = f"""
WITH tf AS MATERIALIZED {_DOC_TF},
pair AS (SELECT doc_id, word, n AS a, NULL AS b FROM tf UNION ALL SELECT doc_id - 1, word, NULL, n FROM tf)
SELECT doc_id, word, max(a) * max(b) AS value FROM pair GROUP BY doc_id, word HAVING count(*) = 2"""

# ------------------------------------------------------------------ branch tests
ORACLE["numeric_test"] = f"""
SELECT {_LI_ORDER}, CASE WHEN l_quantity < 25.0 THEN 0 ELSE 1 END AS branch_lt,
       CASE WHEN l_quantity = 25.0 THEN 0 ELSE 1 END AS branch_eq FROM lineitem"""
ORACLE["nominal_test"] = f"""
SELECT {_LI_ORDER}, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS branch FROM lineitem"""
ORACLE["multiway_test"] = f"""
SELECT {_LI_ORDER}, CAST(l_linenumber - 1 AS INTEGER) AS branch FROM lineitem"""
ORACLE["rule_predicate"] = f"""
SELECT {_LI_ORDER},
       CASE WHEN l_discount = 0.05 THEN 0 ELSE 1 END AS branch_op0,
       CASE WHEN l_discount <= 0.05 THEN 0 ELSE 1 END AS branch_op1,
       CASE WHEN l_discount < 0.05 THEN 0 ELSE 1 END AS branch_op2,
       CASE WHEN l_discount = 0.05 THEN 0 ELSE 1 END AS branch_op3 FROM lineitem"""

# ------------------------------------------------------------------ learners' statistics
from driftwood.functions.stats import ERFC_COEFFS  # noqa: E402


def _phi_sql(z: str) -> str:
    """Normal CDF with the same erfc fit as the Spark Column."""
    x = f"(-({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.5 * abs({x})))"
    poly = f"{ERFC_COEFFS[-1]}"
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({c} + {t} * {poly})"
    ans = f"({t} * exp(-abs({x}) * abs({x}) + {poly}))"
    return f"(0.5 * CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


_EX = f"""ex AS (SELECT {_LI_ORDER}, l_linestatus,
    l_quantity AS f_qty, l_extendedprice / 1000.0 AS f_price, l_discount * 100.0 AS f_disc,
    l_tax * 100.0 AS f_tax,
    CASE l_linestatus WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 END AS f_status,
    CAST(l_linenumber - 1 AS DOUBLE) AS f_line,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS label
  FROM lineitem)"""
_NUMLONG = f"""numlong AS (
  SELECT {_LI_ORDER}, l_linestatus, label, 1.0 AS weight, 0 AS feature, f_qty AS value FROM ex
  UNION ALL SELECT {_LI_ORDER}, l_linestatus, label, 1.0, 1, f_price FROM ex
  UNION ALL SELECT {_LI_ORDER}, l_linestatus, label, 1.0, 2, f_disc FROM ex
  UNION ALL SELECT {_LI_ORDER}, l_linestatus, label, 1.0, 3, f_tax FROM ex)"""
_NOMLONG = f"""nomlong AS (
  SELECT {_LI_ORDER}, label, 1.0 AS weight, 0 AS feature, f_status AS value FROM ex
  UNION ALL SELECT {_LI_ORDER}, label, 1.0, 1, f_line FROM ex)"""


def _gstats_sql(leaf: bool = False) -> str:
    k = "l_linestatus, " if leaf else ""
    return f"""gstats AS (SELECT {k}feature, label, sum(weight) AS n, avg(value) AS mean,
    CASE WHEN count(*) <= 1 THEN 0.0 ELSE var_samp(value) END AS var,
    min(value) AS min, max(value) AS max FROM numlong GROUP BY {k}feature, label)"""


def _points_sql(leaf: bool = False) -> str:
    k = "l_linestatus, " if leaf else ""
    kj = "l_linestatus, feature" if leaf else "feature"
    return f"""mm AS (SELECT {k}feature, min(min) AS lo, max(max) AS hi FROM gstats GROUP BY {kj}),
pts0 AS (SELECT DISTINCT {k}feature, (hi - lo) * i / 10.0 + lo AS point
         FROM mm, (SELECT range AS i FROM range(1, 11)) r),
pts AS (SELECT {k}feature, point,
               CAST(dense_rank() OVER (PARTITION BY {kj} ORDER BY point) - 1 AS INTEGER) AS point_idx
        FROM pts0 WHERE point > (SELECT lo FROM mm WHERE {' AND '.join(f'mm.{c} = pts0.{c}' for c in kj.split(', '))})
                    AND point < (SELECT hi FROM mm WHERE {' AND '.join(f'mm.{c} = pts0.{c}' for c in kj.split(', '))}))"""


def _gpost_sql(leaf: bool = False) -> str:
    k = "g.l_linestatus, " if leaf else ""
    on = "g.l_linestatus = p.l_linestatus AND g.feature = p.feature" if leaf else "g.feature = p.feature"
    sd = "sqrt(g.var)"
    phi = _phi_sql(f"(p.point - g.mean) / {sd}")
    left = f"""CASE WHEN p.point < g.min THEN 0.0 WHEN p.point >= g.max THEN g.n
                    ELSE g.n * CASE WHEN {sd} > 0 THEN {phi}
                                    WHEN p.point < g.mean THEN 0.0 ELSE 1.0 END END"""
    return f"""gl AS (SELECT {k}g.feature, p.point, p.point_idx, g.label, g.n, {left} AS lw
       FROM gstats g JOIN pts p ON {on}),
gpost AS (SELECT {k.replace('g.', '')}feature, point, point_idx, 0 AS branch, label, lw AS w FROM gl
          UNION ALL
          SELECT {k.replace('g.', '')}feature, point, point_idx, 1, label, n - lw FROM gl)"""


_NSTATS = """nstats AS (SELECT feature, label, value, sum(weight) AS w FROM nomlong
                        GROUP BY feature, label, value)"""
_NBIN = """pcls AS (SELECT feature, label, sum(w) AS tot FROM nstats GROUP BY feature, label),
vals AS (SELECT DISTINCT feature, value AS split_value FROM nstats),
nbin0 AS (SELECT v.feature, v.split_value, c.label, c.tot, coalesce(s.w, 0.0) AS win
          FROM vals v JOIN pcls c ON c.feature = v.feature
          LEFT JOIN nstats s ON s.feature = v.feature AND s.value = v.split_value AND s.label = c.label),
nbin AS (SELECT feature, split_value, 0 AS branch, label, win AS w FROM nbin0
         UNION ALL SELECT feature, split_value, 1, label, tot - win FROM nbin0)"""

ORACLE["gaussian_stats"] = f"""
WITH {_EX}, {_NUMLONG}, {_gstats_sql()}
SELECT feature, label, n, round(mean, 6) AS mean, round(var, 6) AS variance, min, max FROM gstats"""
ORACLE["merge_gaussian_stats"] = ORACLE["gaussian_stats"]
ORACLE["gaussian_density"] = f"""
WITH {_EX}, {_NUMLONG}, {_gstats_sql()}
SELECT {_LI_ORDER}, l.feature,
       round(CASE WHEN g.n = 0 THEN 0.0
                  WHEN sqrt(g.var) > 0 THEN exp(-pow((l.value - g.mean) / sqrt(g.var), 2) / 2)
                                            / (sqrt(2 * pi()) * sqrt(g.var))
                  WHEN l.value = g.mean THEN 1.0 ELSE 0.0 END, 9) AS density
FROM numlong l JOIN gstats g ON g.feature = l.feature AND g.label = l.label"""
ORACLE["nominal_stats"] = f"""
WITH {_EX}, {_NOMLONG}, {_NSTATS} SELECT feature, label, value, w FROM nstats"""
ORACLE["merge_nominal_stats"] = ORACLE["nominal_stats"]
ORACLE["nominal_probability"] = f"""
WITH {_EX}, {_NOMLONG}, {_NSTATS}
SELECT feature, label, value,
       round(CASE WHEN sum(w) OVER (PARTITION BY feature, label) = 0 THEN 0.0
                  ELSE (w + 1.0) / (sum(w) OVER (PARTITION BY feature, label)
                                    + CASE feature WHEN 0 THEN 2.0 WHEN 1 THEN 7.0 ELSE 1.0 END)
             END, 9) AS probability
FROM nstats"""
ORACLE["split_points"] = f"""
WITH {_EX}, {_NUMLONG}, {_gstats_sql()}, {_points_sql()}
SELECT feature, point_idx, round(point, 6) AS point FROM pts"""
ORACLE["gaussian_split_weights"] = f"""
WITH {_EX}, {_NUMLONG}, {_gstats_sql()}, {_points_sql()}, {_gpost_sql()}
SELECT feature, point_idx, branch, label, round(w, 6) AS w FROM gpost"""
ORACLE["nominal_binary_splits"] = f"""
WITH {_EX}, {_NOMLONG}, {_NSTATS}, {_NBIN}
SELECT feature, split_value, branch, label, w FROM nbin"""
ORACLE["nominal_multiway_split"] = f"""
WITH {_EX}, {_NOMLONG}, {_NSTATS}
SELECT feature, CAST(value AS INTEGER) AS branch, label, w FROM nstats"""

_CANDS = f"""{_EX}, {_NUMLONG}, {_gstats_sql()}, {_points_sql()}, {_gpost_sql()},
{_NOMLONG}, {_NSTATS}, {_NBIN},
post AS (SELECT feature, point_idx AS cand, branch, label, w FROM gpost
         UNION ALL
         SELECT feature + 4, CAST(split_value AS INTEGER), branch, label, w FROM nbin)"""


def _info_gain_sql(cand: str, post: str = "post") -> str:
    on = " AND ".join(f"b.{c} = pre.{c}" for c in cand.split(", "))
    return f"""ib AS (SELECT {cand}, branch, sum(w) AS sb,
                 sum(CASE WHEN w > 0 THEN w * log2(w) ELSE 0.0 END) AS wl
          FROM {post} GROUP BY {cand}, branch),
ic AS (SELECT {cand}, label, sum(w) AS pc FROM {post} GROUP BY {cand}, label),
pre AS (SELECT {cand}, sum(pc) AS S, sum(CASE WHEN pc > 0 THEN pc * log2(pc) ELSE 0.0 END) AS pl
        FROM ic GROUP BY {cand}),
pa AS (SELECT {', '.join('b.' + c for c in cand.split(', '))},
              sum(CASE WHEN sb > 0 THEN sb * log2(sb) ELSE 0.0 END) AS sl, sum(wl) AS wl,
              sum(CASE WHEN sb > S * 0.01 THEN 1 ELSE 0 END) AS ngt
       FROM ib b JOIN pre ON {on} GROUP BY {', '.join('b.' + c for c in cand.split(', '))}),
merits AS (SELECT {', '.join('pre.' + c for c in cand.split(', '))},
                  CASE WHEN ngt < 2 THEN '-inf'::DOUBLE
                       ELSE (CASE WHEN S > 0 THEN log2(S) - pl / S ELSE 0.0 END)
                            - (CASE WHEN S > 0 THEN (sl - wl) / S ELSE 0.0 END) END AS merit
           FROM pre JOIN pa ON {on.replace('b.', 'pa.')})"""


ORACLE["info_gain"] = f"""
WITH {_CANDS}, {_info_gain_sql('feature, cand')}
SELECT feature, cand, round(merit, 6) AS merit FROM merits"""
ORACLE["gini_merit"] = f"""
WITH {_CANDS},
gb AS (SELECT feature, cand, branch, sum(w) AS sb, sum(w * w) AS sq FROM post GROUP BY ALL),
gg AS (SELECT feature, cand, CASE WHEN sb > 0 THEN (1.0 - sq / (sb * sb)) * sb
                                   / sum(sb) OVER (PARTITION BY feature, cand) ELSE 0.0 END AS g FROM gb)
SELECT feature, cand, round(1.0 - sum(g), 6) AS merit FROM gg GROUP BY feature, cand"""
ORACLE["variance_reduction"] = f"""
WITH {_EX}, {_NUMLONG}, {_gstats_sql()}, {_points_sql()},
mom AS (SELECT p.point_idx, CASE WHEN e.f_qty < p.point THEN 0 ELSE 1 END AS branch,
               CAST(count(*) AS DOUBLE) AS n, sum(e.f_price) AS s, sum(e.f_price * e.f_price) AS q
        FROM ex e JOIN pts p ON p.feature = 0 GROUP BY ALL),
tot AS (SELECT point_idx, sum(n) AS N, sum(s) AS SS, sum(q) AS QQ, min(n) AS nmin FROM mom GROUP BY ALL),
wv AS (SELECT m.point_idx, sum(m.n / t.N * ((m.q - m.s * m.s / floor(m.n)) / floor(m.n))) AS wv
       FROM mom m JOIN tot t USING (point_idx) GROUP BY ALL)
SELECT point_idx, round(CASE WHEN nmin < 5 THEN 0.0
                             ELSE (QQ - SS * SS / floor(N)) / floor(N) - wv END, 4) AS merit
FROM tot JOIN wv USING (point_idx)"""
ORACLE["best_split_per_feature"] = f"""
WITH {_CANDS}, {_info_gain_sql('feature, cand')},
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(merit, 12) DESC, cand) AS rn
      FROM merits)
SELECT feature, cand, round(merit, 6) AS merit FROM r WHERE rn = 1"""

_LEAF = f"""{_EX}, {_NUMLONG}, {_gstats_sql(True)}, {_points_sql(True)}, {_gpost_sql(True)},
lpost AS (SELECT l_linestatus, feature, point_idx AS cand, branch, label, w FROM gpost),
{_info_gain_sql('l_linestatus, feature, cand', 'lpost')},
bestf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus, feature
                                                     ORDER BY round(merit, 12) DESC, cand) AS rn
                         FROM merits) WHERE rn = 1),
leaves AS (SELECT l_linestatus, sum(n) AS weight FROM gstats WHERE feature = 0 GROUP BY l_linestatus),
cands AS (SELECT l_linestatus, feature, merit, feature AS ord FROM bestf
          UNION ALL SELECT l_linestatus, -1, '-inf'::DOUBLE, 1073741824 FROM leaves),
ranked AS (SELECT l_linestatus, feature, merit,
                  row_number() OVER (PARTITION BY l_linestatus ORDER BY round(merit, 12) DESC, ord DESC)
                    AS rank FROM cands),
bounds AS (SELECT l_linestatus, weight,
                  sqrt(log2(3) * log2(3) * ln(1.0 / 1e-7) / (2.0 * weight)) AS bound FROM leaves)"""
ORACLE["rank_split_suggestions"] = f"""
WITH {_LEAF} SELECT l_linestatus, feature, CAST(rank AS INTEGER) AS rank, round(merit, 6) AS merit
FROM ranked"""
ORACLE["hoeffding_bound"] = f"""
WITH {_LEAF} SELECT l_linestatus, weight, round(bound, 9) AS bound FROM bounds"""
ORACLE["should_split"] = f"""
WITH {_LEAF},
top AS (SELECT l_linestatus, max(CASE WHEN rank = 1 THEN feature END) AS best_feature,
               max(CASE WHEN rank = 1 THEN merit END) AS bm, max(CASE WHEN rank = 2 THEN merit END) AS sm,
               count(*) AS k FROM ranked WHERE rank <= 2 GROUP BY l_linestatus)
SELECT t.l_linestatus, t.best_feature,
       CASE WHEN k < 2 THEN k > 0 ELSE (b.bound < 0.05) OR coalesce((bm - sm) > b.bound, false) END
         AS split
FROM top t JOIN bounds b USING (l_linestatus)"""
_STATUS_CANDS = _CANDS.replace("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS label",
                               "CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS label")
ORACLE["poor_features"] = f"""
WITH {_STATUS_CANDS}, {_info_gain_sql('feature, cand')},
best AS (SELECT feature, max(round(merit, 12)) AS merit FROM merits GROUP BY feature),
bound AS (SELECT sqrt(ln(1.0 / 1e-7) / (2.0 * count(*))) AS bound FROM ex)
SELECT 0 AS leaf, feature FROM best, bound WHERE (SELECT max(merit) FROM best) - merit > bound"""

# ------------------------------------------------------------------ naive Bayes
_NB_TF = f"""tf AS {_DOC_TF},
ltf AS (SELECT tf.doc_id, tf.word, tf.n, l.quality AS label FROM tf JOIN labels l USING (doc_id)),
cc AS (SELECT label, CAST(count(DISTINCT doc_id) AS DOUBLE) AS n FROM ltf GROUP BY label),
fs AS (SELECT label, word AS feature, sum(n) AS mass FROM ltf GROUP BY label, word)"""
ORACLE["nb_train"] = f"""
WITH {_NB_TF}
SELECT label, feature, mass FROM fs UNION ALL SELECT label, NULL, n FROM cc"""
ORACLE["nb_merge"] = ORACLE["nb_train"]
_NB_PARAMS = f"""{_NB_TF},
scal AS (SELECT sum(mass) AS total, CAST(count(DISTINCT feature) AS DOUBLE) AS nf,
                (SELECT CAST(count(*) AS DOUBLE) FROM cc) AS nc FROM fs),
cm AS (SELECT label, sum(mass) AS class_mass FROM fs GROUP BY label),
pri AS (SELECT cc.label, ln(cc.n + 1.0) - ln(scal.total + scal.nc) AS log_prior,
               ln(1.0) - ln(coalesce(cm.class_mass, 0.0) + scal.nf) AS log_default
        FROM cc LEFT JOIN cm USING (label), scal),
cond AS (SELECT fs.label, fs.feature, ln(fs.mass + 1.0) - ln(cm.class_mass + scal.nf) AS log_cond
         FROM fs JOIN cm USING (label), scal)"""
ORACLE["nb_params"] = f"""
WITH {_NB_PARAMS}
SELECT label, feature, round(log_cond, 9) AS log_p FROM cond
UNION ALL SELECT label, NULL, round(log_prior, 9) FROM pri"""
ORACLE["nb_predict"] = f"""
WITH {_NB_PARAMS},
vocab AS (SELECT DISTINCT feature FROM fs),
ent AS (SELECT t.doc_id, t.word, t.n FROM tf t JOIN vocab v ON v.feature = t.word),
sc AS (SELECT d.doc_id, p.label,
              p.log_prior + coalesce(sum(e.n * coalesce(c.log_cond, p.log_default)), 0.0) AS score
       FROM (SELECT DISTINCT doc_id FROM tf) d CROSS JOIN pri p
       LEFT JOIN ent e ON e.doc_id = d.doc_id
       LEFT JOIN cond c ON c.label = p.label AND c.feature = e.word
       GROUP BY d.doc_id, p.label, p.log_prior),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM sc)
SELECT doc_id, label AS prediction FROM r WHERE rn = 1"""

_PREQ_ORDER = f"l_shipdate, {_LI_ORDER}"
_PREQ_SUMS = []
for _c in range(3):
    _hit = f"(cmd = 'EXAMPLE' AND label = {_c})"
    _PREQ_SUMS.append(f"coalesce(sum(CASE WHEN {_hit} THEN 1.0 ELSE 0.0 END) OVER w, 0.0) AS n{_c}")
    for _j, _f in enumerate("abc"):
        _PREQ_SUMS.append(
            f"coalesce(sum(CASE WHEN {_hit} THEN {_f} ELSE 0.0 END) OVER w, 0.0) AS f{_c}_{_j}")
_PREQ_SCORE = []
for _c in range(3):
    _mass = f"(f{_c}_0 + f{_c}_1 + f{_c}_2)"
    _tot = "(f0_0 + f0_1 + f0_2 + f1_0 + f1_1 + f1_2 + f2_0 + f2_1 + f2_2)"
    _terms = " + ".join(f"(ln(f{_c}_{_j} + 1.0) - ln({_mass} + 3.0)) * {_f}" for _j, _f in enumerate("abc"))
    _PREQ_SCORE.append(f"SELECT {_LI_ORDER}, {_c} AS label, ln(n{_c} + 1.0) - ln({_tot} + 3.0) + {_terms} AS score FROM s WHERE cmd = 'QUERY'")
ORACLE["nb_prequential"] = f"""
WITH st AS (SELECT {_LI_ORDER}, l_shipdate,
                   CASE WHEN l_linestatus = 'F' THEN 'EXAMPLE' ELSE 'QUERY' END AS cmd,
                   l_quantity AS a, round(l_discount * 100) AS b, round(l_tax * 100) AS c,
                   CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS label
            FROM lineitem),
s AS (SELECT *, {', '.join(_PREQ_SUMS)} FROM st
      WINDOW w AS (ORDER BY {_PREQ_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sc AS ({' UNION ALL '.join(_PREQ_SCORE)}),
r AS (SELECT *, row_number() OVER (PARTITION BY {_LI_ORDER} ORDER BY score DESC, label) AS rn FROM sc)
SELECT {_LI_ORDER}, label AS prediction FROM r WHERE rn = 1"""

def _nb_running(rows: str, frame: str) -> str:
    """Answers to ``rows`` (doc_id, label, seq, asked) by the labelled rows that ``frame`` leaves before them, in the order of ``seq``."""
    sums = ", ".join(f"coalesce(sum(CASE WHEN label = {c} THEN {{0}} ELSE 0.0 END) OVER w, 0.0) AS {{1}}{c}" for c in (0, 1))
    scores = " UNION ALL ".join(
        f"SELECT doc_id, {c} AS label, ln(n{c} + 1.0) - ln(m0 + m1 + 2.0) + coalesce(s{c} - x * ln(m{c} + size), 0.0) AS score FROM a"
        for c in (0, 1))
    return f"""
WITH d AS ({rows}), tf AS {_DOC_TF},
e AS (SELECT tf.*, d.label, d.seq, d.asked FROM tf JOIN d USING (doc_id)),
f AS (SELECT doc_id, asked, n, count(label) OVER w AS seen, {sums.format("n", "f")}
      FROM e WINDOW w AS (PARTITION BY word ORDER BY seq {frame})),
t AS (SELECT doc_id, sum(n) AS x, sum(n * ln(f0 + 1.0)) AS s0, sum(n * ln(f1 + 1.0)) AS s1 FROM f WHERE asked AND seen > 0 GROUP BY doc_id),
born AS (SELECT doc_id, count(*) AS born FROM (SELECT word, min_by(doc_id, (seq, doc_id)) AS doc_id FROM e WHERE label IS NOT NULL GROUP BY word)
         GROUP BY doc_id),
r AS (SELECT d.*, coalesce(g.mass, 0.0) AS mass, coalesce(born.born, 0) AS born
      FROM d LEFT JOIN (SELECT doc_id, sum(n) AS mass FROM tf GROUP BY doc_id) g USING (doc_id) LEFT JOIN born USING (doc_id)),
m AS (SELECT doc_id, asked, coalesce(sum(born) OVER w, 0) AS size, count(label) OVER w AS trained,
             {sums.format("1.0", "n")}, {sums.format("mass", "m")}
      FROM r WINDOW w AS (ORDER BY seq {frame})),
a AS (SELECT * FROM m LEFT JOIN t USING (doc_id) WHERE asked),
sc AS ({scores}),
b AS (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM sc)"""


ORACLE["nb_prequential_words"] = _nb_running(
    "SELECT doc_id, l.quality AS label, doc_id AS seq, l.quality IS NULL AS asked FROM documents LEFT JOIN labels l USING (doc_id)",
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING") + """
SELECT doc_id, label AS prediction FROM b WHERE rn = 1"""
# epochs of 400 rows; both classes are among the labelled rows of the first one
ORACLE["nb_stream"] = _nb_running(
    """SELECT doc_id, l.quality AS label, (row_number() OVER (ORDER BY doc_id) - 1) // 400 AS seq, true AS asked
           FROM documents LEFT JOIN labels l USING (doc_id)""",
    "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING") + """
SELECT doc_id, CASE WHEN trained > 0 THEN label END AS prediction FROM b JOIN m USING (doc_id) WHERE rn = 1"""

_VOTES = f"""{_EX}, {_NUMLONG}, {_gstats_sql()}, {_NOMLONG}, {_NSTATS},
cw AS (SELECT label, CAST(count(*) AS DOUBLE) AS w FROM ex GROUP BY label),
prior AS (SELECT label, w / sum(w) OVER () AS prior FROM cw),
np AS (SELECT {', '.join('l.' + c for c in _LI_ORDER.split(', '))}, g.label,
              CASE WHEN g.n = 0 THEN 0.0
                   WHEN sqrt(g.var) > 0 THEN exp(-pow((l.value - g.mean) / sqrt(g.var), 2) / 2)
                                             / (sqrt(2 * pi()) * sqrt(g.var))
                   WHEN l.value = g.mean THEN 1.0 ELSE 0.0 END AS p
       FROM numlong l JOIN gstats g ON g.feature = l.feature),
tot AS (SELECT feature, label, sum(w) AS tot FROM nstats GROUP BY feature, label),
grid AS (SELECT f.feature, c.label, coalesce(t.tot, 0.0) AS tot,
                CASE f.feature WHEN 0 THEN 2.0 ELSE 7.0 END AS vsize
         FROM (SELECT DISTINCT feature FROM nomlong) f CROSS JOIN cw c
         LEFT JOIN tot t ON t.feature = f.feature AND t.label = c.label),
pp AS (SELECT {', '.join('l.' + c for c in _LI_ORDER.split(', '))}, gr.label,
              CASE WHEN gr.tot = 0 THEN 0.0 ELSE (coalesce(s.w, 0.0) + 1.0) / (gr.tot + gr.vsize) END AS p
       FROM nomlong l JOIN grid gr ON gr.feature = l.feature
       LEFT JOIN nstats s ON s.feature = l.feature AND s.label = gr.label AND s.value = l.value),
allp AS (SELECT * FROM np UNION ALL SELECT * FROM pp),
agg AS (SELECT {_LI_ORDER}, label, sum(CASE WHEN p > 0 THEN log10(p) ELSE 0.0 END) AS lg,
               sum(CASE WHEN p <= 0 THEN 1 ELSE 0 END) AS zeros FROM allp GROUP BY ALL),
lv AS (SELECT a.*, CASE WHEN zeros > 0 THEN '-inf'::DOUBLE ELSE log10(pr.prior) + lg END AS log_vote
       FROM agg a JOIN prior pr USING (label))"""
ORACLE["observer_nb_log_votes"] = f"""
WITH {_VOTES} SELECT {_LI_ORDER}, label, round(log_vote, 6) AS log_vote FROM lv"""
ORACLE["observer_nb_votes"] = f"""
WITH {_VOTES},
v AS (SELECT {_LI_ORDER}, label, CASE WHEN zeros > 0 THEN 0.0 ELSE pow(10.0, log_vote) END AS vote FROM lv)
SELECT {_LI_ORDER}, label, round(vote / sum(vote) OVER (PARTITION BY {_LI_ORDER}), 6) AS posterior FROM v"""

# ------------------------------------------------------------------ ensemble / table helpers
from driftwood.operators.ensemble import poisson_cdf_table  # noqa: E402

ORACLE["majority_vote"] = f"""
WITH {_EX},
c AS (SELECT l_orderkey, label AS vote, count(*) AS n FROM ex GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, vote) AS rn FROM c)
SELECT l_orderkey, vote FROM r WHERE rn = 1"""
_U = ("(CAST(CAST('0x' || substr(md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, 1)), 1, 13) AS BIGINT)"
      " AS DOUBLE) + 0.5) / 4503599627370496.0")
ORACLE["poisson_weights"] = f"""
SELECT {_LI_ORDER}, CAST(len(list_filter([{', '.join(repr(c) for c in poisson_cdf_table(1.0))}],
                                        lambda c: c < {_U})) AS INTEGER) AS weight
FROM lineitem"""
ORACLE["normalize_counts"] = """
WITH c AS (SELECT l_suppkey, l_returnflag, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag, round(n / sum(n) OVER (PARTITION BY l_suppkey), 9) AS fraction FROM c"""
ORACLE["crosstab"] = """
SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS "F",
       sum(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) AS "O"
FROM lineitem GROUP BY l_returnflag"""
ORACLE["crosstab_transpose"] = """
SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) AS "A",
       sum(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END) AS "N",
       sum(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS "R"
FROM lineitem GROUP BY l_linestatus"""
ORACLE["one_vs_rest"] = """
WITH d AS (SELECT l_linestatus, l_returnflag, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, sum(w) AS tot FROM d GROUP BY l_returnflag),
v AS (SELECT DISTINCT l_linestatus AS split_value FROM d)
SELECT v.split_value, t.l_returnflag, coalesce(d.w, 0.0) AS w_in, t.tot - coalesce(d.w, 0.0) AS w_rest
FROM v CROSS JOIN t LEFT JOIN d ON d.l_linestatus = v.split_value AND d.l_returnflag = t.l_returnflag"""
ORACLE["save_load_model"] = ORACLE["nb_train"]
ORACLE["add_arrays"] = """
WITH e AS (SELECT label, len(embedding) AS n, generate_subscripts(embedding, 1) - 1 AS pos,
                  unnest(embedding)::DOUBLE AS v FROM embeddings),
s AS (SELECT label, pos, sum(v) AS s FROM e GROUP BY label, pos),
m AS (SELECT label, min(n) AS mn FROM e GROUP BY label)
SELECT s.label, list(round(s.s, 6) ORDER BY s.pos) AS vec_sum
FROM s JOIN m USING (label) WHERE s.pos < m.mn GROUP BY s.label"""

# ------------------------------------------------------------------ statistics
_NB_PRED = ORACLE["nb_predict"].strip()
ORACLE["accuracy_with_error"] = f"""
WITH pred AS ({_NB_PRED}),
j AS (SELECT p.doc_id, p.prediction, l.quality, d.lang FROM pred p JOIN labels l USING (doc_id)
      JOIN documents d USING (doc_id)),
a AS (SELECT lang, avg(CASE WHEN prediction = quality THEN 1.0 ELSE 0.0 END) AS accuracy,
             count(*) AS n FROM j GROUP BY lang)
SELECT lang, round(accuracy, 9) AS accuracy, n,
       round(CASE WHEN n > 0 THEN sqrt(accuracy * (1.0 - accuracy) / n) ELSE 0.0 END, 9) AS std_error
FROM a"""
ORACLE["gaussian_tail"] = f"""
WITH m AS (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS sd FROM events GROUP BY ALL),
z AS (SELECT e.event_id, CASE WHEN m.sd > 0 THEN (e.value - m.mean) / m.sd END AS z
      FROM events e JOIN m USING (event_type))
SELECT event_id, round(z, 6) AS z, round({_phi_sql('z')}, 6) AS cdf FROM z"""


def _chi2_sql(x: str, k: str) -> str:
    h = f"({x} / 2.0)"
    even = (f"exp(-{h}) * list_sum(list_transform(range(0, CAST({k} / 2 AS BIGINT)), "
            f"lambda i: exp(i * ln({h}) - lgamma(i + 1.0))))")
    erfc = f"(2.0 * {_phi_sql(f'-sqrt({h}) * sqrt(2.0)')})"
    odd = (f"{erfc} + exp(-{h}) * coalesce(list_sum(list_transform(range(1, CAST(({k} - 1) / 2 AS BIGINT) + 1), "
           f"lambda i: exp((i - 0.5) * ln({h}) - lgamma(i + 0.5)))), 0.0)")
    return f"(CASE WHEN {x} <= 0 THEN 1.0 WHEN {k} % 2 = 0 THEN {even} ELSE {odd} END)"


ORACLE["chi_square_test"] = f"""
WITH {_EX}, {_NOMLONG},
o AS (SELECT feature, value, label, CAST(count(*) AS DOUBLE) AS o FROM nomlong GROUP BY ALL),
r AS (SELECT feature, value, sum(o) AS r FROM o GROUP BY ALL),
c AS (SELECT feature, label, sum(o) AS c FROM o GROUP BY ALL),
n AS (SELECT feature, sum(o) AS n FROM o GROUP BY ALL),
cells AS (SELECT r.feature, r.value, c.label, r.r, c.c, n.n, coalesce(o.o, 0.0) AS o
          FROM r JOIN c ON c.feature = r.feature JOIN n ON n.feature = r.feature
          LEFT JOIN o ON o.feature = r.feature AND o.value = r.value AND o.label = c.label),
s AS (SELECT feature, sum(pow(o - r * c / n, 2) / (r * c / n)) AS statistic,
             CAST((count(DISTINCT value) - 1) * (count(DISTINCT label) - 1) AS BIGINT) AS dof
      FROM cells GROUP BY feature)
SELECT feature, round(statistic, 6) AS statistic, dof,
       round({_chi2_sql('statistic', 'dof')}, 9) AS p_value FROM s"""
ORACLE["anova_f_test"] = f"""
WITH {_EX}, {_NUMLONG},
cls AS (SELECT feature, label, CAST(count(*) AS DOUBLE) AS nc, avg(value) AS mc,
               coalesce(var_pop(value), 0.0) * count(*) AS ssw FROM numlong GROUP BY ALL),
tot AS (SELECT feature, sum(nc) AS n, sum(nc * mc) / sum(nc) AS m, count(*) AS k FROM cls GROUP BY ALL),
a AS (SELECT t.feature, sum(c.nc * pow(c.mc - t.m, 2)) AS ssb, sum(c.ssw) AS ssw,
             CAST(t.k - 1 AS BIGINT) AS df_between, CAST(t.n - t.k AS BIGINT) AS df_within
      FROM cls c JOIN tot t USING (feature) GROUP BY t.feature, t.k, t.n),
f AS (SELECT feature, (ssb / df_between) / (ssw / df_within) AS f_stat, df_between, df_within FROM a)
SELECT feature, round(f_stat, 6) AS f_stat, df_between, df_within,
       round(pow(df_within / (df_within + 2.0 * f_stat), df_within / 2.0), 9) AS p_value FROM f"""

# ------------------------------------------------------------------ Hoeffding tree
from driftwood.plans.tree_oracle import tree_sql  # noqa: E402

ORACLE.update(tree_sql(_EX, _phi_sql, _info_gain_sql))
ORACLE["ht_save_load"] = ORACLE["ht_predict_nb"]

# ------------------------------------------------------------------ linear models
import math as _math  # noqa: E402

_W0 = [_math.sin(i + 1) / 4.0 for i in range(64)] + [0.1]
_W0_SQL = "[" + ", ".join(repr(x) for x in _W0) + "]::DOUBLE[]"
_LIN = f"""e AS (SELECT vec_id, CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END AS y,
                  list_append(list_transform(embedding, lambda x: x::DOUBLE), 1.0) AS xb FROM embeddings),
d AS (SELECT *, list_sum(list_transform(xb, lambda x, i: x * ({_W0_SQL})[i])) AS dot FROM e)"""
_PM = "CASE WHEN y = 0 THEN -1.0 ELSE 1.0 END"
_LOSS = {
    "squared": "0.5 * (dot - y) * (dot - y)",
    "perceptron": "0.5 * (dot - y) * (dot - y)",
    "hinge": f"greatest(0.0, 1.0 - {_PM} * dot)",
    "logistic": f"ln(1.0 + exp(-{_PM} * dot))",
}
_GRAD = {
    "squared": "dot - y",
    "hinge": f"CASE WHEN {_PM} * dot < 1 THEN -{_PM} ELSE 0.0 END",
    "logistic": f"-{_PM} * (1.0 - 1.0 / (1.0 + exp(-{_PM} * dot)))",
    "perceptron": "y - CASE WHEN dot >= 0 THEN 1.0 ELSE 0.0 END",
}
ORACLE["linear_score"] = f"WITH {_LIN} SELECT vec_id, round(dot, 6) AS score FROM d"
ORACLE["linear_predict"] = f"""WITH {_LIN}
SELECT vec_id, CASE WHEN dot >= 0 THEN 1.0 ELSE 0.0 END AS pred_squared,
       CASE WHEN 1.0 / (1.0 + exp(-dot)) > 0.5 THEN 1.0 ELSE 0.0 END AS pred_logistic FROM d"""
ORACLE["linear_loss"] = f"""WITH {_LIN}
SELECT vec_id, {', '.join(f'round({v}, 9) AS loss_{k}' for k, v in _LOSS.items())} FROM d"""
ORACLE["linear_prob"] = f"""WITH {_LIN}, d1 AS (SELECT vec_id, 1.0 AS y, dot FROM d)
SELECT vec_id, {', '.join(f'round({_LOSS[k]}, 9) AS prob_{k}' for k in ('squared', 'hinge', 'logistic'))}
FROM d1"""


def _grad_sql(k: str) -> str:
    return f"""SELECT '{k}' AS loss, CAST(i - 1 AS INTEGER) AS index,
       round(sum(x * -({_GRAD[k]})), 6) AS grad
FROM (SELECT y, dot, unnest(xb) AS x, generate_subscripts(xb, 1) AS i FROM d) t GROUP BY i"""


ORACLE["linear_gradient"] = f"""WITH {_LIN}
{' UNION ALL '.join(_grad_sql(k) for k in ('squared', 'hinge', 'logistic', 'perceptron'))}"""
_GRAD_SQ = f"""g AS (SELECT CAST(i - 1 AS INTEGER) AS index, sum(x * -({_GRAD['squared']})) AS grad,
                        count(*) AS n
             FROM (SELECT y, dot, unnest(xb) AS x, generate_subscripts(xb, 1) AS i FROM d) t GROUP BY i)"""
ORACLE["regularize"] = f"""WITH {_LIN}, {_GRAD_SQ}
SELECT index, round(-(CASE WHEN grad >= 0 THEN 1.0 ELSE -1.0 END), 6) AS reg_l1,
       round(-grad, 6) AS reg_l2, round(0.0 * grad, 6) AS reg_zero FROM g"""
ORACLE["linear_update"] = f"""WITH {_LIN}, {_GRAD_SQ},
w AS (SELECT CAST(unnest(range(65)) AS INTEGER) AS index, unnest({_W0_SQL}) AS weight)
SELECT w.index, round(w.weight + 0.01 * coalesce(g.grad, 0.0), 6) AS weight
FROM w LEFT JOIN g USING (index)"""


def _train_sql(steps: int = 3, lr: float = 0.1, reg: float = 0.01) -> str:
    ctes = [f"""e AS (SELECT vec_id, CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END AS y,
                  list_append(list_transform(embedding, lambda x: x::DOUBLE), 1.0) AS xb FROM embeddings)""",
            """ex AS (SELECT vec_id, y, unnest(xb) AS x, CAST(generate_subscripts(xb, 1) - 1 AS INTEGER)
                        AS index FROM e)""",
            f"""w0 AS (SELECT CAST(unnest(range(65)) AS INTEGER) AS index, unnest({_W0_SQL}) AS weight)"""]
    for s in range(steps):
        ctes.append(f"""d{s} AS (SELECT ex.vec_id, any_value(ex.y) AS y, sum(ex.x * w{s}.weight) AS dot
                        FROM ex JOIN w{s} USING (index) GROUP BY ex.vec_id)""")
        ctes.append(f"""g{s} AS (SELECT ex.index, sum(ex.x * -(d{s}.dot - d{s}.y)) AS grad, count(*) AS n
                        FROM ex JOIN d{s} USING (vec_id) GROUP BY ex.index)""")
        ctes.append(f"""w{s + 1} AS (SELECT w{s}.index,
                        w{s}.weight + {lr} * (g{s}.grad / g{s}.n + {reg} * (-w{s}.weight)) AS weight
                        FROM w{s} JOIN g{s} USING (index))""")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT index, round(weight, 6) AS weight FROM w{steps}"


ORACLE["linear_train"] = _train_sql()


def _linear_stream_sql(epochs: int = 4, size: int = 125, lr: float = 0.1, reg: float = 0.01) -> str:
    """One gradient step an epoch, unrolled: tables of at most ``epochs * size`` vectors."""
    ctes = [f"""e AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // {size} AS epoch, CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END AS y,
                  list_append(list_transform(embedding, lambda x: x::DOUBLE), 1.0) AS xb FROM embeddings)""",
            "ex AS (SELECT vec_id, epoch, y, unnest(xb) AS x, CAST(generate_subscripts(xb, 1) - 1 AS INTEGER) AS index FROM e)",
            f"w0 AS (SELECT CAST(unnest(range(65)) AS INTEGER) AS index, unnest({_W0_SQL}) AS weight)"]
    for s in range(epochs):
        ctes.append(f"""d{s} AS (SELECT ex.vec_id, any_value(ex.y) AS y, sum(ex.x * w{s}.weight) AS dot
                        FROM ex JOIN w{s} USING (index) WHERE epoch = {s} GROUP BY ex.vec_id)""")
        ctes.append(f"""g{s} AS (SELECT ex.index, sum(ex.x * -(d{s}.dot - d{s}.y)) AS grad, count(*) AS n
                        FROM ex JOIN d{s} USING (vec_id) GROUP BY ex.index)""")
        ctes.append(f"""w{s + 1} AS (SELECT w{s}.index, w{s}.weight + {lr} * (g{s}.grad / g{s}.n + {reg} * (-w{s}.weight)) AS weight
                        FROM w{s} JOIN g{s} USING (index))""")
    rows = " UNION ALL ".join(f"SELECT vec_id, dot FROM d{s}" for s in range(epochs))
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, round(dot, 6) AS score, CASE WHEN dot >= 0 THEN 1.0 ELSE 0.0 END AS prediction FROM ({rows})"""


ORACLE["linear_stream"] = _linear_stream_sql()

# ------------------------------------------------------------------ membership and search


def _bloom(members: str, col: str) -> str:
    """CTEs: filter size ``z`` (m, k) and the set positions with their rows, ``f``."""
    return f"""src AS ({members}),
z0 AS (SELECT greatest(1, CAST(floor(-n * ln(0.01) / (ln(2) * ln(2))) AS BIGINT)) AS m, n
       FROM (SELECT count(DISTINCT {col}) AS n FROM src)),
z AS (SELECT m, greatest(1, CAST(round(m / greatest(1, n) * ln(2)) AS BIGINT)) AS k FROM z0)"""


def _at(col: str) -> str:
    h = [f"(CAST('0x' || substr(md5(CAST({col} AS VARCHAR)), {p}, 15) AS BIGINT) % m)" for p in (1, 16)]
    return f"unnest(list_transform(range(0, k), lambda i: ({h[0]} + i * {h[1]}) % m))"


_MACHINERY = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'"
_ANSWER = """CASE WHEN maybe THEN 'MAYBE, filter probably contains ' ELSE 'NO, filter definitely does not contain ' END
  || CAST(c_custkey AS VARCHAR)"""
ORACLE["bloom_build"] = f"""
WITH {_bloom(_MACHINERY, 'c_custkey')} SELECT DISTINCT {_at('c_custkey')} AS pos FROM src, z"""
ORACLE["bloom_probe"] = f"""
WITH {_bloom(_MACHINERY, 'c_custkey')}, bits AS (SELECT DISTINCT {_at('c_custkey')} AS pos FROM src, z),
q AS (SELECT c_custkey, {_at('c_custkey')} AS pos FROM customer, z),
a AS (SELECT q.c_custkey, bool_and(bits.pos IS NOT NULL) AS maybe
      FROM q LEFT JOIN bits ON bits.pos = q.pos GROUP BY q.c_custkey)
SELECT c_custkey, maybe, {_ANSWER} AS answer FROM a"""
ORACLE["bloom_probe_asof"] = f"""
WITH {_bloom('SELECT o_orderkey, o_custkey FROM orders', 'o_custkey')},
first AS (SELECT pos, min(o_orderkey) AS first_seq FROM (SELECT o_orderkey, {_at('o_custkey')} AS pos FROM src, z) t
          GROUP BY pos),
q AS (SELECT c_custkey, c_custkey * 40 AS qs, {_at('c_custkey')} AS pos FROM customer, z),
a AS (SELECT q.c_custkey, bool_and(coalesce(f.first_seq < q.qs, false)) AS maybe
      FROM q LEFT JOIN first f ON f.pos = q.pos GROUP BY q.c_custkey)
SELECT c_custkey, maybe, {_ANSWER} AS answer FROM a"""


def _block_at(col: str) -> str:
    """A value's bits in a blocked filter as (block, bit), one row each."""
    h = [f"CAST('0x' || substr(md5(CAST({col} AS VARCHAR)), {p}, {n}) AS BIGINT)" for p, n in ((1, 14), (15, 8), (23, 8))]
    inside = f"unnest(list_transform(range(0, k), lambda i: ({h[1]} % 32768 + i * (({h[2]} | 1) % 32768)) % 32768))"
    return f"{h[0]} % ((m + 32767) // 32768) AS block, {inside} AS bit"


ORACLE["bloom_probe_blocks"] = f"""
WITH {_bloom("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'", 'o_orderkey')},
bits AS (SELECT DISTINCT block, bit FROM (SELECT {_block_at('o_orderkey')} FROM src, z) t),
q AS (SELECT l_orderkey, {_block_at('l_orderkey')} FROM (SELECT DISTINCT l_orderkey FROM lineitem), z),
a AS (SELECT q.l_orderkey, bool_and(bits.bit IS NOT NULL) AS maybe FROM q LEFT JOIN bits USING (block, bit) GROUP BY q.l_orderkey)
SELECT {_LI_ORDER}, maybe FROM lineitem JOIN a USING (l_orderkey)"""
ORACLE["bloom_probe_asof_blocks"] = f"""
WITH {_bloom('SELECT l_orderkey, l_partkey FROM lineitem', 'l_partkey')},
v AS (SELECT l_partkey, min(l_orderkey) AS first_seq FROM src GROUP BY l_partkey),
p AS (SELECT l_partkey, first_seq, {_block_at('l_partkey')} FROM v, z),
first AS (SELECT block, bit, min(first_seq) AS first_seq FROM p GROUP BY block, bit),
a AS (SELECT p.l_partkey, max(first.first_seq) AS complete_at FROM p JOIN first USING (block, bit) GROUP BY p.l_partkey)
SELECT {_LI_ORDER}, complete_at < l_orderkey AS maybe FROM lineitem JOIN a USING (l_partkey)"""
ORACLE["substring_index"] = """
SELECT substring(text, p, 4) AS gram, item_id AS id, CAST(p AS INTEGER) AS pos
FROM (SELECT item_id, text, unnest(range(1, length(text) - 2)) AS p FROM benchmark
      WHERE length(text) >= 4) t"""
ORACLE["substring_search"] = """
SELECT DISTINCT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"""
ORACLE["substring_search_asof"] = """
SELECT DISTINCT b.item_id, d.doc_id FROM benchmark b
JOIN documents d ON contains(d.text, b.text) AND d.doc_id < b.item_id * 25"""
ORACLE["substring_search_words"] = """
WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM conversations),
h AS (SELECT DISTINCT w.word, b.item_id FROM w JOIN benchmark b ON contains(b.text, w.word))
SELECT word, item_id FROM h"""

# ------------------------------------------------------------------ formats
ORACLE["read_arff"] = f"""
WITH {_EX}
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey,
       f_qty, f_price, f_disc, f_tax, f_status, f_line, CAST(label AS DOUBLE) AS label FROM ex"""
ORACLE["read_arff_spec"] = ORACLE["read_arff"]
_ARFF_HEADER = ["@relation lineitem", *[f"@attribute {c} numeric" for c in (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "f_qty", "f_price", "f_disc", "f_tax")],
    "@attribute f_status {F,O}", "@attribute f_line {0,1,2,3,4,5,6}", "@attribute class {A,N,R}", "@data"]
ORACLE["write_arff"] = f"""
WITH {_EX}
SELECT concat_ws(',', {', '.join(f"CAST(CAST({c} AS DOUBLE) AS VARCHAR)" for c in (
    'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', 'f_qty', 'f_price', 'f_disc', 'f_tax'))},
  ['F', 'O'][CAST(f_status AS INT) + 1], CAST(CAST(f_line AS INT) AS VARCHAR), ['A', 'N', 'R'][label + 1]) AS value FROM ex
UNION ALL SELECT unnest([{', '.join(repr(h) for h in _ARFF_HEADER)}])"""
ORACLE["read_arff_sparse"] = "SELECT CAST(doc_id AS DOUBLE) AS doc_id, " + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN k = {i} THEN v END), 0.0) AS DOUBLE) AS n{i}" for i in range(1, 65)) + f"""
, CAST(sum(v) AS DOUBLE) AS label FROM {_WORD_LENGTHS} GROUP BY doc_id"""
ORACLE["tail_commands"] = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'EXAMPLE' ELSE 'QUERY' END AS cmd, o_orderkey, o_custkey, o_orderpriority FROM orders"""
ORACLE["read_examples"] = """
SELECT CAST(label AS DOUBLE) AS label, list_transform(embedding, lambda x: x::DOUBLE) AS features,
       1.0 AS weight FROM embeddings"""
ORACLE["read_examples_sparse"] = """
SELECT CAST(label AS DOUBLE) AS label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS index,
       unnest(embedding)::DOUBLE AS value, 1.0 AS weight FROM embeddings"""
ORACLE["read_examples_sparse"] = f"""
SELECT * FROM ({ORACLE['read_examples_sparse']}) t WHERE value <> 0"""
ORACLE["read_text_features"] = """
SELECT event_type AS key, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY user_id, event_type
UNION ALL SELECT 'user', CAST(user_id AS DOUBLE) FROM (SELECT DISTINCT user_id FROM events) u"""

# ------------------------------------------------------------------ streams (stream = batch)
ORACLE["running_max_subarray_stream"] = ORACLE["running_max_subarray"]
ORACLE["running_max_subarray_keyed_stream"] = ORACLE["running_max_subarray"]
ORACLE["zip_stream"] = """
SELECT x.pos, l_quantity, o_totalprice
FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS pos, l_quantity FROM lineitem) x
JOIN (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_totalprice FROM orders) y ON y.pos = x.pos"""
ORACLE["rls_stream"] = ORACLE["rls_weights"]
ORACLE["follow_the_leader_stream"] = ORACLE["follow_the_leader"]
ORACLE["bloom_stream"] = ORACLE["bloom_probe_asof"]
ORACLE["substring_search_stream"] = ORACLE["substring_search_asof"]
ORACLE["dispatch_commands"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'EXAMPLE' WHEN 'O' THEN 'QUERY' ELSE 'OTHER' END AS route,
       o_orderkey FROM orders"""
ORACLE["weighted_examples"] = """
SELECT vec_id, label / 10.0 AS weight, label + 1 AS label2, -1.0 AS f0 FROM embeddings"""

"""DuckDB twins of the Hoeffding-tree queries, unrolled over the training blocks.

The table is cut into runs of ``ROWS_PER_BLOCK`` rows by position in line-key order; the
SQL is unrolled over ``BLOCKS`` of them, those of a table of 64,000 rows (sf0.01 has 60,000).  For every block the SQL routes all rows so far with the tree of the
block before, forms the statistics of each active leaf from the rows it has seen
since it was made, ranks the split candidates and grows the tree by the leaves that split.
"""

from __future__ import annotations

import re
from collections.abc import Callable

ROWS_PER_BLOCK = 8_000
BLOCKS = 8
ROWS_PER_EPOCH = 16_000
_NUM = ("f_qty", "f_price", "f_disc", "f_tax")
_NOM = {4: ("f_status", 2), 5: ("f_line", 7)}
_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_VALUE = "CASE p.feature " + " ".join(f"WHEN {i} THEN x.{c}" for i, c in enumerate(_NUM)) + " " + " ".join(
    f"WHEN {i} THEN x.{c}" for i, (c, _) in _NOM.items()) + " END"
_BRANCH = f"""CASE p.test WHEN 'multiway' THEN CAST({_VALUE} AS INTEGER)
  WHEN 'numeric' THEN CASE WHEN {_VALUE} < p.value THEN 0 ELSE 1 END
  ELSE CASE WHEN {_VALUE} = p.value THEN 0 ELSE 1 END END"""


def _route(name: str, rows: str, nodes: str, depth: int) -> list[str]:
    """``name``: the rows with the ``leaf`` they reach in at most ``depth`` steps."""
    out = [f"{name}_0 AS MATERIALIZED (SELECT *, 0 AS leaf FROM {rows})"]
    for d in range(depth):
        out.append(f"""{name}_{d + 1} AS MATERIALIZED (
SELECT x.* EXCLUDE (leaf), coalesce(c.node_id, x.leaf) AS leaf FROM {name}_{d} x
LEFT JOIN {nodes} p ON p.node_id = x.leaf AND p.kind = 'split'
LEFT JOIN {nodes} c ON c.parent_id = p.node_id AND c.branch = {_BRANCH})""")
    out.append(f"{name} AS (SELECT * FROM {name}_{depth})")
    return out


def _statistics(s: str, routed: str, nodes: str) -> list[str]:
    """Statistics of the active leaves from the rows since they were made (suffix ``s``)."""
    num = " UNION ALL ".join(f"SELECT leaf, label, {i} AS feature, {c} AS value FROM act{s}" for i, c in enumerate(_NUM))
    nom = " UNION ALL ".join(f"SELECT leaf, label, {i} AS feature, {c} AS value FROM act{s}" for i, (c, _) in _NOM.items())
    return [
        f"""act{s} AS MATERIALIZED (SELECT x.* FROM {routed} x JOIN {nodes} n ON n.node_id = x.leaf AND n.kind = 'active'
AND x.blk > n.born)""",
        f"""dist{s} AS MATERIALIZED (SELECT n.node_id AS leaf, {', '.join(
            f'any_value(n.d{k}) + count(CASE WHEN a.label = {k} THEN 1 END) AS d{k}' for k in range(3))},
count(a.label) AS addon FROM {nodes} n LEFT JOIN act{s} a ON a.leaf = n.node_id WHERE n.kind = 'active' GROUP BY n.node_id)""",
        f"""gst{s} AS MATERIALIZED (SELECT leaf, feature, label, CAST(count(*) AS DOUBLE) AS n, avg(value) AS mean,
CASE WHEN count(*) <= 1 THEN 0.0 ELSE var_samp(value) END AS var, min(value) AS min, max(value) AS max
FROM ({num}) GROUP BY leaf, feature, label)""",
        f"""nst{s} AS MATERIALIZED (SELECT leaf, feature, label, value, CAST(count(*) AS DOUBLE) AS w FROM ({nom})
GROUP BY leaf, feature, label, value)"""]


def _grow(b: int, split_all: bool, phi: Callable[[str], str], info_gain: Callable[[str, str], str]) -> list[str]:
    """From ``nodes{b}`` and block b to ``nodes{b + 1}``."""
    s = f"{b}"
    routed = f"rt{s}"
    left = f"""CASE WHEN p.point < g.min THEN 0.0 WHEN p.point >= g.max THEN g.n
ELSE g.n * CASE WHEN sqrt(g.var) > 0 THEN {phi('(p.point - g.mean) / sqrt(g.var)')} WHEN p.point < g.mean THEN 0.0 ELSE 1.0 END END"""
    gain = info_gain("leaf, feature, cand", f"post{s}")
    gain = re.sub(r"\b(ib|ic|pre|pa|merits)\b", rf"\g<1>{s}", gain).replace(" AS (SELECT", " AS MATERIALIZED (SELECT")
    targets = (f"SELECT DISTINCT leaf FROM {routed} WHERE blk = {b}" if split_all else
               f"SELECT leaf FROM {routed} WHERE blk = {b} ORDER BY pos DESC LIMIT 1")
    domain = " ".join(f"WHEN {i} THEN {n}" for i, (_, n) in _NOM.items())
    return [
        *_route(routed, f"(SELECT * FROM r WHERE blk <= {b})", f"nodes{s}", b), *_statistics(s, routed, f"nodes{s}"),
        f"""pts{s} AS MATERIALIZED (SELECT leaf, feature, point,
CAST(dense_rank() OVER (PARTITION BY leaf, feature ORDER BY point) - 1 AS INTEGER) AS cand
FROM (SELECT DISTINCT leaf, feature, lo, hi, (hi - lo) * i / 10.0 + lo AS point
      FROM (SELECT leaf, feature, min(min) AS lo, max(max) AS hi FROM gst{s} GROUP BY leaf, feature),
           (SELECT range AS i FROM range(1, 11))) WHERE point > lo AND point < hi)""",
        f"""gl{s} AS MATERIALIZED (SELECT g.leaf, g.feature, p.cand, p.point, g.label, g.n, {left} AS lw
FROM gst{s} g JOIN pts{s} p ON p.leaf = g.leaf AND p.feature = g.feature)""",
        f"""nb{s} AS MATERIALIZED (SELECT v.leaf, v.feature, v.value, c.label, c.tot, coalesce(x.w, 0.0) AS win
FROM (SELECT DISTINCT leaf, feature, value FROM nst{s}) v
JOIN (SELECT leaf, feature, label, sum(w) AS tot FROM nst{s} GROUP BY ALL) c ON c.leaf = v.leaf AND c.feature = v.feature
LEFT JOIN nst{s} x ON x.leaf = v.leaf AND x.feature = v.feature AND x.value = v.value AND x.label = c.label)""",
        f"""post{s} AS MATERIALIZED (
SELECT leaf, feature, cand, point AS cut, 0 AS branch, label, lw AS w FROM gl{s}
UNION ALL SELECT leaf, feature, cand, point, 1, label, n - lw FROM gl{s}
UNION ALL SELECT leaf, feature, CAST(value AS INTEGER), value, 0, label, win FROM nb{s}
UNION ALL SELECT leaf, feature, CAST(value AS INTEGER), value, 1, label, tot - win FROM nb{s}
UNION ALL SELECT leaf, feature, 1073741824, NULL, CAST(value AS INTEGER), label, w FROM nst{s})""",
        gain,
        f"""best{s} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY leaf, feature
ORDER BY round(merit, 12) DESC, cand) AS rn FROM merits{s}) WHERE rn = 1)""",
        f"""rank{s} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY round(merit, 12) DESC, ord DESC) AS rank
FROM (SELECT leaf, feature, cand, merit, feature AS ord FROM best{s}
      UNION ALL SELECT leaf, -1, NULL, '-inf'::DOUBLE, 1073741824 FROM dist{s}))""",
        f"""dec{s} AS MATERIALIZED (SELECT d.leaf, t.bf AS feature, t.bc AS cand FROM dist{s} d
JOIN (SELECT leaf, max(CASE WHEN rank = 1 THEN feature END) AS bf, max(CASE WHEN rank = 1 THEN cand END) AS bc,
             max(CASE WHEN rank = 1 THEN merit END) AS bm, max(CASE WHEN rank = 2 THEN merit END) AS sm, count(*) AS k
      FROM rank{s} WHERE rank <= 2 GROUP BY leaf) t ON t.leaf = d.leaf
WHERE d.leaf IN ({targets}) AND d.addon >= 200
  AND (CASE WHEN d0 > 0 THEN 1 ELSE 0 END + CASE WHEN d1 > 0 THEN 1 ELSE 0 END + CASE WHEN d2 > 0 THEN 1 ELSE 0 END) > 1
  AND (k < 2 OR sqrt(log2(3) * log2(3) * ln(1.0 / 1e-7) / (2.0 * (d0 + d1 + d2))) < 0.05
       OR coalesce(bm - sm > sqrt(log2(3) * log2(3) * ln(1.0 / 1e-7) / (2.0 * (d0 + d1 + d2))), false)))""",
        f"""cut{s} AS MATERIALIZED (SELECT d.leaf, d.feature, d.cand, any_value(p.cut) AS cut FROM dec{s} d
JOIN post{s} p ON p.leaf = d.leaf AND p.feature = d.feature AND p.cand = d.cand GROUP BY ALL)""",
        f"""kids{s} AS MATERIALIZED (SELECT c.leaf, c.br AS branch, {', '.join(
            f'coalesce(sum(CASE WHEN p.label = {k} THEN p.w END), 0.0) AS d{k}' for k in range(3))}
FROM (SELECT *, unnest(range(0, CASE WHEN cand = 1073741824 THEN CASE feature {domain} END ELSE 2 END)) AS br FROM cut{s}) c
LEFT JOIN post{s} p ON p.leaf = c.leaf AND p.feature = c.feature AND p.cand = c.cand AND p.branch = c.br GROUP BY c.leaf, c.br)""",
        f"""nodes{b + 1} AS MATERIALIZED (
SELECT n.node_id, n.parent_id, n.branch, n.depth, CASE WHEN c.leaf IS NOT NULL THEN 'split' WHEN e.leaf IS NOT NULL THEN 'inactive'
  ELSE n.kind END AS kind, coalesce(c.feature, n.feature) AS feature,
  CASE WHEN c.leaf IS NULL THEN n.test WHEN c.cand = 1073741824 THEN 'multiway' WHEN c.feature >= 4 THEN 'nominal' ELSE 'numeric' END AS test,
  coalesce(c.cut, n.value) AS value, n.born, {', '.join(
            f'CASE WHEN e.leaf IS NOT NULL THEN d.d{k} ELSE n.d{k} END AS d{k}' for k in range(3))}
FROM nodes{s} n LEFT JOIN dec{s} e ON e.leaf = n.node_id LEFT JOIN cut{s} c ON c.leaf = n.node_id LEFT JOIN dist{s} d ON d.leaf = n.node_id
UNION ALL
SELECT CAST((SELECT max(node_id) FROM nodes{s}) + row_number() OVER (ORDER BY k.leaf, k.branch) AS INTEGER), k.leaf,
  CAST(k.branch AS INTEGER), n.depth + 1, 'active', NULL, NULL, NULL, {b}, k.d0, k.d1, k.d2
FROM kids{s} k JOIN nodes{s} n ON n.node_id = k.leaf)"""]


def _best(d: str = "") -> str:
    """The first class with the largest weight."""
    return f"CASE WHEN {d}d0 >= {d}d1 AND {d}d0 >= {d}d2 THEN 0 WHEN {d}d1 >= {d}d2 THEN 1 ELSE 2 END"


def _scored(name: str, rows: str, s: str, tree: str) -> list[str]:
    """``name``: rows with ``mc`` and ``nbp`` (null without statistics) from ``dist/gst/nst{s}``; ``tree`` has all nodes' weights."""
    dens = """CASE WHEN g.n = 0 THEN 0.0 WHEN sqrt(g.var) > 0 THEN exp(-pow((x.v - g.mean) / sqrt(g.var), 2) / 2)
 / (sqrt(2 * pi()) * sqrt(g.var)) WHEN x.v = g.mean THEN 1.0 ELSE 0.0 END"""
    num = " UNION ALL ".join(f"SELECT pos, leaf, {i} AS feature, {c} AS v FROM {rows}" for i, c in enumerate(_NUM))
    nom = " UNION ALL ".join(f"SELECT pos, leaf, {i} AS feature, {c} AS v, {n}.0 AS size FROM {rows}" for i, (c, n) in _NOM.items())
    return [
        f"""{name}_p AS MATERIALIZED (SELECT x.pos, x.leaf, g.label, {dens} AS p FROM ({num}) x
JOIN gst{s} g ON g.leaf = x.leaf AND g.feature = x.feature
UNION ALL SELECT x.pos, x.leaf, t.label, (coalesce(w.w, 0.0) + 1.0) / (t.tot + x.size) FROM ({nom}) x
JOIN (SELECT leaf, feature, label, sum(w) AS tot FROM nst{s} GROUP BY ALL) t ON t.leaf = x.leaf AND t.feature = x.feature
LEFT JOIN nst{s} w ON w.leaf = x.leaf AND w.feature = x.feature AND w.label = t.label AND w.value = x.v)""",
        f"""{name}_v AS MATERIALIZED (SELECT p.pos, p.label, CASE WHEN bool_or(p.p <= 0) OR any_value(d.prior) <= 0 THEN '-inf'::DOUBLE
ELSE log10(any_value(d.prior)) + sum(CASE WHEN p.p > 0 THEN log10(p.p) ELSE 0.0 END) END AS lv FROM {name}_p p
JOIN (SELECT leaf, unnest([0, 1, 2]) AS label, unnest([d0, d1, d2]) / (d0 + d1 + d2) AS prior FROM dist{s}
      WHERE d0 + d1 + d2 > 0) d ON d.leaf = p.leaf AND d.label = p.label GROUP BY p.pos, p.label)""",
        f"""{name} AS MATERIALIZED (SELECT x.*, {_best('t.')} AS mc, v.label AS nbp FROM {rows} x
JOIN {tree} t ON t.node_id = x.leaf
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY lv DESC, label) AS k FROM {name}_v) WHERE k = 1) v
  ON v.pos = x.pos)"""]


def _weights(name: str, nodes: str, s: str) -> str:
    """All nodes with their present class weights."""
    return f"""{name} AS MATERIALIZED (SELECT n.* EXCLUDE (d0, d1, d2), {', '.join(
        f'CAST(coalesce(d.d{k}, n.d{k}) AS DOUBLE) AS d{k}' for k in range(3))}
FROM {nodes} n LEFT JOIN dist{s} d ON d.leaf = n.node_id)"""


def tree_sql(ex: str, phi: Callable[[str], str], info_gain: Callable[[str, str], str]) -> dict[str, str]:
    """The twins by query name."""
    start = """nodes0 AS MATERIALIZED (SELECT 0 AS node_id, NULL::INTEGER AS parent_id, NULL::INTEGER AS branch, 0 AS depth, 'active' AS kind,
NULL::INTEGER AS feature, NULL::VARCHAR AS test, NULL::DOUBLE AS value, -1 AS born, 0.0::DOUBLE AS d0, 0.0::DOUBLE AS d1, 0.0::DOUBLE AS d2)"""

    def trained(split_all: bool = False, track: bool = False) -> list[str]:
        ctes = [ex, f"""r AS MATERIALIZED (SELECT e.*, pos // {ROWS_PER_BLOCK} AS blk
FROM (SELECT *, row_number() OVER (ORDER BY {_KEY}) - 1 AS pos FROM ex) e)""", start]
        for b in range(BLOCKS):
            if track and b:
                # the block is scored by the tree and the statistics before it
                ctes += _route(f"ro{b}", f"(SELECT * FROM r WHERE blk < {b})", f"nodes{b}", b)
                ctes += _statistics(f"o{b}", f"ro{b}", f"nodes{b}")
                ctes += _route(f"rn{b}", f"(SELECT * FROM r WHERE blk = {b})", f"nodes{b}", b)
                ctes += [_weights(f"wo{b}", f"nodes{b}", f"o{b}"), *_scored(f"sc{b}", f"rn{b}", f"o{b}", f"wo{b}")]
            ctes += _grow(b, split_all, phi, info_gain)
        ctes += [*_route("rt", "r", f"nodes{BLOCKS}", BLOCKS), *_statistics("z", "rt", f"nodes{BLOCKS}"),
                 _weights("tree", f"nodes{BLOCKS}", "z")]
        return ctes

    def sql(ctes: list[str], last: str) -> str:
        return "WITH " + ",\n".join(ctes) + "\n" + last

    nodes = """SELECT node_id, parent_id, branch, depth, kind, feature, test, round(value, 6) AS value,
[round(d0, 6), round(d1, 6), round(d2, 6)] AS class_dist FROM tree"""
    base = trained()
    names = [*_NUM, *(c for c, _ in _NOM.values())]
    rules = f"""rule AS (SELECT node_id, depth, {_best()} AS class, parent_id AS up, branch AS br, [] ::VARCHAR[] AS conds, 0 AS step
 FROM tree WHERE kind <> 'split'
 UNION ALL SELECT q.node_id, q.depth, q.class, p.parent_id, p.branch, list_prepend([{', '.join(repr(n) for n in names)}][p.feature + 1] ||
   CASE WHEN p.test = 'numeric' AND q.br = 0 THEN ' < ' WHEN p.test = 'numeric' THEN ' >= '
        WHEN p.test = 'nominal' AND q.br <> 0 THEN ' != ' ELSE ' == ' END ||
   CASE WHEN p.test = 'multiway' THEN CAST(q.br AS VARCHAR) ELSE CAST(round(p.value, 6) AS VARCHAR) END, q.conds), q.step + 1
 FROM rule q JOIN tree p ON p.node_id = q.up)"""
    key = ", ".join(f"x.{c.strip()}" for c in _KEY.split(","))
    adaptive = trained(track=True) + [*_scored("fin", "rt", "z", "tree"), "hits AS (SELECT leaf, sum(m) AS m, sum(n) AS n FROM (" + " UNION ALL ".join(
        f"""SELECT leaf, CASE WHEN mc = label THEN 1 ELSE 0 END AS m, CASE WHEN coalesce(nbp, mc) = label THEN 1 ELSE 0 END AS n
FROM sc{b}""" for b in range(1, BLOCKS)) + ") GROUP BY leaf)"]
    # a stream of epochs of ROWS_PER_EPOCH commands: the queries of an epoch meet the tree and weights before it
    epochs = 4
    stream = [ex, f"""cmd AS MATERIALIZED (SELECT e.*, pos // {ROWS_PER_EPOCH} AS blk
FROM (SELECT *, row_number() OVER (ORDER BY {_KEY}) - 1 AS pos FROM ex) e)""",
              "r AS (SELECT * FROM cmd WHERE l_linestatus = 'F')", start]
    for e in range(epochs):
        stream += [*_route(f"ro{e}", f"(SELECT * FROM r WHERE blk < {e})", f"nodes{e}", e), *_statistics(f"o{e}", f"ro{e}", f"nodes{e}"),
                   _weights(f"wo{e}", f"nodes{e}", f"o{e}"),
                   *_route(f"q{e}", f"(SELECT * FROM cmd WHERE blk = {e} AND l_linestatus <> 'F')", f"nodes{e}", e)]
        if e < epochs - 1:
            stream += _grow(e, False, phi, info_gain)
    answers = " UNION ALL ".join(
        f"SELECT {key}, {_best('t.')} AS prediction FROM q{e} x JOIN wo{e} t ON t.node_id = x.leaf" for e in range(epochs))
    return {
        "ht_train": sql(base, nodes),
        "ht_attempt_split_all": sql(trained(split_all=True), nodes),
        "ht_stream": sql(stream, answers),
        "ht_route": sql(base, f"SELECT {_KEY}, leaf FROM rt"),
        "ht_block_stats": sql(base, f"""SELECT g.leaf, g.feature, g.label, g.n, round(g.mean, 6) AS mean,
 round(g.var * greatest(g.n - 1, 0), 3) AS m2, g.min, g.max FROM (SELECT x.leaf, f.feature, label, CAST(count(*) AS DOUBLE) AS n,
 avg(f.v) AS mean, CASE WHEN count(*) <= 1 THEN 0.0 ELSE var_samp(f.v) END AS var, min(f.v) AS min, max(f.v) AS max
 FROM (SELECT * FROM rt JOIN (SELECT node_id FROM tree WHERE kind = 'active') t ON t.node_id = rt.leaf) x,
 LATERAL (SELECT unnest([0, 1, 2, 3]) AS feature, unnest([{', '.join('x.' + c for c in _NUM)}]) AS v) f GROUP BY ALL) g"""),
        "ht_predict": sql(base, f"SELECT {key}, {_best('t.')} AS prediction FROM rt x JOIN tree t ON t.node_id = x.leaf"),
        "ht_predict_nb": sql(base + _scored("fin", "rt", "z", "tree"), f"SELECT {key}, coalesce(x.nbp, x.mc) AS prediction FROM fin x"),
        "ht_predict_adaptive": sql(adaptive, f"""SELECT {key}, CASE WHEN coalesce(h.m, 0) > coalesce(h.n, 0) THEN x.mc
 ELSE coalesce(x.nbp, x.mc) END AS prediction FROM fin x LEFT JOIN hits h ON h.leaf = x.leaf"""),
        "ht_rules": "WITH RECURSIVE " + ",\n".join([*base, rules]) + """
SELECT node_id, depth, CASE WHEN len(conds) = 0 THEN 'TRUE' ELSE array_to_string(conds, ' AND ') END AS rule, class
FROM rule WHERE step = depth""",
        "ht_shape": sql(base, """SELECT count(*) AS n_nodes, CAST(sum(CASE WHEN kind = 'split' THEN 1 ELSE 0 END) AS BIGINT) AS n_split,
CAST(sum(CASE WHEN kind <> 'split' THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
CAST(sum(CASE WHEN kind = 'active' THEN 1 ELSE 0 END) AS BIGINT) AS n_active, max(depth) AS height FROM tree"""),
        "ht_pure_leaves": sql(base, """SELECT node_id, (CASE WHEN d0 > 0 THEN 1 ELSE 0 END + CASE WHEN d1 > 0 THEN 1 ELSE 0 END
 + CASE WHEN d2 > 0 THEN 1 ELSE 0 END) <= 1 AS pure FROM tree WHERE kind <> 'split'"""),
        "ht_merge": sql([ex], " UNION ALL ".join(
            f"""SELECT {i} AS feature, label, CAST(count(*) AS DOUBLE) AS n, round(avg({c}), 6) AS mean,
 round(var_pop({c}) * count(*), 3) AS m2, min({c}) AS min, max({c}) AS max FROM ex GROUP BY label""" for i, c in enumerate(_NUM))),
        "ht_deactivate": sql([ex], """SELECT 0 AS node_id, 'inactive' AS kind, [CAST(count(CASE WHEN label = 0 THEN 1 END) AS DOUBLE),
 CAST(count(CASE WHEN label = 1 THEN 1 END) AS DOUBLE), CAST(count(CASE WHEN label = 2 THEN 1 END) AS DOUBLE)] AS class_dist
FROM ex WHERE l_linestatus = 'F'"""),
    }

"""Block-trained Hoeffding tree.

Layout of the work
------------------
* The tree itself (node list: tests, class distributions, leaf state) is a
  small driver-side structure, bounded by the number of nodes.
* Blocks are exact runs of ``rows_per_block`` rows by position in the order; the
  rows are written once with their block to the shared checkpoint folder.
* A leaf's fate depends on its own rows only, so jobs follow the depth that the tree gains, not
  the blocks.  A round takes all open leaves at once: one scan adds up power sums and counts per
  (leaf, feature, class) from one attempt at the leaf to the next (per block if all leaves are tried, ``split_all``), in numpy
  per task and then by a grouped aggregate; a running merge (G2/G5 as sums) gives every leaf's statistics at every attempt;
  all split tests run in one plan; the first block at which a leaf fires is kept.  The children are the next round's leaves and
  see only later blocks.  Blocks are taken in runs that double in length, so what is computed
  beyond a leaf's split stays in proportion; between runs the statistics are the model's.
* ``fit_blocks`` trains block by block instead: for ``remove_poor``, where an attempt that fails
  changes the statistics, and for tests.
* Split attempts run the G7-G16 operators on the (small) leaf statistics;
  only the first decision per leaf and the chosen split's branch distributions reach the driver.

Block semantics (corrected per-example quirk): a block is aggregated,
merged once, then split attempts run.  Options follow the reference's
option defaults except where noted: grace 200, tie 0.05, delta 1e-7,
info gain, pre-pruning on, growth on.

Nulls: rows without a label do not train; a null feature value adds nothing to
the statistics and is routed to the last branch of a binary test.
"""

from __future__ import annotations

import json
import math
from collections import namedtuple
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions import stats as S
from driftwood.operators import observers, splits
from driftwood.operators.examples import to_long
from driftwood.plans import scan
from driftwood.session import scratch_path, written

MULTIWAY_CAND = 1 << 30
#: Blocks in one window of the running merge; beyond it the merge has two levels.
SEGMENT = 4096
#: Rows of leaf statistics whose split tests run in one task, without shuffles; more are dealt by leaf and block.
ONE_TASK_STATISTICS = 10_000
#: Rows that a task adds up at once, and rows of the runs of blocks whose rows are scored together.
ROWS_AT_ONCE, ROWS_SCORED = 500_000, 200_000
#: Statistics by leaf and block as power sums.
SUMS = "leaf int, _block long, feature int, label int, value double, w double, s1 double, s2 double, mn double, mx double"


@dataclass
class Node:
    id: int
    parent: int | None
    branch: int | None
    depth: int
    kind: str  # "split" | "active" | "inactive"
    dist: list
    feature: int | None = None
    test: str | None = None  # "numeric" | "nominal" | "multiway"
    value: float | None = None
    n_branches: int = 0
    children: dict = field(default_factory=dict)
    addon: float = 0.0
    mc_correct: float = 0.0
    nb_correct: float = 0.0


def _mn(a, b):
    return b if a is None else (a if b is None else min(a, b))


def _mx(a, b):
    return b if a is None else (a if b is None else max(a, b))


_Sum = namedtuple("_Sum", "leaf feature label vkey w s1 s2 mn mx gid", defaults=[0])


def _sums_table(columns: Sequence[Sequence]) -> pa.Table:
    """Columns of ``SUMS`` as an Arrow table."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [c.split() for c in SUMS.split(", ")]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def _argmax(xs) -> int:
    best, bi = None, 0
    for i, v in enumerate(xs):
        if best is None or v > best:
            best, bi = v, i
    return bi


class HoeffdingTree:
    """Hoeffding tree over wide examples (feature columns + integer label).

    ``nominal`` maps feature index -> number of declared values (the column
    holds the 0-based code); every other feature is numeric.
    """

    def __init__(self, feature_cols: Sequence[str], num_classes: int, label: str = "label",
                 weight: str | None = None, nominal: dict | None = None, grace: float = 200.0,
                 tie_threshold: float = 0.05, delta: float = 1e-7, criterion: str | splits.Criterion = "info_gain",
                 binary_only: bool = False, split_all: bool = False, leaf_type: str = "majority",
                 nb_threshold: float = 0.0, pre_prune: bool = True, bins: int = 10,
                 grow: bool = True, remove_poor: bool = False):
        if not isinstance(criterion, splits.Criterion) and criterion not in splits.CRITERIA:
            raise ValueError(f"unknown split criterion {criterion!r}: info_gain, gini or a splits.Criterion")
        self.feature_cols = list(feature_cols)
        self.num_classes = int(num_classes)
        self.label = label
        self.weight = weight
        self.nominal = dict(nominal or {})
        self.grace, self.tie, self.delta = float(grace), float(tie_threshold), float(delta)
        self.criterion = criterion if isinstance(criterion, splits.Criterion) else splits.CRITERIA[criterion]
        self.binary_only, self.split_all = binary_only, split_all
        self.leaf_type, self.nb_threshold = leaf_type, float(nb_threshold)
        self.pre_prune, self.bins, self.grow = pre_prune, int(bins), grow
        #: Features that a leaf has given up, by leaf
        self.remove_poor, self.poor = remove_poor, {}
        self.nodes: dict[int, Node] = {0: Node(0, None, None, 0, "active", [0.0] * self.num_classes)}
        self.next_id = 1
        self.max_when_nodes = 60  # above this, route by node arrays
        # leaf statistics, bounded by leaves x features x classes (x values):
        # {(leaf, feature, label): [n, mean, m2, min, max]} and
        # {(leaf, feature, label, value): w}
        self.g: dict = {}
        self.n: dict = {}
        self.blocks_seen = 0
        #: numeric feature -> a value near its mean, subtracted before squaring
        self.offset: dict = {}

    # ------------------------------------------------------------------ H1 routing
    def _node_expr(self, node: Node, fn, since: dict | None = None) -> Column:
        if node.kind != "split":
            return fn(node)
        if since and node.id in since:
            later = {i: b for i, b in since.items() if i != node.id}
            return F.when(F.col("_block") > since[node.id], self._node_expr(node, fn, later)).otherwise(fn(node))
        x = F.col(self.feature_cols[node.feature])

        def child(b):
            cid = node.children.get(b)
            return self._node_expr(self.nodes[cid], fn, since) if cid is not None else fn(node)

        if node.test == "multiway":
            expr = None
            for b in sorted(node.children):
                cond = x.cast("int") == F.lit(b)
                expr = F.when(cond, child(b)) if expr is None else expr.when(cond, child(b))
            return expr.otherwise(fn(node)) if expr is not None else fn(node)
        cond = (x < F.lit(node.value)) if node.test == "numeric" else (x == F.lit(node.value))
        return F.when(cond, child(0)).otherwise(child(1))

    def route_values(self, values: Sequence) -> int:
        """H1 on the driver for one example (same tests as the Column form)."""
        node = self.nodes[0]
        while node.kind == "split":
            v = values[node.feature]
            if node.test == "multiway":
                b = int(v) if v is not None else -1
            elif node.test == "numeric":
                b = 0 if (v is not None and v < node.value) else 1
            else:
                b = 0 if (v is not None and v == node.value) else 1
            cid = node.children.get(b)
            if cid is None:
                break
            node = self.nodes[cid]
        return node.id

    def route(self, since: dict | None = None) -> Column:
        """H1: leaf id of each row (a split node id when its child is missing).

        ``since``: nodes that split after a block; a row (column ``_block``) of that block or an earlier one stays there."""
        return self._node_expr(self.nodes[0], lambda n: F.lit(n.id), since).cast("int")

    def _descent(self, since: dict | None = None):
        """H1 as a function of numpy arrays (features by row, blocks of the rows if ``since``): all rows descend one level at a time.
        The node table (bounded by the model size) travels with it."""
        size = self.next_id
        after = np.full(size, -1)
        for i, b in (since or {}).items():
            after[i] = b
        feature, test, value = np.full(size, -1), np.zeros(size, "int8"), np.zeros(size)
        width = max([2, *(b + 1 for n in self.nodes.values() for b in n.children)])
        kids = np.repeat(np.arange(size)[:, None], width, 1)  # a missing child: the row stays
        for n in self.nodes.values():
            if n.kind == "split":
                feature[n.id], value[n.id] = n.feature, n.value if n.value is not None else 0.0
                test[n.id] = ("numeric", "nominal", "multiway").index(n.test)
                for b, c in n.children.items():
                    kids[n.id, b] = c
        height = max(n.depth for n in self.nodes.values())
        timed = bool(since)

        def node_of(values: np.ndarray, block: np.ndarray | None = None) -> np.ndarray:
            at, rows = np.zeros(len(values), "int64"), np.arange(len(values))
            for _ in range(height):
                rows = rows[feature[at[rows]] >= 0]
                if timed:
                    rows = rows[block[rows] > after[at[rows]]]
                here = at[rows]
                v, kind = values[rows, feature[here]], test[here]
                branch = np.where(kind == 0, ~(v < value[here]), v != value[here]).astype("int64")
                many = kind == 2
                if many.any():
                    code = np.trunc(np.where(many & np.isfinite(v), v, -1.0)).clip(-1, width).astype("int64")
                    inside = ~many | ((code >= 0) & (code < width))
                    branch = np.where(many, np.where(inside, code, 0), branch)
                    new = np.where(inside, kids[here, branch], here)
                else:
                    new = kids[here, branch]
                at[rows] = new
                rows = rows[new != here]
            return at

        return node_of

    def route_arrays(self, since: dict | None = None) -> Column:
        """H1 for large trees: ``_descent`` over the rows of a batch; the plan does not grow with the tree.  ``since`` as for ``route``."""
        node_of = self._descent(since)

        @F.pandas_udf("int")
        def leaf_of(x: pd.DataFrame) -> pd.Series:
            block = x.pop("block").to_numpy() if since else None
            return pd.Series(node_of(x.to_numpy("float64", na_value=np.nan), block).astype("int32"))

        block = [F.col("_block").cast("long").alias("block")] if since else []
        return leaf_of(F.struct(*block, *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.feature_cols)]))

    def route_join(self, df: DataFrame, name: str = "leaf", since: dict | None = None) -> DataFrame:
        """H1 for large trees: every row meets the node table, level by level (see ``route_arrays``)."""
        return df.withColumn(name, self.route_arrays(since))

    def with_leaf(self, df: DataFrame, name: str = "leaf", since: dict | None = None) -> DataFrame:
        """Append the leaf id: one ``when`` Column for small trees, node arrays
        above ``max_when_nodes`` nodes."""
        if len(self.nodes) > self.max_when_nodes:
            return self.route_join(df, name, since)
        return df.withColumn(name, self.route(since))

    def majority_of(self, leaf: Column) -> Column:
        """Majority class of a node id (a literal map bounded by the node count)."""
        best = [_argmax(self.nodes[i].dist) if i in self.nodes else None for i in range(self.next_id)]
        return F.get(F.from_json(F.lit(json.dumps(best)), "array<int>"), leaf)

    def majority_column(self) -> Column:
        """H9: majority class of the reached node, compiled into the same tree."""
        return self._node_expr(self.nodes[0], lambda n: F.lit(_argmax(n.dist))).cast("int")

    # ------------------------------------------------------------------ helpers
    def _w(self) -> Column:
        return F.lit(1.0) if self.weight is None else F.col(self.weight).cast("double")

    def leaves(self) -> list[Node]:
        return [n for n in self.nodes.values() if n.kind != "split"]

    def _active_ids(self) -> list[int]:
        return [n.id for n in self.nodes.values() if n.kind == "active"]

    def _num_idx(self) -> list[int]:
        return [i for i in range(len(self.feature_cols)) if i not in self.nominal]

    # ------------------------------------------------------------------ H2 block stats
    def block_stats(self, block: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """H2: (class dist, Gaussian stats, nominal stats) of the active leaves."""
        routed = self.with_leaf(block.select(F.col(self.label).cast("int").alias("label"),
                                             self._w().alias("weight"), *self.feature_cols))
        routed = routed.filter(F.col("leaf").isin(self._active_ids()) & F.col("label").isNotNull())
        cd = routed.groupBy("leaf", "label").agg(F.sum("weight").alias("w"))
        long = to_long(routed, ["leaf"], self.feature_cols, label="label", weight="weight")
        g = observers.gaussian_stats(long.filter(F.col("feature").isin(self._num_idx())),
                                     ["leaf", "feature", "label"])
        nom_idx = list(self.nominal)
        nstat = observers.nominal_stats(long.filter(F.col("feature").isin(nom_idx)),
                                        ["leaf", "feature", "label"]) if nom_idx else None
        return cd, g, nstat

    def _entries(self) -> Column:
        """A row's entries (feature, x, vkey, raw): feature -1 for the class, then one per feature."""
        items = [F.struct(F.lit(-1).alias("feature"), F.lit(None).cast("double").alias("x"),
                          F.lit(None).cast("double").alias("vkey"), F.lit(None).cast("double").alias("raw"))]
        for i, c in enumerate(self.feature_cols):
            v = F.col(c).cast("double")
            if i in self.nominal:
                items.append(F.struct(F.lit(i).alias("feature"), F.lit(None).cast("double").alias("x"),
                                      v.alias("vkey"), F.lit(None).cast("double").alias("raw")))
            else:
                items.append(F.struct(F.lit(i).alias("feature"), (v - F.lit(self.offset.get(i, 0.0))).alias("x"),
                                      F.lit(None).cast("double").alias("vkey"), v.alias("raw")))
        return F.array(*items)

    def block_summary(self, block: DataFrame, order_cols: Sequence[str] | None = None,
                      with_last: bool = True):
        """H2 in one job: every leaf statistic of the block plus the leaf of the
        block's last example, as one grouped aggregate with two grouping sets
        ``(leaf, feature, label, vkey)`` and ``()``.  Rows: feature -1 = class
        distribution, numeric features = Gaussian power sums, nominal features
        = counts per value (``vkey``)."""
        okey = (F.struct(*[F.col(c) for c in order_cols]) if order_cols else F.lit(0))
        routed = self.with_leaf(block.select(F.col(self.label).cast("int").alias("label"),
                                             self._w().alias("weight"), okey.alias("_o"),
                                             *self.feature_cols))
        long = routed.select("leaf", "label", "weight", "_o", F.inline(self._entries()))
        # a row without label counts for the last example only, a null value for nothing
        known = F.col("label").isNotNull() & ((F.col("feature") == -1) | F.col("x").isNotNull() | F.col("vkey").isNotNull())
        if with_last:
            long = long.withColumn("weight", F.when(known, F.col("weight")))
        else:
            long = long.where(known)
        ok = (F.col("x").isNotNull() & ~F.isnan("x") & (F.abs(F.col("x")) != F.lit(float("inf")))
              & (F.col("weight") > 0))
        finite = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs(F.col("x")) != F.lit(float("inf")))
        keys = ["leaf", "feature", "label", "vkey"]
        if not with_last:  # plain hash aggregate
            agg = long.groupBy(*keys).agg(
                F.sum(F.when(F.col("x").isNull(), F.col("weight")).otherwise(
                    F.when(ok, F.col("weight")))).alias("w"),
                F.sum(F.when(ok, F.col("weight") * F.col("x"))).alias("s1"),
                F.sum(F.when(ok, F.col("weight") * F.col("x") * F.col("x"))).alias("s2"),
                F.min(F.when(finite, F.col("raw"))).alias("mn"),
                F.max(F.when(finite, F.col("raw"))).alias("mx"),
                F.lit(None).cast("int").alias("last_leaf"), F.lit(0).alias("gid"))
            return agg.collect()  # leaves x features x classes (x values) rows
        agg = long.groupingSets([keys, []], *keys).agg(
            F.sum(F.when(F.col("x").isNull(), F.col("weight")).otherwise(
                F.when(ok, F.col("weight")))).alias("w"),
            F.sum(F.when(ok, F.col("weight") * F.col("x"))).alias("s1"),
            F.sum(F.when(ok, F.col("weight") * F.col("x") * F.col("x"))).alias("s2"),
            F.min(F.when(finite, F.col("raw"))).alias("mn"),
            F.max(F.when(finite, F.col("raw"))).alias("mx"),
            F.max_by("leaf", "_o").alias("last_leaf"),
            F.grouping_id().alias("gid"))
        return agg.collect()  # leaves x features x classes (x values) + 1 rows

    def _split_summary(self, rows):
        from types import SimpleNamespace as NS

        cd, g, n, last = [], [], [], None
        for r in rows:
            if r.gid != 0:
                last = r.last_leaf
            elif r.label is None or (r.feature in self.nominal and r.vkey is None):
                continue
            elif r.feature == -1:
                cd.append(NS(leaf=r.leaf, label=r.label, w=r.w or 0.0))
            elif r.feature in self.nominal:
                n.append(NS(leaf=r.leaf, feature=r.feature, label=r.label, value=r.vkey, w=r.w or 0.0))
            else:
                w = r.w or 0.0
                mean = (r.s1 / w) if w > 0 else 0.0
                m2 = max(0.0, r.s2 - r.s1 * r.s1 / w) if w > 0 else 0.0
                at = self.offset.get(r.feature, 0.0)
                g.append(NS(leaf=r.leaf, feature=r.feature, label=r.label, n=w, mean=mean + at, m2=m2,
                            min=r.mn, max=r.mx))
        return cd, g, n, last

    # ------------------------------------------------------------------ H3 merge
    def merge_block(self, cd_rows, g_rows, n_rows) -> list[int]:
        """H3: add block statistics (G2/G5 combination); inactive leaves ignore
        them.  Returns the leaves that received weight."""
        touched = set()
        for r in cd_rows:
            node = self.nodes.get(r.leaf)
            if node is None or node.kind != "active":
                continue
            node.dist[r.label] += r.w
            node.addon += r.w
            touched.add(r.leaf)
        for r in g_rows:
            node = self.nodes.get(r.leaf)
            if node is None or node.kind != "active" or r.feature in self.poor.get(r.leaf, ()):
                continue
            key = (r.leaf, r.feature, r.label)
            old = self.g.get(key)
            new = [r.n, r.mean, r.m2, r.min, r.max]
            if old is None or old[0] == 0:
                self.g[key] = new if old is None else [new[0], new[1], new[2],
                                                       _mn(old[3], new[3]), _mx(old[4], new[4])]
            else:
                n = old[0] + new[0]
                mean = (old[0] * old[1] + new[0] * new[1]) / n if n > 0 else 0.0
                m2 = old[2] + new[2] + (old[1] - new[1]) ** 2 * old[0] * new[0] / n if n > 0 else 0.0
                self.g[key] = [n, mean, m2, _mn(old[3], new[3]), _mx(old[4], new[4])]
        for r in n_rows:
            node = self.nodes.get(r.leaf)
            if node is None or node.kind != "active" or r.feature in self.poor.get(r.leaf, ()):
                continue
            key = (r.leaf, r.feature, r.label, float(r.value))
            self.n[key] = self.n.get(key, 0.0) + r.w
        return sorted(touched)

    def stats_frames(self, spark, leaves: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame | None]:
        """Statistics of the leaves (or of some) as (small) DataFrames for the Spark-side operators."""
        own = None if leaves is None else set(leaves)
        g = spark.createDataFrame(
            [(k[0], k[1], k[2], *[float(x) if x is not None else None for x in v])
             for k, v in self.g.items() if own is None or k[0] in own],
            "leaf int, feature int, label int, n double, mean double, m2 double, min double, max double")
        n = None
        if self.nominal:
            n = spark.createDataFrame([(k[0], k[1], k[2], k[3], float(v)) for k, v in self.n.items()
                                       if own is None or k[0] in own],
                                      "leaf int, feature int, label int, value double, w double")
        return g, n

    # ------------------------------------------------------------------ H4-H6 split attempts
    def _candidate_posts(self, g: DataFrame, ns: DataFrame | None, at: Sequence[str] = ("leaf",)) -> DataFrame:
        """Class weights by branch of all candidates, per ``at`` (a leaf, or a leaf at a block)."""
        at = list(at)
        keys = [*at, "feature"]
        pts = observers.split_points(g, self.bins, keys)
        post = observers.gaussian_split_weights(g, pts, keys).select(
            *keys, F.col("point_idx").alias("cand"), F.col("point").alias("cut"), "branch", "label", "w")
        if ns is not None:
            nb = observers.nominal_binary_splits(ns, keys).select(
                *keys, F.col("split_value").cast("int").alias("cand"),
                F.col("split_value").alias("cut"), "branch", "label", "w")
            post = post.unionByName(nb)
            if not self.binary_only:
                mw = observers.nominal_multiway_split(ns, keys).select(
                    *keys, F.lit(MULTIWAY_CAND).alias("cand"),
                    F.lit(None).cast("double").alias("cut"), "branch", "label", "w")
                post = post.unionByName(mw)
        return post

    def _merits(self, post: DataFrame, at: Sequence[str] = ("leaf",)) -> DataFrame:
        return self.criterion.merit(post, [*at, "feature", "cand"])

    def _no_split(self, dist: DataFrame, at: Sequence[str]) -> DataFrame:
        """Merit of "do not split": all of ``dist`` (at..., label, w) in one branch."""
        return self.criterion.merit(dist.select(*at, F.lit(0).alias("branch"), "label", "w"), list(at))

    def attempt_split(self, leaf_ids: list[int]) -> dict:
        """H4/H5/H6 for the given leaves.  Returns {leaf: action}."""
        cands = []
        for lid in leaf_ids:
            n = self.nodes.get(lid)
            if n is None or n.kind != "active" or not self.grow:
                continue
            if n.addon < self.grace:
                continue
            if sum(1 for v in n.dist if v > 0) <= 1:  # H15 pure
                continue
            cands.append(lid)
        if not cands:
            return {}
        gstats, nstats = self.stats_frames(self._spark, cands)

        def placed(df: DataFrame) -> DataFrame:
            # statistics of a few leaves: one task runs all tests, nothing is shuffled
            return df.coalesce(1) if len(self.g) + len(self.n) <= ONE_TASK_STATISTICS or len(cands) == 1 else df

        post = written(self._candidate_posts(placed(gstats), placed(nstats) if nstats is not None else None), "ht-candidates")
        best = splits.best_split_per_feature(self._merits(placed(post)), ["leaf", "feature"], ["cand"])
        spark = post.sparkSession
        no_split = None
        if self.pre_prune:
            rows = [(lid, c, float(w)) for lid in cands for c, w in enumerate(self.nodes[lid].dist)]
            no_split = self._no_split(placed(spark.createDataFrame(rows, "leaf int, label int, w double")), ["leaf"])
        # the two tables are one partition each: so is their union then
        ranked = splits.rank_split_suggestions(best, ["leaf"], no_split, keep=["cand"])
        # two rows per candidate leaf, or one per feature if poor features go
        top = (ranked if self.remove_poor else ranked.filter(F.col("rank") <= 2)).collect()
        by_leaf: dict[int, list] = {}
        for r in top:
            by_leaf.setdefault(r.leaf, []).append(r)
        actions, chosen = {}, []
        r_merit = self.criterion.value_range(self.num_classes)
        for lid in cands:
            sug = sorted(by_leaf.get(lid, []), key=lambda r: r["rank"])
            if not sug:
                continue
            n_w = sum(self.nodes[lid].dist)
            bound = math.sqrt(r_merit * r_merit * math.log(1.0 / self.delta) / (2.0 * n_w))
            if len(sug) < 2:
                do = True
            else:
                gap = sug[0].merit - sug[1].merit
                do = bound < self.tie or (not math.isnan(gap) and gap > bound)
            if not do:
                if self.remove_poor:
                    self._give_up(lid, {r.feature for r in sug if r.feature >= 0 and sug[0].merit - r.merit > bound})
                continue
            if sug[0].feature < 0:
                self.nodes[lid].kind = "inactive"  # H6
                actions[lid] = "deactivate"
            else:
                chosen.append((lid, sug[0].feature, sug[0].cand))
        if chosen:
            cond = None
            for lid, f, c in chosen:
                one = (F.col("leaf") == lid) & (F.col("feature") == f) & (F.col("cand") == c)
                cond = one if cond is None else (cond | one)
            rows = post.filter(cond).collect()  # branches x classes per split leaf
            for lid, f, c in chosen:
                mine = [r for r in rows if r.leaf == lid and r.feature == f and r.cand == c]
                self._split(lid, f, c, mine)
                actions[lid] = "split"
        return actions

    def _give_up(self, lid: int, features: set) -> None:
        """G19 in training: the leaf stops observing these features."""
        self.poor[lid] = self.poor.get(lid, set()) | features
        self.g = {k: v for k, v in self.g.items() if k[0] != lid or k[1] not in features}
        self.n = {k: v for k, v in self.n.items() if k[0] != lid or k[1] not in features}

    def _make_split(self, lid: int, feature: int, cand, cut, post: list) -> None:
        node = self.nodes[lid]
        if feature in self.nominal and cand == MULTIWAY_CAND:
            test, value, nb = "multiway", None, self.nominal[feature]
        else:
            test, value, nb = ("nominal" if feature in self.nominal else "numeric"), float(cut), 2
        node.kind, node.feature, node.test, node.value, node.n_branches = "split", feature, test, value, nb
        for b in range(nb):
            cid = self.next_id
            self.next_id += 1
            dist = [float(x) for x in post[b]] if b < len(post) else [0.0] * self.num_classes
            self.nodes[cid] = Node(cid, lid, b, node.depth + 1, "active", dist)
            node.children[b] = cid
        self.g = {k: v for k, v in self.g.items() if k[0] != lid}
        self.n = {k: v for k, v in self.n.items() if k[0] != lid}

    def _split(self, lid: int, feature: int, cand: int, post_rows) -> None:
        nb = self.nominal[feature] if (feature in self.nominal and cand == MULTIWAY_CAND) else 2
        post = [[0.0] * self.num_classes for _ in range(nb)]
        for r in post_rows:
            if r.branch < nb:
                post[r.branch][r.label] += float(r.w)
        self._make_split(lid, feature, cand, post_rows[0].cut if post_rows else None, post)

    # ------------------------------------------------------------------ H11 adaptive tracking
    def _track_correct(self, block: DataFrame, id_cols: Sequence[str]) -> None:
        if not self.g:
            return
        scored = self._predict_both(block, id_cols)
        agg = (scored.groupBy("leaf").agg(
            F.sum(F.when(F.col("mc") == F.col("label"), F.col("weight")).otherwise(0.0)).alias("mc"),
            F.sum(F.when(F.col("nbp") == F.col("label"), F.col("weight")).otherwise(0.0)).alias("nb"))
            .collect())  # one row per leaf
        for r in agg:
            node = self.nodes.get(r.leaf)
            if node is not None and node.kind == "active":
                node.mc_correct += r.mc
                node.nb_correct += r.nb

    # ------------------------------------------------------------------ H8 training
    def train_block(self, block: DataFrame, order_cols: Sequence[str] | None = None,
                    id_cols: Sequence[str] | None = None, last_example: Sequence | None = None) -> dict:
        """One block: (adaptive tracking), stats, merge, split attempts.

        ``last_example`` (feature values of the block's last example, known
        when the blocks were written) lets the driver route it, so the block
        job is a plain hash aggregate."""
        if self.leaf_type == "adaptive" and id_cols:
            self._track_correct(block, id_cols)
        self._spark = block.sparkSession
        if last_example is not None:
            last_leaf = self.route_values(last_example)  # routed before this block's splits
            cd, g, nrows, _ = self._split_summary(self.block_summary(block, order_cols, False))
            last = last_leaf
        else:
            cd, g, nrows, last = self._split_summary(self.block_summary(block, order_cols))
        touched = self.merge_block(cd, g, nrows)
        if self.split_all or not order_cols:
            targets = touched
        else:  # H5: only the leaf of the block's last example
            targets = [last] if last is not None else []
        self.blocks_seen += 1
        return self.attempt_split(targets)

    def _stage(self, df: DataFrame, order_cols: Sequence[str], rows_per_block: int, id_cols: Sequence[str] | None) -> tuple[DataFrame, int]:
        """The training rows with ``_block`` and ``_last`` (the block's last example), written once; the number of blocks."""
        cols = list(dict.fromkeys([*order_cols, *(id_cols or []), *self.feature_cols, self.label]
                                  + ([self.weight] if self.weight else [])))
        placed = written(scan.row_position(df.select(*cols), list(order_cols), name="_pos").drop(scan.BUCKET), "ht-rows")
        means = [F.avg(F.when(S.finite(F.col(self.feature_cols[i])), F.col(self.feature_cols[i]).cast("double"))).alias(str(i))
                 for i in self._num_idx()]
        row = placed.agg(F.count("*").alias("rows"), *means).first()
        self.offset = {i: float(row[str(i)] or 0.0) for i in self._num_idx()}
        last = ((F.col("_pos") + 1) % rows_per_block == 0) | (F.col("_pos") == F.lit(row["rows"] - 1))
        return placed.select(*cols, "_pos", F.floor(F.col("_pos") / rows_per_block).cast("long").alias("_block"), last.alias("_last")), \
            -(-row["rows"] // rows_per_block)

    def fit(self, df: DataFrame, order_cols: Sequence[str], rows_per_block: int = 5000,
            id_cols: Sequence[str] | None = None, first_run: int = 64) -> HoeffdingTree:
        """H8: train over blocks of ``rows_per_block`` consecutive rows (in order), in runs of ``first_run`` blocks, then twice as many ..."""
        if self.remove_poor:
            return self.fit_blocks(df, order_cols, rows_per_block, id_cols)
        self._spark = df.sparkSession
        rows, n = self._stage(df, order_cols, rows_per_block, id_cols)
        low, size = 0, first_run
        while low < n:
            high = min(n, low + size)
            # by position, which the files are in order of: the others' row groups are not read
            self._grow_run(rows.where((F.col("_pos") >= low * rows_per_block) & (F.col("_pos") < high * rows_per_block)), low, high, rows_per_block)
            low, size = high, 2 * size
        self.blocks_seen += n
        return self

    def _by_leaf(self, values: dict) -> Column:
        """A value per node id as a function of the column ``leaf`` (a literal bounded by the node count)."""
        kind = "bigint" if all(isinstance(v, int) for v in values.values()) else "double"
        return F.get(F.from_json(F.lit(json.dumps([values.get(i) for i in range(self.next_id)])), f"array<{kind}>"), F.col("leaf"))

    def _state_sums(self, leaves: Sequence[int], block: int) -> pa.Table:
        """The leaves' statistics so far as power sums at ``block``."""
        rows, leaves = [], set(leaves)
        for leaf in sorted(leaves):
            rows += [(leaf, block, -1, c, 0.0, float(w), None, None, None, None) for c, w in enumerate(self.nodes[leaf].dist) if w]
        for (leaf, f, c), (n, mean, m2, mn, mx) in self.g.items():
            if leaf in leaves:
                d = mean - self.offset.get(f, 0.0)
                rows.append((leaf, block, f, c, 0.0, float(n), float(n * d), float(m2 + n * d * d), mn, mx))
        rows += [(leaf, block, f, c, float(v), float(w), None, None, None, None) for (leaf, f, c, v), w in self.n.items() if leaf in leaves]
        return _sums_table(list(zip(*rows)) or [()] * len(SUMS.split(",")))

    def _plain_rows(self, rows: DataFrame) -> DataFrame:
        """The labelled rows as ``label``, ``weight``, ``_o`` (the block) and the features ``f0``, ``f1``, ... as doubles."""
        return rows.where(F.col(self.label).isNotNull()).select(
            F.col(self.label).cast("long").alias("label"), self._w().alias("weight"), F.col("_block").cast("long").alias("_o"),
            *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.feature_cols)])

    def _block_sums(self, rows: DataFrame, spans: dict) -> DataFrame:
        """H2 for the leaves of ``spans`` from their first block on.

        ``spans``: by leaf its first block, and then (for all leaves or none) blocks up to each of which what came since the one before
        is one sum; else every block is a sum of its own."""
        node_of, offset, nominal = self._descent(), [self.offset.get(i, 0.0) for i in range(len(self.feature_cols))], set(self.nominal)
        first, ends, width = np.full(self.next_id, np.iinfo("int64").max), None, 0
        for leaf, span in spans.items():
            first[leaf] = span[0]
        if all(len(span) > 1 for span in spans.values()):
            width = max(max(span) for span in spans.values()) + 1
            ends = np.sort(np.concatenate([leaf * width + np.asarray(span[1:], "int64") for leaf, span in spans.items()]))
        names = [n.split()[0] for n in SUMS.split(", ")]

        def add_up(t: pa.Table):
            x = [t.column(f"f{i}") for i in range(len(offset))]
            known, x = [np.asarray(v.is_valid()) for v in x], [v.to_numpy() for v in x]
            block = t.column("_o").to_numpy()
            leaf = node_of(np.column_stack(x))
            kept = np.flatnonzero(block >= first[leaf])
            if not len(kept):
                return
            leaf, at, label = leaf[kept], block[kept], t.column("label").to_numpy()[kept]
            wide = width or int(at.max()) + 1
            if ends is not None:
                at = ends[np.searchsorted(ends, leaf * wide + at)] % wide
            low = int(label.min())
            classes = int(label.max()) - low + 1
            key = (leaf * wide + at) * classes + (label - low)
            order = np.argsort(key, kind="stable")
            key, kept = key[order], kept[order]
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            group = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(key))))
            own = key[cut]
            weight = t.column("weight").to_numpy()[kept]
            some = np.asarray(t.column("weight").is_valid())[kept]
            weight, above = np.where(some, weight, 0.0), some & (weight > 0)

            def batch(feature, which, value, w, s1=None, s2=None, mn=None, mx=None):
                n, o = len(which), own[which]
                none = pa.nulls(n, pa.float64())
                columns = [o // classes // wide, o // classes % wide, np.full(n, feature), o % classes + low]
                columns = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
                numbers = [none if c is None else pa.array(c, mask=~np.isfinite(c) if c is mn or c is mx else None) for c in (value, w, s1, s2, mn, mx)]
                return pa.RecordBatch.from_arrays([*columns, *numbers], names)

            everyone = np.arange(len(cut))
            yield batch(-1, everyone, np.zeros(len(cut)), np.add.reduceat(weight, cut))
            for f, v in enumerate(x):
                v, there = v[kept], known[f][kept]
                if f in nominal:
                    some = np.flatnonzero(there)
                    values, code = np.unique(v[some] + 0.0, return_inverse=True)
                    found, place = np.unique(group[some] * max(1, len(values)) + code, return_inverse=True)
                    if len(found):
                        yield batch(f, found // len(values), values[found % len(values)], np.bincount(place, weight[some], len(found)))
                    continue
                which = np.flatnonzero(np.logical_or.reduceat(there, cut))
                finite = np.isfinite(v)
                ok = finite & above
                w, d = np.where(ok, weight, 0.0), np.where(ok, v - offset[f], 0.0)
                yield batch(f, which, np.zeros(len(which)), *[a[which] for a in (
                    np.add.reduceat(w, cut), np.add.reduceat(w * d, cut), np.add.reduceat(w * d * d, cut),
                    np.minimum.reduceat(np.where(finite, v, np.inf), cut), np.maximum.reduceat(np.where(finite, v, -np.inf), cut))])

        most = ROWS_AT_ONCE

        def parts(batches):
            held, n = [], 0
            for b in batches:
                held.append(b)
                n += b.num_rows
                if n >= most:
                    yield from add_up(pa.Table.from_batches(held))
                    held, n = [], 0
            if n:
                yield from add_up(pa.Table.from_batches(held))

        sums = self._plain_rows(rows).mapInArrow(parts, SUMS)
        return sums.groupBy(*names[:5]).agg(*[f(c).alias(c) for f, c in zip((F.sum, F.sum, F.sum, F.min, F.max), names[5:])])

    def _running(self, sums: DataFrame, at: DataFrame, two_level: bool, few: bool = False) -> DataFrame:
        """H3 at every (leaf, block) of ``at``: the leaf's statistics of all blocks up to it.  ``few``: both are one partition and stay so."""
        key = ["leaf", "feature", "label", "value"]
        keys = sums.select(*key).distinct()  # bounded by the model's size
        zero = at.join(keys.hint("merge") if few else F.broadcast(keys), "leaf").select(*sums.columns[:5], F.lit(0.0).alias("w"), *[
            F.lit(None).cast("double").alias(c) for c in ("s1", "s2", "mn", "mx")], F.lit(True).alias("_at"))
        values = {c: f for c, f in (("w", F.sum), ("s1", F.sum), ("s2", F.sum), ("mn", F.min), ("mx", F.max))}
        # dealt by the key alone, so that the windows below need no second exchange
        both = sums.withColumn("_at", F.lit(False)).unionByName(zero)
        base = (both.coalesce(1) if few else both.repartition(*key)).groupBy(*key, "_block").agg(
            *[f(c).alias(c) for c, f in values.items()], F.max("_at").alias("_at"))
        base = base.withColumn("_seg", F.floor(F.col("_block") / SEGMENT))
        own = Window.partitionBy(*key, "_seg").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = base.select(*key, "_block", "_seg", "_at", *[f(c).over(own).alias(c) for c, f in values.items()])
        if two_level:
            before = Window.partitionBy(*key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
            carry = base.groupBy(*key, "_seg").agg(*[f(c).alias(c) for c, f in values.items()]).select(
                *key, "_seg", *[f(c).over(before).alias(f"_{c}") for c, f in values.items()])
            local = local.where("_at").join(carry, [*key, "_seg"]).select(*key, "_block", "_at", *[
                F.coalesce(F.col(c) + F.col(f"_{c}"), c, f"_{c}").alias(c) for c in ("w", "s1", "s2")],
                F.least("mn", "_mn").alias("mn"), F.greatest("mx", "_mx").alias("mx"))
        return local.where("_at").drop("_at", "_seg")

    def _as_moments(self, stats: DataFrame) -> DataFrame:
        """Gaussian statistics (n, mean, m2, min, max) of the numeric features from power sums."""
        shift = F.get(F.array(*[F.lit(float(self.offset.get(i, 0.0))) for i in range(len(self.feature_cols))]), F.col("feature"))
        some = F.col("w") > 0
        return stats.where(F.col("feature").isin(self._num_idx())).select(
            "leaf", "_block", "feature", "label", F.col("w").alias("n"),
            (F.when(some, F.col("s1") / F.col("w")).otherwise(0.0) + shift).alias("mean"),
            F.when(some, F.greatest(F.lit(0.0), F.col("s2") - F.col("s1") * F.col("s1") / F.col("w"))).otherwise(0.0).alias("m2"),
            F.col("mn").alias("min"), F.col("mx").alias("max"))

    def _attempts(self, sums: DataFrame, at: DataFrame, open_leaves: Sequence[int], two_level: bool) -> DataFrame:
        """The attempts (leaf, _block) of ``at`` that are made, with the leaf's weight ``_n`` and ``bound``, from the class weights alone.

        A bound below the tie threshold splits whatever the merits, so with pre-pruning, where a leaf always has a
        suggestion, no attempt of a leaf after the first such block is looked at."""
        seeds = {i: sum(self.nodes[i].dist) - self.nodes[i].addon for i in open_leaves}  # weight that came from a parent's split
        dist = self._running(sums.where("feature = -1"), at, two_level).groupBy("leaf", "_block").agg(
            F.sum("w").alias("_n"), F.count(F.when(F.col("w") > 0, 1)).alias("_classes"))
        dist = dist.where((F.col("_n") - self._by_leaf(seeds) >= self.grace) & (F.col("_classes") > 1)).select(
            "leaf", "_block", "_n", S.hoeffding_bound(F.lit(self.criterion.value_range(self.num_classes)), self.delta, F.col("_n")).alias("bound"))
        if self.pre_prune:
            sure = F.min(F.when(F.col("bound") < self.tie, F.col("_block"))).over(Window.partitionBy("leaf"))  # a leaf's blocks of a run
            dist = dist.withColumn("_sure", sure).where(F.col("_sure").isNull() | (F.col("_block") <= F.col("_sure"))).drop("_sure")
        return written(dist, "ht-attempts")

    def _made(self, sums: pa.Table, tries: dict) -> list[tuple]:
        """``_attempts`` on the driver, of leaves with the blocks ``tries`` of their attempts: (leaf, block, weight, bound)."""
        mine = sums.filter(pc.equal(sums["feature"], -1))
        weights: dict = {}
        for leaf, block, label, w in zip(*[mine[c].to_pylist() for c in ("leaf", "_block", "label", "w")]):
            weights.setdefault(leaf, []).append((block, label, w))
        made, reach = [], self.criterion.value_range(self.num_classes)
        for leaf, blocks in tries.items():
            node = self.nodes[leaf]
            dist, seed, todo = dict(enumerate(node.dist)), sum(node.dist) - node.addon, sorted(weights.get(leaf, ()), reverse=True)
            for b in blocks:
                while todo and todo[-1][0] <= b:
                    _, label, w = todo.pop()
                    dist[label] = dist.get(label, 0.0) + w
                n = sum(dist.values())
                if n - seed < self.grace or sum(1 for w in dist.values() if w > 0) <= 1:
                    continue
                bound = math.sqrt(reach * reach * math.log(1.0 / self.delta) / (2.0 * n))
                made.append((leaf, int(b), float(n), bound))
                if self.pre_prune and bound < self.tie:
                    break
        return made

    def _decisions(self, stats: DataFrame, dist: DataFrame, few: bool) -> tuple[list, dict]:
        """G15-G18 at every attempt of ``dist``; per leaf the first block at which it fires, with the winning candidate, and that one's
        branches.  ``few``: the tables are one partition and stay so."""
        at = ["leaf", "_block"]

        def placed(df: DataFrame) -> DataFrame:
            return df.coalesce(1) if few else df.repartition(*at)

        ready = placed(stats)
        nominal = ready.where(F.col("feature").isin(list(self.nominal))) if self.nominal else None
        post = self._candidate_posts(self._as_moments(ready), nominal, at)
        post = placed(post).persist() if few else written(post, "ht-candidates")
        best = splits.best_split_per_feature(self._merits(placed(post), at), [*at, "feature"], ["cand"])
        none = None
        if self.pre_prune:
            none = self._no_split(ready.where("feature = -1"), at)
        if few:
            best, none = best.coalesce(1), None if none is None else none.coalesce(1)
        ranked = splits.rank_split_suggestions(best, at, none, keep=["cand"])
        ranked = (ranked.coalesce(1) if few else ranked).where("rank <= 2")
        top = ranked.groupBy(*at).agg(
            F.max(F.when(F.col("rank") == 1, F.col("feature"))).alias("feature"),
            F.max(F.when(F.col("rank") == 1, F.col("cand"))).alias("cand"), F.count("*").alias("_k"),
            (F.max(F.when(F.col("rank") == 1, F.col("merit"))) - F.max(F.when(F.col("rank") == 2, F.col("merit")))).alias("_gap"))
        bounds = dist.select(*at, "bound")
        fired = top.join(bounds.hint("merge") if few else bounds, at).where(
            (F.col("_k") < 2) | (F.col("bound") < self.tie) | (~F.isnan("_gap") & (F.col("_gap") > F.col("bound"))))
        first = fired.groupBy("leaf").agg(F.min(F.struct("_block", "feature", "cand")).alias("f")).select("leaf", "f.*")
        found, posts = first.collect(), {}  # one row per open leaf at most
        chosen = [(r.leaf, int(r["_block"]), r.feature, int(r.cand)) for r in found if r.feature >= 0]
        if chosen:
            picked = self._spark.createDataFrame(chosen, "leaf int, _block long, feature int, cand int")
            for p in post.join(F.broadcast(picked), ["leaf", "_block", "feature", "cand"], "left_semi").collect():
                posts.setdefault(p.leaf, []).append(p)
        if few:
            post.unpersist()
        return found, posts

    def _fires(self, sums: DataFrame | pa.Table, tries: dict, open_leaves: Sequence[int], low: int, two_level: bool) -> tuple[list, dict]:
        """H4-H6 of the open leaves: ``_decisions`` at their attempts, which are made after each sum (``split_all``) or at the blocks ``tries``."""
        if isinstance(sums, pa.Table):
            made = self._made(sums, tries)
            if not made:
                return [], {}
            ids = sorted({m[0] for m in made})
            known = pa.concat_tables([self._state_sums(ids, low), sums.filter(pc.is_in(sums["leaf"], pa.array(ids, pa.int32())))])
            few = known.num_rows <= ONE_TASK_STATISTICS
            known = self._spark.createDataFrame(known, SUMS)
            dist = self._spark.createDataFrame(made, "leaf int, _block long, _n double, bound double")
            if few:
                known, dist = known.coalesce(1), dist.coalesce(1)
        else:
            known = self._spark.createDataFrame(self._state_sums(open_leaves, low), SUMS).unionByName(sums)
            dist, few = self._attempts(known, sums.select("leaf", "_block").distinct(), open_leaves, two_level), False
        stats = self._running(known, dist.select("leaf", "_block"), two_level, few)
        if not few:
            stats = written(stats, "ht-stats")
            return self._decisions(stats, dist, stats.count() <= ONE_TASK_STATISTICS)  # from the written table's footers
        stats = stats.coalesce(1).persist()  # read three times
        try:
            return self._decisions(stats, dist, True)
        finally:
            stats.unpersist()

    def _learn(self, sums: DataFrame | pa.Table, until: dict) -> None:
        """H3: the leaves' statistics up to a block each become the model's."""
        key, of = ["leaf", "feature", "label", "value"], {"w": "sum", "s1": "sum", "s2": "sum", "mn": "min", "mx": "max"}
        if isinstance(sums, pa.Table):
            last = np.full(self.next_id, -1)
            last[list(until)] = list(until.values())
            total = sums.filter(pa.array(sums["_block"].to_numpy() <= last[sums["leaf"].to_numpy()])).group_by(key).aggregate(list(of.items()))
            columns = [total[c] for c in (*key, *[f"{c}_{f}" for c, f in of.items()])]
        else:
            total = sums.where(F.col("_block") <= self._by_leaf(until)).groupBy(*key).agg(*[getattr(F, f)(c).alias(c) for c, f in of.items()])
            columns = total.toArrow().columns  # leaves x features x classes (x values) rows
        rows = (_Sum(*r) for r in zip(*[c.to_pylist() for c in columns]))
        cd, g, nrows, _ = self._split_summary(rows)
        self.merge_block(cd, g, nrows)

    def _grow_run(self, rows: DataFrame, low: int, high: int, rows_per_block: int, lasts: DataFrame | None = None,
                  queries: DataFrame | None = None, id_cols: Sequence[str] = ()) -> DataFrame | None:
        """All splits that the blocks ``low`` .. ``high - 1`` bring.

        ``lasts``: the features of each block's last example, if the rows do not mark it; ``queries``: rows with a ``_block``,
        returned with their answers by the tree before that block.  Without ``split_all`` a leaf's rows are added up between the
        attempts at it, so the sums (and the driver, which reads them) grow with the attempts and leaves, not with leaves times blocks."""
        start = {i: low for i in self._active_ids()}
        first_new, events, first, last, stay, states = self.next_id, [], {}, {}, set(), []
        two_level = low // SEGMENT != high // SEGMENT
        at_block, tried = np.zeros(0, "int64"), None
        if self.grow and not self.split_all and start:  # H5: attempts only at the leaf of the block's last example
            lasts = rows.where("_last") if lasts is None else lasts
            table = lasts.select(F.col("_block").cast("long").alias("_block"), *[
                F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.feature_cols)]).toArrow()
            at_block = table["_block"].to_numpy()
            tried = np.column_stack([table[f"f{i}"].to_numpy() for i in range(len(self.feature_cols))])
        while start:
            tries: dict = {}
            if tried is not None:
                reached = self._descent()(tried)
                for leaf, block in sorted(zip(reached.tolist(), at_block.tolist())):
                    if block >= start.get(leaf, high):
                        tries.setdefault(leaf, []).append(block)
            by_block = self.grow and self.split_all
            sums = self._block_sums(rows, {i: (b,) if by_block else (b, *sorted({*tries.get(i, ()), high - 1})) for i, b in start.items()})
            sums = written(sums, "ht-sums") if by_block else sums.toArrow()
            first.update(start)
            if self.leaf_type == "adaptive" or queries is not None:
                states.append(self._state_sums(list(start), low))
            found, posts = self._fires(sums, tries, list(start), low, two_level) if self.grow else ([], {})
            fires = {r.leaf: r for r in found}
            until = {i: int(fires[i]["_block"]) if i in fires else high - 1 for i in start}
            last.update(until)
            stay |= {i for i in start if i not in fires or fires[i].feature < 0}
            self._learn(sums, until)
            start = {}
            for leaf, r in sorted(fires.items()):
                if r.feature < 0:
                    self.nodes[leaf].kind = "inactive"  # H6
                    continue
                self._split(leaf, r.feature, r.cand, posts.get(leaf, []))
                events.append((int(r["_block"]), leaf))
                if r["_block"] + 1 < high:
                    start.update({c: int(r["_block"]) + 1 for c in self.nodes[leaf].children.values()})
        if self.leaf_type == "adaptive" and stay:
            self._track_run(rows, first, last, stay, pa.concat_tables(states), max(1, ROWS_SCORED // rows_per_block), two_level)
        answers = None
        if queries is not None:
            states = pa.concat_tables(states) if states else self._state_sums([], low)
            answers = self._answer_run(rows, queries, id_cols, last, states, {leaf: block for block, leaf in events}, low, two_level)
        self._renumber(first_new, events)
        return answers

    def _answer_run(self, rows: DataFrame, queries: DataFrame, id_cols: Sequence[str], until: dict, states: pa.Table, since: dict, low: int,
                    two_level: bool) -> DataFrame:
        """H9 for the queries of a run of blocks: each goes down the splits of blocks before its own and gets the class of most weight
        at the node that it reaches, from the blocks before its own (a node that split or closed has the weights of that time).

        ``until``: the last block that a node of the run learned from; ``states``: what these nodes began with."""
        states = pa.concat_tables([states, self._state_sums([i for i in self.nodes if i not in until], low)])  # closed or split in an earlier run
        own = self.with_leaf(rows.select(F.col(self.label).cast("int").alias("label"), self._w().alias("weight"), "_block", *self.feature_cols),
                             since=since).where(F.col("label").isNotNull() & (F.col("_block") <= self._by_leaf(until)))
        none = [F.lit(None).cast("double").alias(c) for c in ("s1", "s2", "mn", "mx")]
        own = own.groupBy("leaf", "_block", "label").agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).select(
            "leaf", (F.col("_block") + 1).alias("_block"), F.lit(-1).alias("feature"), "label", F.lit(0.0).alias("value"), "w", *none)
        before = self._spark.createDataFrame(states.filter(pc.equal(states["feature"], -1)), SUMS).unionByName(own)
        routed = self.with_leaf(queries.select(*id_cols, "_block", *[c for c in self.feature_cols if c not in id_cols]), since=since)
        routed = written(routed.select(*id_cols, "_block", "leaf"), "ht-queries")
        at = ["leaf", "_block"]  # a key holds a block's rows at most
        weights = self._running(written(before, "ht-sums"), routed.select(*at).distinct(), two_level).groupBy(*at).agg(F.array(*[
            F.coalesce(F.sum(F.when(F.col("label") == c, F.col("w"))), F.lit(0.0)) for c in range(self.num_classes)]).alias("_w"))
        best = weights.select(*at, (F.array_position("_w", F.array_max("_w")).cast("int") - 1).alias("prediction"))
        # a node without any weight answers the first class
        return routed.join(best, at, "left").select(*id_cols, F.coalesce("prediction", F.lit(0)).alias("prediction"))

    def _renumber(self, first_new: int, events: list) -> None:
        """Ids in the order in which the blocks made the nodes, whatever the rounds."""
        to, free = {i: i for i in range(first_new)}, first_new
        for block in sorted({b for b, _ in events}):
            for leaf in sorted((leaf for b, leaf in events if b == block), key=to.__getitem__):
                for _, child in sorted(self.nodes[leaf].children.items()):
                    to[child], free = free, free + 1
        for node in self.nodes.values():
            node.id, node.parent = to[node.id], None if node.parent is None else to[node.parent]
            node.children = {b: to[c] for b, c in node.children.items()}
        self.nodes = {n.id: n for n in sorted(self.nodes.values(), key=lambda n: n.id)}
        self.g = {(to[k[0]], *k[1:]): v for k, v in self.g.items()}
        self.n = {(to[k[0]], *k[1:]): v for k, v in self.n.items()}

    def _track_run(self, rows: DataFrame, start: dict, until: dict, stay: set, states: pa.Table, chunk: int, two_level: bool) -> None:
        """Every row of the leaves that ``stay`` is scored by its leaf's statistics before its block; a leaf stays in one round.

        The blocks are taken ``chunk`` at a time: the leaves' statistics before a chunk are a running merge (H3), those
        before each of its blocks are added up beside the rows."""
        spans = {i: (start[i], *sorted({*range((start[i] // chunk + 1) * chunk - 1, until[i], chunk), until[i], np.iinfo("int32").max})) for i in stay}
        own = written(self._block_sums(rows, spans).where(F.col("_block") <= self._by_leaf({i: until[i] for i in stay})), "ht-sums")
        begun = self._spark.createDataFrame(states.filter(pc.is_in(states["leaf"], pa.array(sorted(stay), pa.int32()))), SUMS)
        part = F.floor(F.col("_block") / chunk)
        chunks = part.cast("long")
        before = begun.withColumn("_block", chunks).unionByName(own.withColumn("_block", chunks + 1))
        before = self._running(before, own.select("leaf", chunks.alias("_block")).distinct(), two_level).withColumnRenamed("_block", "_chunk")
        node_of, C, F_, names = self._descent(), self.num_classes, len(self.feature_cols), [f"f{i}" for i in range(len(self.feature_cols))]
        numeric, sizes, offset = self._num_idx(), dict(sorted(self.nominal.items())), [self.offset.get(i, 0.0) for i in range(F_)]
        first, last = np.full(self.next_id, np.iinfo("int64").max), np.full(self.next_id, -1)
        for i in stay:
            first[i], last[i] = start[i], until[i]
        vote = self._voting()

        def score(t: pa.Table, held: pa.Table) -> pa.Table:
            x, known = [t[c].to_numpy() for c in names], [np.asarray(t[c].is_valid()) for c in names]
            block, label = t["_o"].to_numpy(), t["label"].to_numpy()
            leaf = node_of(np.column_stack(x)) if len(block) else np.zeros(0, "int64")
            kept = np.flatnonzero((block >= first[leaf]) & (block <= last[leaf]))
            if not len(kept):
                return pa.table({"leaf": pa.array([], pa.int32()), "mc": pa.array([], pa.float64()), "nb": pa.array([], pa.float64())})
            kept = kept[np.lexsort((block[kept], leaf[kept]))]
            leaf, block, label = leaf[kept], block[kept], label[kept]
            x, known = [v[kept] for v in x], [k[kept] for k in known]
            some = np.asarray(t["weight"].is_valid())[kept]
            weight = np.where(some, t["weight"].to_numpy()[kept], 0.0)
            above = some & (weight > 0)
            new = np.concatenate([[True], (leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1])])
            group = np.cumsum(new) - 1
            mine = leaf[new]  # a group's leaf
            groups = len(mine)
            begins = np.concatenate([[True], mine[1:] != mine[:-1]])
            leaves, place = mine[begins], np.cumsum(begins) - 1
            edges = np.append(np.flatnonzero(begins), groups)
            held_leaf = held["leaf"].to_numpy()
            at = np.searchsorted(leaves, held_leaf).clip(0, len(leaves) - 1)
            h = {c: held[c].to_numpy() for c in ("feature", "label", "value", "w", "s1", "s2")}
            meant = (leaves[at] == held_leaf) & (h["label"] >= 0) & (h["label"] < C)
            inside = (label >= 0) & (label < C)

            def earlier(own: np.ndarray, carry: np.ndarray) -> np.ndarray:
                # by group: the leaf's sum before the chunk and of its groups before this one
                own = own.reshape(groups, -1)
                out = np.empty_like(own)
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    out[a] = carry[k]
                    if b - a > 1:
                        np.cumsum(own[a:b - 1], axis=0, out=out[a + 1:b])
                        out[a + 1:b] += carry[k]
                return out

            def sums(values: np.ndarray, which: np.ndarray, code=None, size: int = 1) -> np.ndarray:
                key = group[which] * C + label[which]
                return np.bincount(key if code is None else key * size + code, values[which], groups * C * size)

            def carried(which: np.ndarray, column: str, size: int = 1) -> np.ndarray:
                out = np.zeros((len(leaves), C * size))
                code = h["value"][which].astype("int64") if size > 1 else 0
                np.add.at(out, (at[which], h["label"][which] * size + code), np.nan_to_num(h[column][which]))
                return out

            def there(which: np.ndarray) -> np.ndarray:
                out = np.zeros((len(leaves), C), bool)
                out[at[which], h["label"][which]] = True
                return out[place]

            every = np.flatnonzero(inside)
            dist = earlier(sums(weight, every), carried(meant & (h["feature"] == -1), "w"))
            total = dist.sum(1)
            prior = np.where(total[:, None] > 0, dist / np.where(total > 0, total, 1.0)[:, None], dist)
            mc, moments, counts = prior.argmax(1)[group], {}, {}
            for f in numeric:
                which = meant & (h["feature"] == f)
                ok = np.flatnonzero(inside & above & np.isfinite(x[f]))
                d = x[f] - offset[f]
                n, s1, s2 = [earlier(sums(v, ok), carried(which, c)) for v, c in ((weight, "w"), (weight * d, "s1"), (weight * d * d, "s2"))]
                safe = np.where(n > 0, n, 1.0)
                moments[f] = (n, np.where(n > 0, s1 / safe, 0.0) + offset[f], np.where(n > 0, np.maximum(0.0, s2 - s1 * s1 / safe), 0.0), there(which))
            for f, size in sizes.items():
                which = meant & (h["feature"] == f) & (h["value"] >= 0) & (h["value"] < size)
                code = np.where(known[f] & np.isfinite(x[f]), x[f], -1.0)
                ok = np.flatnonzero(inside & (code >= 0) & (code < size))
                own = earlier(sums(weight, ok, code[ok].astype("int64"), size), carried(which, "w", size))
                counts[f] = (own.reshape(groups, C, size), there(which))
            nb = vote(group, prior, moments, counts, x, known)
            nb = np.where(nb >= 0, nb, mc)
            row = place[group]
            return pa.table({"leaf": pa.array(leaves, pa.int32()), "mc": np.bincount(row, np.where(mc == label, weight, 0.0), len(leaves)),
                             "nb": np.bincount(row, np.where(nb == label, weight, 0.0), len(leaves))})

        plain = self._plain_rows(rows).withColumn("_chunk", F.floor(F.col("_o") / chunk).cast("long"))
        right = plain.groupBy("_chunk").cogroup(before.groupBy("_chunk")).applyInArrow(score, "leaf int, mc double, nb double")
        for r in right.groupBy("leaf").agg(F.sum("mc").alias("mc"), F.sum("nb").alias("nb")).collect():  # one row per leaf
            self.nodes[r.leaf].mc_correct += r.mc
            self.nodes[r.leaf].nb_correct += r.nb

    def fit_blocks(self, df: DataFrame, order_cols: Sequence[str], rows_per_block: int = 5000,
                   id_cols: Sequence[str] | None = None) -> HoeffdingTree:
        """H8 block by block: a few jobs for each."""
        rows, n = self._stage(df, order_cols, rows_per_block, id_cols)
        for b in range(n):
            self.train_block(rows.where(F.col("_block") == b).drop("_pos", "_block", "_last"), order_cols, id_cols or order_cols)
        return self

    # ------------------------------------------------------------------ H12 test, then train
    def test_then_train(self, df: DataFrame, query: Column, example: Column, order_cols: Sequence[str], rows_per_block: int,
                        id_cols: Sequence[str]) -> DataFrame:
        """H12 over blocks of ``rows_per_block`` consecutive rows (in order): the answers of each block's ``query`` rows by the tree
        before it; then its ``example`` rows are learned.  All blocks are one run of ``fit``: jobs follow the depth that the tree
        gains.  Block by block where an answer or the statistics depend on more than the class weights."""
        self._spark = df.sparkSession
        cols = list(dict.fromkeys([*order_cols, *id_cols, *self.feature_cols, self.label] + ([self.weight] if self.weight else [])))
        placed = scan.row_position(df.select(*cols, query.alias("_query"), example.alias("_example")), list(order_cols), name="_pos")
        rows = written(placed.where("_query or _example").select(
            *cols, "_query", "_example", "_pos", F.floor(F.col("_pos") / rows_per_block).cast("long").alias("_block")), "ht-rows")
        examples, queries = rows.where("_example").drop("_query", "_example"), rows.where("_query")
        means = [F.avg(F.when(F.col("_example") & S.finite(F.col(self.feature_cols[i])), F.col(self.feature_cols[i]).cast("double"))).alias(str(i))
                 for i in self._num_idx()]
        row = rows.agg(F.max("_block").alias("last"), *means).first()
        n = 0 if row["last"] is None else row["last"] + 1
        if not self.offset:
            self.offset = {i: float(row[str(i)] or 0.0) for i in self._num_idx()}
        if n == 0 or self.leaf_type != "majority" or self.remove_poor:
            answers = self.predict(queries.where("false"), id_cols)
            for b in range(n):
                answers = answers.unionByName(written(self.predict(queries.where(F.col("_block") == b), id_cols), "ht-answers"))
                self.train_block(examples.where(F.col("_block") == b), order_cols, id_cols)
            return answers
        values = F.struct(*self.feature_cols)
        lasts = written(examples.groupBy("_block").agg(F.max_by(values, "_pos").alias("x")).select("_block", "x.*"), "ht-lasts")
        answers = self._grow_run(examples, 0, n, rows_per_block, lasts, queries, id_cols)
        self.blocks_seen += n
        return answers

    # ------------------------------------------------------------------ H9-H11 prediction
    def _leaf_statistics(self) -> dict:
        """Statistics of every leaf: prior, moments of the numeric features and weights by value of the nominal ones."""
        C, num, nom = self.num_classes, self._num_idx(), sorted(self.nominal)
        table: dict = {}
        for node in self.leaves():
            total, i = sum(node.dist), node.id
            table[i] = {"prior": [float(w) / total if total > 0 else 0.0 for w in node.dist],
                        "num": [[dict(zip(("n", "mean", "m2"), map(float, self.g[(i, f, c)][:3]))) if (i, f, c) in self.g else None
                                 for c in range(C)] for f in num],
                        "nom": [[None] * C for _ in nom]}
        for (leaf, f, c, value), w in self.n.items():
            if leaf in table and 0 <= value < self.nominal[f]:
                row = table[leaf]["nom"][nom.index(f)]
                row[c] = row[c] or [0.0] * self.nominal[f]
                row[c][int(value)] += float(w)
        return table

    def _voting(self):
        """H10 (G3, G6 and F7 with log10) as a function of numpy arrays: by row the naive Bayes class, -1 where no feature has a say.

        ``group``: by row the index of its model in ``prior`` (models x classes), ``moments`` (by numeric feature n, mean, m2 and whether
        there are any, models x classes) and ``counts`` (by nominal feature models x classes x values and whether there are any)."""
        numeric, sizes, constant = self._num_idx(), dict(sorted(self.nominal.items())), S.NORMAL_CONSTANT

        def vote(group, prior, moments, counts, x, known):
            with np.errstate(all="ignore"):
                logs = np.where(prior > 0, np.log10(prior), -np.inf)[group]
                seen = np.zeros(logs.shape, bool)

                def add(p, valid):
                    logs[...] += np.where(valid, np.where(p <= 0, -np.inf, np.log10(p)), 0.0)
                    seen[...] |= valid

                for f in numeric:
                    n, mean, m2, own = moments[f]
                    sd = np.sqrt(np.where(n <= 1, 0.0, m2 / np.where(n <= 1, 1.0, n - 1.0)))
                    n, mean, sd, own, v = n[group], mean[group], sd[group], own[group], x[f][:, None]
                    p = np.where(sd > 0, np.exp(-((v - mean) / sd) ** 2 / 2.0) / (constant * sd), (v == mean).astype("float64"))
                    add(np.where(n == 0, 0.0, p), own & (known[f][:, None] | (n == 0) | ~(sd > 0)))
                for f, size in sizes.items():
                    weights, own = counts[f]
                    code = np.where(known[f] & np.isfinite(x[f]), x[f], -1.0)
                    fits = (code > -1) & (code < size)
                    code = np.where(fits, code, 0.0).astype("int64")
                    total = weights.sum(2)[group]
                    got = np.where(fits[:, None], weights[group, :, code], 0.0)
                    add(np.where(total > 0, (got + 1.0) / (total + size), 0.0), own[group])
            # as ``array_max``: NaN is above all, of equal votes the first class has it
            rank = np.where(np.isnan(logs), np.inf, np.where(np.isneginf(logs), -1e308, logs))
            best = np.where(seen, rank, -np.inf).argmax(1)
            return np.where(seen.any(1), best, -1)

        return vote

    def _with_nb(self, routed: DataFrame, name: str = "nbp", use_nb: set | None = None) -> DataFrame:
        """Append the naive Bayes class at the row's ``leaf`` (null without statistics); with ``use_nb``, the class of most weight
        at nodes that are not in it or have no statistics.

        The leaves' statistics (bounded by the model) travel with a numpy function that scores a batch of rows: no join, no
        shuffle, and no plan that grows with the model.
        """
        table, size, C = self._leaf_statistics(), self.next_id, self.num_classes
        prior = np.zeros((size, C))
        moments = {f: [np.zeros((size, C)) for _ in range(3)] + [np.zeros((size, C), bool)] for f in self._num_idx()}
        counts = {f: [np.zeros((size, C, v)), np.zeros((size, C), bool)] for f, v in sorted(self.nominal.items())}
        for i, leaf in table.items():
            prior[i] = leaf["prior"]
            for parts, by_class in zip(moments.values(), leaf["num"]):
                for c, m in enumerate(by_class):
                    if m is not None:
                        parts[0][i, c], parts[1][i, c], parts[2][i, c], parts[3][i, c] = m["n"], m["mean"], m["m2"], True
            for parts, by_class in zip(counts.values(), leaf["nom"]):
                for c, weights in enumerate(by_class):
                    if weights is not None:
                        parts[0][i, c], parts[1][i, c] = weights, True
        vote, has = self._voting(), np.zeros(size, bool)
        has[list(table)] = True
        majority = None
        if use_nb is not None:
            majority, chosen = np.zeros(size, "int64"), np.zeros(size, bool)
            chosen[list(use_nb)] = True
            for i, node in self.nodes.items():
                majority[i] = _argmax(node.dist)

        @F.arrow_udf("int")
        def nb_of(rows: pa.Array) -> pa.Array:
            leaf, *x = rows.flatten()
            leaf = leaf.to_numpy(zero_copy_only=False).astype("int64")
            known = [np.asarray(v.is_valid()) for v in x]
            best = vote(leaf, prior, moments, counts, [v.to_numpy(zero_copy_only=False) for v in x], known)
            none = (best < 0) | ~has[leaf]
            if majority is not None:
                return pa.array(np.where(none | ~chosen[leaf], majority[leaf], best).astype("int32"))
            return pa.array(best.astype("int32"), mask=none)

        return routed.withColumn(name, nb_of(F.struct("leaf", *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.feature_cols)])))

    def _predict_both(self, df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
        own = df.select(*id_cols, F.col(self.label).cast("int").alias("label"), self._w().alias("weight"), *self.feature_cols)
        base = self._with_nb(self.with_leaf(own)).withColumn("mc", self.majority_of(F.col("leaf")))
        return base.select(*id_cols, "leaf", "mc", "label", "weight", F.coalesce("nbp", "mc").alias("nbp"))

    def predict(self, df: DataFrame, id_cols: Sequence[str], name: str = "prediction") -> DataFrame:
        """H9 (majority), H10 (NB leaves) or H11 (adaptive) per ``leaf_type``."""
        routed = self.with_leaf(df.select(*id_cols, *[c for c in self.feature_cols if c not in id_cols]))
        if self.leaf_type == "majority" or not (self.g or self.n):
            return routed.select(*id_cols, self.majority_of(F.col("leaf")).cast("int").alias(name))
        if self.leaf_type == "nb":
            use_nb = {n.id for n in self.leaves() if sum(n.dist) > self.nb_threshold}
        else:  # adaptive: NB unless majority was right more often (tie -> NB)
            use_nb = {n.id for n in self.leaves() if not n.mc_correct > n.nb_correct}
        return self._with_nb(routed, "_answer", use_nb).select(*id_cols, F.col("_answer").alias(name))

    # ------------------------------------------------------------------ H13-H15 node table
    def nodes_df(self, spark) -> DataFrame:
        return self._node_table(spark, {})

    def _node_table(self, spark, more: dict) -> DataFrame:
        """One row per node; ``more``: further attributes with their types."""
        rows = [(n.id, n.parent, n.branch, n.depth, n.kind, n.feature, n.test, n.value,
                 [float(x) for x in n.dist], *[t(getattr(n, a)) for a, (_, t) in more.items()])
                for n in sorted(self.nodes.values(), key=lambda n: n.id)]
        return spark.createDataFrame(rows, "node_id int, parent_id int, branch int, depth int, "
                                           "kind string, feature int, test string, value double, "
                                           "class_dist array<double>" + "".join(f", {a} {kind}" for a, (kind, _) in more.items()))

    # ------------------------------------------------------------------ J6 the model as tables
    def model_tables(self, spark) -> dict[str, DataFrame]:
        """The model as tables, for ``ensemble.save_model`` and streams: ``nodes``, ``moments`` and ``values``
        (statistics of the open leaves), ``given_up`` features and ``progress``. The options are not part of it."""
        more = {"n_branches": ("int", int)} | {a: ("double", float) for a in ("addon", "mc_correct", "nb_correct")}
        moments, _ = self.stats_frames(spark)
        values = [(*k, float(v)) for k, v in self.n.items()]
        given_up = [(leaf, f) for leaf, features in self.poor.items() for f in sorted(features)]
        return {"nodes": self._node_table(spark, more).withColumnRenamed("n_branches", "branches"), "moments": moments,
                "values": spark.createDataFrame(values, "leaf int, feature int, label int, value double, w double"),
                "given_up": spark.createDataFrame(given_up, "leaf int, feature int"),
                "progress": spark.createDataFrame([(self.blocks_seen, {int(k): float(v) for k, v in self.offset.items()})],
                                                  "blocks_seen bigint, offset map<int,double>")}

    def load_tables(self, tables: dict[str, DataFrame]) -> HoeffdingTree:
        """Take over a model that ``model_tables`` of a tree with the same options gave; training goes on where it ended.

        The tables are as small as the model and are read on the driver, where the tree lives."""
        nodes = {r["node_id"]: r for r in tables["nodes"].collect()}
        self.nodes = {i: Node(i, r["parent_id"], r["branch"], r["depth"], r["kind"], list(r["class_dist"]), r["feature"], r["test"], r["value"],
                              r["branches"], {}, r["addon"], r["mc_correct"], r["nb_correct"]) for i, r in sorted(nodes.items())}
        for n in self.nodes.values():
            if n.parent is not None:
                self.nodes[n.parent].children[n.branch] = n.id
        self.next_id = max(self.nodes) + 1
        self.g = {(r["leaf"], r["feature"], r["label"]): [r["n"], r["mean"], r["m2"], r["min"], r["max"]] for r in tables["moments"].collect()}
        self.n = {(r["leaf"], r["feature"], r["label"], r["value"]): r["w"] for r in tables["values"].collect()}
        self.poor = {}
        for r in tables["given_up"].collect():
            self.poor.setdefault(r["leaf"], set()).add(r["feature"])
        row = tables["progress"].first()
        self.blocks_seen, self.offset = row["blocks_seen"], dict(row["offset"])
        return self

    def rules(self, spark) -> DataFrame:
        """One rule per leaf (conditions from the root, joined by AND).

        The node table is joined to itself once per level (depth-bounded).
        """
        nodes = self.nodes_df(spark)
        names = F.array(*[F.lit(c) for c in self.feature_cols])
        cond_of = nodes.select(
            F.col("node_id").alias("pid"),
            F.col("feature").alias("pf"), F.col("test").alias("pt"), F.col("value").alias("pv"))
        edge = nodes.filter(F.col("parent_id").isNotNull()).join(
            cond_of, F.col("parent_id") == F.col("pid"))
        op = (F.when((F.col("pt") == "numeric") & (F.col("branch") == 0), F.lit(" < "))
              .when(F.col("pt") == "numeric", F.lit(" >= "))
              .when((F.col("pt") == "nominal") & (F.col("branch") == 0), F.lit(" == "))
              .when(F.col("pt") == "nominal", F.lit(" != "))
              .otherwise(F.lit(" == ")))
        val = F.when(F.col("pt") == "multiway", F.col("branch").cast("string")).otherwise(
            F.round("pv", 6).cast("string"))
        edge = edge.select("node_id", "parent_id",
                           F.concat(F.element_at(names, F.col("pf") + 1), op, val).alias("c"))
        leaves = nodes.filter(F.col("kind") != "split").select(
            "node_id", "depth", "class_dist", F.col("parent_id").alias("cur"),
            F.array().cast("array<string>").alias("conds"), F.col("node_id").alias("at"))
        max_depth = max(n.depth for n in self.nodes.values())
        cur = leaves
        for _ in range(max_depth):
            e = edge.select(F.col("node_id").alias("at"), F.col("parent_id").alias("up"), "c")
            cur = cur.join(e, "at", "left").select(
                "node_id", "depth", "class_dist",
                F.when(F.col("c").isNotNull(), F.concat(F.array("c"), F.col("conds")))
                .otherwise(F.col("conds")).alias("conds"),
                F.coalesce(F.col("up"), F.col("at")).alias("at"), F.col("cur"))
        best = (F.array_position(F.col("class_dist"), F.array_max("class_dist")) - 1).cast("int")
        return cur.select("node_id", "depth",
                          F.when(F.size("conds") == 0, F.lit("TRUE"))
                          .otherwise(F.concat_ws(" AND ", "conds")).alias("rule"),
                          best.alias("class"))

    def shape(self, spark) -> DataFrame:
        """Nodes, split nodes, leaves, active leaves, height (= max depth)."""
        nodes = self.nodes_df(spark)
        return nodes.agg(
            F.count(F.lit(1)).alias("n_nodes"),
            F.sum(F.when(F.col("kind") == "split", 1).otherwise(0)).alias("n_split"),
            F.sum(F.when(F.col("kind") != "split", 1).otherwise(0)).alias("n_leaves"),
            F.sum(F.when(F.col("kind") == "active", 1).otherwise(0)).alias("n_active"),
            F.max("depth").alias("height"))

    def pure_leaves(self, spark) -> DataFrame:
        """Leaves holding at most one class."""
        nodes = self.nodes_df(spark).filter(F.col("kind") != "split")
        return nodes.select("node_id", (F.size(F.filter("class_dist", lambda x: x > 0)) <= 1)
                            .alias("pure"))

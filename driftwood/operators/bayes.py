"""Multinomial naive Bayes (F1-F5, F5 on wide columns and on word maps) and observer-based NB votes.

The model is two small additive tables, so training is a partial
aggregation (map-side combine, then one shuffle of one row per
``(class, feature)`` per task) and merging two models is a union + sum.
Scoring joins example entries to per-feature parameters, one row per feature: broadcast up to
``BROADCAST_FEATURES`` rows. Beyond, the ``HOT_FEATURES`` of the greatest mass are broadcast, so that no
frequent word is a join key, and only the entries of the others meet their parameters by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.functions import stats as S
from driftwood.plans import scan
from driftwood.plans.parallelism import input_bytes, spread
from driftwood.session import written

#: Pairs of feature and class that are broadcast for scoring, and the most frequent ones features of a larger model (one map of classes each).
BROADCAST_FEATURES, HOT_FEATURES = 200_000, 20_000


@dataclass
class NBModel:
    """``class_counts(label, n)`` and ``feature_sums(label, feature, mass)``."""

    class_counts: DataFrame
    feature_sums: DataFrame


def entries(df: DataFrame, id_cols: Sequence[str], features, outer: bool = False) -> DataFrame:
    """Feature entries ``(id..., feature, x)`` of a map, array or column-list vector.

    ``outer``: a row without entries gives one of nulls.
    """
    ids = [F.col(c) for c in id_cols]
    if isinstance(features, str):
        kind = df.schema[features].dataType.typeName()
        if kind == "map":
            out = df.select(*ids, (F.explode_outer if outer else F.explode)(features).alias("feature", "x"))
        else:
            out = df.select(*ids, (F.posexplode_outer if outer else F.posexplode)(features).alias("feature", "x"))
    else:
        arr = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("x"))
                        for i, c in enumerate(features)])
        out = df.select(*ids, F.inline(arr))
    return out.withColumn("x", F.col("x").cast("double"))


def nb_train(df: DataFrame, features, label: str = "label") -> NBModel:
    """class counts and per-class per-feature sums."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    ent = entries(df.withColumnRenamed(label, "_label"), ["_label"], features)
    sums = (ent.groupBy(F.col("_label").alias("label"), "feature")
            .agg(F.sum("x").alias("mass")))
    return NBModel(counts, sums)


def nb_merge(a: NBModel, b: NBModel) -> NBModel:
    """add two models' statistics."""
    counts = a.class_counts.unionByName(b.class_counts).groupBy("label").agg(F.sum("n").alias("n"))
    sums = (a.feature_sums.unionByName(b.feature_sums).groupBy("label", "feature")
            .agg(F.sum("mass").alias("mass")))
    return NBModel(counts, sums)


def nb_params(model: NBModel, smoothing: float = 1.0, num_features: int | None = None,
              num_classes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(priors, conds)``.

    ``priors(label, log_prior, log_default)`` with
    ``log_prior = ln(n_c + s) - ln(total feature mass + C s)`` (the
    reference's denominator, kept) and ``log_default = ln(s) - ln(sum_j f_cj + F s)``
    (the conditional of a feature never seen with the class);
    ``conds(label, feature, log_cond)`` for observed pairs only.
    """
    s = float(smoothing)
    sums = model.feature_sums
    per_class = sums.groupBy("label").agg(F.sum("mass").alias("class_mass"))
    # Three scalars of the (small) model, read once on the driver.
    sc = sums.agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("total"),
                  F.countDistinct("feature").alias("nf")).first()
    total = float(sc.total)
    nf = float(num_features if num_features is not None else sc.nf)
    nc = float(num_classes if num_classes is not None else model.class_counts.count())
    priors = model.class_counts.join(per_class, "label", "left").select(
        "label",
        (F.log(F.col("n") + s) - F.lit(_ln(total + nc * s))).alias("log_prior"),
        (F.lit(_ln(s)) - F.log(F.coalesce("class_mass", F.lit(0.0)) + F.lit(nf * s)))
        .alias("log_default"))
    conds = sums.join(per_class, "label").select(
        "label", "feature",
        (F.log(F.col("mass") + s) - F.log(F.col("class_mass") + F.lit(nf * s))).alias("log_cond"))
    return priors, conds


def _ln(v: float) -> float:
    return math.log(v) if v > 0 else float("-inf")


def _argmax_class(scores: dict, name: str = "prediction") -> Column:
    """Arg-max over ``{class: score Column}``; ties go to the lowest class."""
    best = F.array_min(F.array(*[F.struct((-sc).alias("neg"), F.lit(c).alias("c"))
                                 for c, sc in sorted(scores.items())]))
    return best["c"].alias(name)


def _with_params(ent: DataFrame, delta: DataFrame, model: NBModel) -> DataFrame:
    """Entries with their feature's ``dm`` (null if unknown), without a hot join key."""
    if model.feature_sums.count() <= BROADCAST_FEATURES:  # from the written table's footers
        return ent.join(F.broadcast(delta), "feature", "left")
    mass = model.feature_sums.groupBy("feature").agg(F.sum("mass").alias("_mass"))
    hot = mass.orderBy(F.desc("_mass"), "feature").limit(HOT_FEATURES).select("feature")
    first = delta.join(F.broadcast(hot), "feature", "left_semi").withColumnRenamed("dm", "_hot")
    met = ent.join(F.broadcast(first), "feature", "left")
    # entries that are served (or null) go to the second join under spread keys that meet nothing
    done = F.col("_hot").isNotNull() | F.col("feature").isNull()
    salted = met.withColumn("_salt", F.when(done, F.pmod(F.monotonically_increasing_id(), F.lit(4096)) + 1).otherwise(F.lit(0)))
    # 0, but not a literal: the optimizer would take that out of the keys and deal by feature alone
    rest = delta.withColumn("_salt", F.pmod(F.xxhash64("feature"), F.lit(1)))
    size = input_bytes(ent)
    salted, rest = spread(salted, "feature", "_salt", size=size), spread(rest, "feature", "_salt", size=size)
    return salted.join(rest, ["feature", "_salt"], "left").withColumn("dm", F.coalesce("_hot", "dm")).drop("_hot", "_salt")


def nb_predict(model: NBModel, df: DataFrame, id_cols: Sequence[str], features,
               smoothing: float = 1.0, num_features: int | None = None, stored: bool = False) -> DataFrame:
    """``(id..., prediction)`` = arg-max of log prior + sum x_j log cond.

    ``stored``: the model's tables are read from files already.

    Features never seen in training are not part of the model and are
    ignored.  The class list is read from the (small) class table.
    """
    # the model tables are small (classes, classes x features): materialize them once in the
    # checkpoint folder so the scalar reads and the scoring plan do not re-run training
    if not stored:
        model = NBModel(written(model.class_counts, "nb-classes"), written(model.feature_sums, "nb-features"))
    priors, conds = nb_params(model, smoothing, num_features)
    pr = {r.label: (r.log_prior, r.log_default) for r in priors.collect()}  # C rows
    classes = sorted(pr)
    delta = (conds.join(F.broadcast(priors.select("label", "log_default")), "label")
             .select("feature", F.struct("label", (F.col("log_cond") - F.col("log_default"))
                                         .alias("d")).alias("e"))
             .groupBy("feature").agg(F.map_from_entries(F.collect_list("e")).alias("dm")))
    # the left joins keep rows whose features are all unknown, or that have none
    ent = _with_params(entries(df, id_cols, features, outer=True), delta, model)
    known = F.when(F.col("dm").isNotNull(), F.col("x"))
    ids = ent.groupBy(*id_cols).agg(
        F.sum(known).alias("_X"),
        *[F.sum(known * F.coalesce(F.try_element_at("dm", F.lit(c)), F.lit(0.0)))
          .alias(f"_S{i}") for i, c in enumerate(classes)])
    scores = {c: F.lit(pr[c][0]) + F.lit(pr[c][1]) * F.coalesce("_X", F.lit(0.0))
              + F.coalesce(f"_S{i}", F.lit(0.0)) for i, c in enumerate(classes)}
    return ids.select(*id_cols, _argmax_class(scores))


def nb_test_then_train(model: NBModel | None, df: DataFrame, epoch: str, id_cols: Sequence[str], features, label: str = "label",
                       smoothing: float = 1.0, num_features: int | None = None) -> tuple[DataFrame, NBModel]:
    """F1, F2, F4 over many epochs at once: ``(id..., prediction)`` of every row by ``model`` and the labelled rows of the epochs
    before its own (null where there are none), and the model after all of them.

    Answers and model are those of ``nb_predict``, ``nb_train`` and ``nb_merge`` epoch by epoch, for ``smoothing`` above 0.  The masses of a
    feature are added up by epoch, a window over its epochs gives what each epoch's rows see of them, and an entry meets its
    feature at its epoch: jobs do not follow the epochs.  ``df`` is read several times; ``epoch`` counts from 0.
    """
    s, ids, spark = float(smoothing), list(id_cols), df.sparkSession
    rows = df.withColumnRenamed(label, "_label").withColumnRenamed(epoch, "_epoch")
    known = F.col("_label").isNotNull()
    by_epoch = rows.filter(known).groupBy("_epoch", "_label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_epoch = written(by_epoch, "nb-epochs")  # epochs x classes rows
    kind = by_epoch.schema["_label"].dataType
    held_n = {} if model is None else {r.label: r.n for r in model.class_counts.collect()}
    counted = by_epoch.collect()
    classes = sorted({*held_n, *(r["_label"] for r in counted)})
    new_counts = by_epoch.groupBy(F.col("_label").alias("label")).agg(F.sum("n").alias("n"))
    none = F.lit(None).cast(kind).alias("prediction")
    if not classes:
        empty = entries(rows.filter(known), ["_label"], features).select(F.col("_label").alias("label"), "feature", F.col("x").alias("mass"))
        return rows.select(*ids, none), NBModel(new_counts, empty) if model is None else model
    masses = [f"_f{i}" for i in range(len(classes))]
    ent = entries(rows, ["_epoch", "_label"], features)
    need = written(ent.groupBy("feature", "_epoch").agg(F.max(known).alias("_learned"), *[
        F.sum(F.when(F.col("_label") == c, F.coalesce("x", F.lit(0.0)))).alias(m) for c, m in zip(classes, masses)]), "nb-masses")
    past = need.select("feature", F.col("_epoch").cast("long").alias("_epoch"), "_learned", *masses)
    if model is not None:
        held = model.feature_sums.groupBy("feature").agg(*[
            F.sum(F.when(F.col("label") == c, F.coalesce("mass", F.lit(0.0)))).alias(m) for c, m in zip(classes, masses)])
        past = past.unionByName(held.select("feature", F.lit(-1).cast("long").alias("_epoch"), F.lit(True).alias("_learned"), *masses))
    # a feature has a row an epoch at most
    before = Window.partitionBy("feature").orderBy("_epoch").rowsBetween(Window.unboundedPreceding, -1)
    seen = past.select("feature", "_epoch", F.max("_learned").over(before).alias("_seen"), *[
        F.coalesce(F.sum(m).over(before), F.lit(0.0)).alias(m) for m in masses]).filter(F.col("_seen") & (F.col("_epoch") >= 0))
    # what each epoch adds to the classes' masses and to the features: epochs rows
    added = {r["_epoch"]: r for r in past.groupBy("_epoch").agg(*[F.sum(m).alias(m) for m in masses]).collect()}
    born = past.filter("_learned").groupBy("feature").agg(F.min("_epoch").alias("_epoch")).groupBy("_epoch").agg(F.count(F.lit(1)).alias("n"))
    born = {r["_epoch"]: r["n"] for r in born.collect()}
    n, mass, size, params = dict(held_n), [0.0] * len(classes), 0, []
    for r in counted:
        added.setdefault(r["_epoch"], None)
    last = rows.agg(F.max("_epoch").alias("e")).first()["e"]
    new_n: dict = {}
    for r in counted:
        new_n.setdefault(r["_epoch"], []).append((r["_label"], r["n"]))
    for e in range(-1, (-1 if last is None else int(last)) + 1):
        if e >= 0:
            nf, nc, total = float(size if num_features is None else num_features), float(len(n)), sum(mass)
            # no feature at all: every class has the same score, as without a conditional
            prior = [None if c not in n else _ln(n[c] + s) - _ln(total + nc * s) if nf else 0.0 for c in classes]
            params.append((e, prior, [_ln(m + nf * s) if m + nf * s > 0 else 0.0 for m in mass]))
        if added.get(e) is not None:
            mass = [m + (added[e][k] or 0.0) for m, k in zip(mass, masses)]
        size += born.get(e, 0)
        for c, k in new_n.get(e, ()):
            n[c] = n.get(c, 0.0) + k
    by = spark.createDataFrame(params, "_epoch long, _prior array<double>, _den array<double>")
    blank = next((e for e, prior, _ in params if any(p is not None for p in prior)), len(params))  # epochs before any label
    asked = entries(rows.filter(F.col("_epoch") >= blank), ["_epoch", *ids], features, outer=True)
    asked = asked.withColumn("_epoch", F.col("_epoch").cast("long")).join(seen, ["feature", "_epoch"], "left")
    x = F.when(F.col("_seen"), F.col("x"))
    terms = asked.groupBy("_epoch", *ids).agg(F.sum(x).alias("_X"), *[
        F.sum(x * F.log(F.col(m) + s)).alias(f"_S{i}") for i, m in enumerate(masses)]).join(F.broadcast(by), "_epoch")
    scores = [F.col("_prior")[i] + F.coalesce(F.col(f"_S{i}") - F.col("_X") * F.col("_den")[i], F.lit(0.0)) for i in range(len(classes))]
    # a class that no epoch before had has no prior and is left out
    best = F.array_min(F.array(*[F.when(F.col("_prior")[i].isNotNull(), F.struct((-sc).alias("neg"), F.lit(c).cast(kind).alias("c")))
                                 for i, (c, sc) in enumerate(zip(classes, scores))]))
    answers = rows.filter(F.col("_epoch") < blank).select(*ids, none).unionByName(terms.select(*ids, best["c"].alias("prediction")))
    sums = need.groupBy("feature").agg(*[F.sum(m).alias(m) for m in masses])
    pairs = F.array(*[F.struct(F.lit(c).cast(kind).alias("label"), F.col(m).alias("mass")) for c, m in zip(classes, masses)])
    new = NBModel(new_counts, sums.select("feature", F.inline(pairs)).filter("mass is not null").select("label", "feature", "mass"))
    return answers, new if model is None else nb_merge(model, new)


def nb_prequential(df: DataFrame, feature_cols: Sequence[str], label: str, cmd: str,
                   order_cols, classes: Sequence[int], smoothing: float = 1.0,
                   key_cols=(), **bucket_opts) -> DataFrame:
    """each QUERY row is answered by the model of all earlier EXAMPLE rows.

    Running class counts and per-class feature sums over strictly earlier
    rows come from the two-level ordered scan (no one-task window).
    Appends ``prediction`` (null on EXAMPLE rows).
    """
    s = float(smoothing)
    nf = len(feature_cols)
    is_ex = F.col(cmd) == F.lit("EXAMPLE")
    sums = {}
    for c in classes:
        hit = is_ex & (F.col(label) == F.lit(c))
        sums[f"_n{c}"] = F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))
        for j, fc in enumerate(feature_cols):
            sums[f"_f{c}_{j}"] = F.when(hit, F.col(fc).cast("double")).otherwise(F.lit(0.0))
    out = scan.running_sums(df, sums, order_cols, key_cols, inclusive=False, **bucket_opts)
    class_mass = {c: sum((F.col(f"_f{c}_{j}") for j in range(nf)), F.lit(0.0)) for c in classes}
    total = sum(class_mass.values(), F.lit(0.0))
    scores = {}
    for c in classes:
        sc = F.log(F.col(f"_n{c}") + s) - F.log(total + F.lit(len(classes) * s))
        den = F.log(class_mass[c] + F.lit(nf * s))
        for j, fc in enumerate(feature_cols):
            sc = sc + (F.log(F.col(f"_f{c}_{j}") + s) - den) * F.col(fc).cast("double")
        scores[c] = sc
    pred = F.when(F.col(cmd) == F.lit("QUERY"), _argmax_class(scores, "prediction"))
    return out.select(*df.columns, pred.alias("prediction"))


def _mass(df: DataFrame, features) -> Column:
    """Sum of a row's feature values."""
    if isinstance(features, str):
        is_map = df.schema[features].dataType.typeName() == "map"
        values = F.map_values(features) if is_map else F.col(features)
    else:
        values = F.array(*[F.col(c).cast("double") for c in features])
    return F.coalesce(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v.cast("double"), F.lit(0.0))), F.lit(0.0))


def nb_prequential_entries(df: DataFrame, id_cols: Sequence[str], features, label: str, cmd: str, order_cols,
                           classes: Sequence[int], smoothing: float = 1.0, num_features: int | None = None,
                           **bucket_opts) -> DataFrame:
    """F5 on sparse rows (word maps): ``(id..., prediction)``, null but on QUERY rows.

    Every QUERY row is answered by the model of all earlier EXAMPLE rows, as ``nb_params`` and
    ``nb_predict`` of those rows would: features not yet seen are ignored, and the number of features is that
    seen so far unless ``num_features`` is given.  The classes are fixed; an example of another class,
    or of none, is not learned.  ``smoothing`` is above 0.

    The mass of a feature and class before a row is a keyed ordered scan over the entries
    (hot features are split into ranges of the order), class counts and masses a global one over the rows; an
    entry's terms are added up per query with a partial aggregate.  Ids may repeat.
    """
    s, ids = float(smoothing), list(id_cols)
    is_ex = (F.col(cmd) == F.lit("EXAMPLE")) & F.col(label).isin([int(c) for c in classes])
    numbered = scan.row_position(df.withColumns({"_ex": F.coalesce(is_ex, F.lit(False)), "_mass": _mass(df, features)}),
                                 order_cols, name="_pos", **bucket_opts)
    # positions are read four times
    rows = written(numbered.select(*ids, F.col(label).alias("_lab"), (F.col(cmd) == "QUERY").alias("_query"), "_ex", "_mass", "_pos",
                                   *([features] if isinstance(features, str) else features)), "nb-rows")
    ent = entries(rows, ["_pos", "_ex", "_query", "_lab"], features).filter(F.col("x").isNotNull())
    mine = {c: F.col("_ex") & (F.col("_lab") == F.lit(c)) for c in classes}
    before = scan.running_sums(
        ent, {"_seen": F.col("_ex").cast("int")} | {f"_f{i}": F.when(mine[c], F.col("x")).otherwise(F.lit(0.0)) for i, c in enumerate(classes)},
        ["_pos"], ["feature"], inclusive=False, **bucket_opts)
    terms = (before.filter(F.col("_query") & (F.col("_seen") > 0)).groupBy("_pos").agg(
        F.sum("x").alias("_X"), *[F.sum(F.col("x") * F.log(F.col(f"_f{i}") + s)).alias(f"_S{i}") for i in range(len(classes))]))
    slim = rows.select(*ids, "_lab", "_query", "_ex", "_mass", "_pos")
    if num_features is None:
        first = ent.filter("_ex").groupBy("feature").agg(F.min("_pos").alias("_pos"))
        slim = slim.join(first.groupBy("_pos").agg(F.count(F.lit(1)).alias("_new")), "_pos", "left").fillna(0, ["_new"])
    else:
        slim = slim.withColumn("_new", F.lit(0))
    sums = {"_F": F.col("_new")}
    for i, c in enumerate(classes):
        sums[f"_n{i}"] = F.when(mine[c], F.lit(1.0)).otherwise(F.lit(0.0))
        sums[f"_m{i}"] = F.when(mine[c], F.col("_mass")).otherwise(F.lit(0.0))
    model = scan.running_sums(slim, sums, ["_pos"], inclusive=False, **bucket_opts)
    size = F.col("_F").cast("double") if num_features is None else F.lit(float(num_features))
    total = sum((F.col(f"_m{i}") for i in range(len(classes))), F.lit(0.0))
    scores = {}
    for i, c in enumerate(classes):
        seen = F.col(f"_S{i}") - F.col("_X") * F.log(F.col(f"_m{i}") + size * s)
        scores[c] = (F.log(F.col(f"_n{i}") + s) - F.log(total + F.lit(len(classes) * s)) + F.coalesce(seen, F.lit(0.0)))
    answered = model.join(terms, "_pos", "left")
    return answered.select(*ids, F.when(F.col("_query"), _argmax_class(scores, "p")).alias("prediction"))


def observer_nb_votes(df: DataFrame, id_cols: Sequence[str], gaussian: DataFrame | None,
                      nominal: DataFrame | None, class_weights: DataFrame, features_numeric,
                      features_nominal=(), log10: bool = False,
                      nominal_sizes: dict | None = None, smoothing: float = 1.0) -> DataFrame:
    """``vote_c = prior_c * prod_j p(x_j | c)`` per example and class.

    ``gaussian(feature, label, n, mean, m2)`` (G1) gives the numeric
    likelihoods, ``nominal(feature, label, value, w)`` (G4) the Laplace
    nominal ones, ``class_weights(label, w)`` the priors.  Output long form
    ``(id..., label, vote)`` (``log_vote`` in log10 when ``log10``).  The
    statistics (features x classes rows, and values for nominal features) go
    into the plan as literals, so every row scores itself: no join, no shuffle.
    """
    weights = {r["label"]: float(r["w"]) for r in class_weights.collect()}
    total = sum(weights.values())
    num = list(features_numeric or ())
    nom = list(features_nominal or ())
    sizes = nominal_sizes or {}
    stats = {(r["feature"], r["label"]): r for r in gaussian.collect()} if gaussian is not None and num else {}
    counts: dict = {}
    if nominal is not None and nom:
        for r in nominal.collect():
            counts.setdefault((r["feature"], r["label"]), {})[r["value"]] = float(r["w"])
    votes = []
    for label in sorted(weights):
        ps = []
        for j, c in enumerate(num):
            r = stats.get((j, label))
            if r is not None:
                ps.append(S.gaussian_density(F.col(c).cast("double"), F.lit(float(r["n"])), F.lit(float(r["mean"])),
                                             F.lit(float(r["m2"]))))
        for j, c in enumerate(nom, len(num)):
            own = counts.get((j, label), {})
            tot = sum(own.values())
            if tot == 0:
                ps.append(F.lit(0.0))
                continue
            w = F.lit(0.0)
            for v, n in sorted(own.items()):
                w = F.when(F.col(c) == F.lit(v), F.lit(n)).otherwise(w)
            ps.append((w + smoothing) / F.lit(tot + float(sizes.get(j, 1)) * smoothing))
        zero = sum((F.when(p <= 0, 1).otherwise(0) for p in ps), F.lit(0)) > 0
        logs = sum((F.when(p > 0, F.log10(p)).otherwise(F.lit(0.0)) for p in ps), F.lit(0.0))
        log = F.when(zero, F.lit(float("-inf"))).otherwise(F.lit(_log10(weights[label] / total)) + logs)
        vote = log if log10 else F.when(zero, F.lit(0.0)).otherwise(F.pow(F.lit(10.0), log))
        votes.append(F.struct(F.lit(label).alias("label"), vote.alias("log_vote" if log10 else "vote")))
    return df.select(*id_cols, F.inline(F.array(*votes)))


def _log10(v: float) -> float:
    return math.log10(v) if v > 0 else float("-inf")

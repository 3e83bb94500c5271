"""Registered queries: one per operator of the inventory, over the driver's tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and has a twin SQL string in
``driftwood.plans.oracle`` (unless the operator is not SQL-expressible).
Column names match the SQL twin exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.operators import ordered
from driftwood.plans.parallelism import input_bytes, spread
from driftwood.session import written
from driftwood.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
EVENT_ORDER = ["ts", "event_id"]


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _event_ints(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return ev.withColumn("x", F.round(F.col("value") * 100).cast("long") - F.lit(5000))


# ------------------------------------------------------------------ ordered

@register("running_max_subarray")
def q_running_max_subarray(spark, sf_dir):
    ev = _event_ints(spark, sf_dir)
    out = ordered.running_max_subarray(ev, "x", EVENT_ORDER, ["user_id"])
    return out.select("user_id", "event_id", "x", "max_ending_here", "max_subarray")


@register("running_max_subarray_global")
def q_running_max_subarray_global(spark, sf_dir):
    ev = _event_ints(spark, sf_dir)
    out = ordered.running_max_subarray(ev, "x", EVENT_ORDER)
    return out.select("event_id", "x", "max_ending_here", "max_subarray")


@register("max_subarray")
def q_max_subarray(spark, sf_dir):
    ev = _event_ints(spark, sf_dir)
    return ordered.max_subarray(ev, "x", EVENT_ORDER, ["user_id"]).select("user_id", "max_subarray")


def _line_xy(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_quantity", "l_extendedprice")
    return li.select(*LINE_ORDER, F.col("l_quantity").alias("x"),
                     (F.col("l_extendedprice") / 1000.0).alias("y"))


@register("rls_weights")
def q_rls_weights(spark, sf_dir):
    out = ordered.rls_weights(_line_xy(spark, sf_dir), "x", "y", LINE_ORDER, x0=1.0, y0=10.0)
    return out.select(*LINE_ORDER, "theta", F.round("weight", 6).alias("weight"),
                      F.round("prediction", 6).alias("prediction"))


@register("rls_predict")
def q_rls_predict(spark, sf_dir):
    """Keyed form: one filter per supplier."""
    out = ordered.rls_predict(_line_xy(spark, sf_dir), "x", "y", LINE_ORDER, ["l_suppkey"],
                              x0=1.0, y0=10.0)
    return out.select(*LINE_ORDER, F.round("prediction", 6).alias("prediction"))


def _line_ftl(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_quantity", "l_extendedprice")
    return li.select(*LINE_ORDER, F.col("l_quantity").alias("x"),
                     F.round(F.col("l_extendedprice") / 1000.0).alias("y"))


@register("follow_the_leader")
def q_follow_the_leader(spark, sf_dir):
    out = ordered.follow_the_leader(_line_ftl(spark, sf_dir), "x", "y", LINE_ORDER)
    return out.select(*LINE_ORDER, "leader", "prediction")


@register("follow_the_leader_sliding")
def q_follow_the_leader_sliding(spark, sf_dir):
    out = ordered.follow_the_leader(_line_ftl(spark, sf_dir), "x", "y", LINE_ORDER, window=5)
    return out.select(*LINE_ORDER, "leader", "prediction")


@register("follow_the_leader_long_window")
def q_follow_the_leader_long_window(spark, sf_dir):
    """C9 with the last thousand pairs."""
    out = ordered.follow_the_leader(_line_ftl(spark, sf_dir), "x", "y", LINE_ORDER, window=1000)
    return out.select(*LINE_ORDER, "leader", "prediction")


@register("follow_the_leader_keyed")
def q_follow_the_leader_keyed(spark, sf_dir):
    out = ordered.follow_the_leader(_line_ftl(spark, sf_dir), "x", "y", LINE_ORDER, ["l_suppkey"])
    return out.select(*LINE_ORDER, "leader", "prediction")


@register("zip_by_position")
def q_zip_by_position(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    out = ordered.zip_by_position(li, od, LINE_ORDER, ["o_orderdate", "o_orderkey"])
    return out.select("pos", "l_orderkey", "l_linenumber", "l_quantity", "o_orderkey",
                      "o_totalprice")


@register("take_first")
def q_take_first(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return ordered.take_first(ev, 100, EVENT_ORDER).select("event_id", "user_id", "value")


# ------------------------------------------------------------------ vectors

from driftwood.functions import conditions as cond  # noqa: E402
from driftwood.functions import vectors as vec  # noqa: E402


def _emb_pairs(spark, sf_dir) -> DataFrame:
    """Each embedding with the next one (``vec_id + 1``); equi-join on id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, on="vec_id", how="inner")


@register("vec_get")
def q_vec_get(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", vec.vec_get("embedding", 3).alias("v3"),
                    vec.vec_get("embedding", 64).alias("v64"))


@register("vec_dot")
def q_vec_dot(spark, sf_dir):
    p = _emb_pairs(spark, sf_dir)
    return p.select("vec_id", F.round(vec.vec_dot("embedding", "other"), 6).alias("dot"))


@register("vec_add")
def q_vec_add(spark, sf_dir):
    p = _emb_pairs(spark, sf_dir)
    return p.select("vec_id", vec.vec_add("embedding", "other").alias("vec_sum"))


@register("vec_hadamard")
def q_vec_hadamard(spark, sf_dir):
    p = _emb_pairs(spark, sf_dir)
    return p.select("vec_id", vec.vec_hadamard("embedding", "other").alias("vec_prod"))


@register("vec_distance")
def q_vec_distance(spark, sf_dir):
    p = _emb_pairs(spark, sf_dir)
    return p.select("vec_id", F.round(vec.vec_distance("embedding", "other"), 6).alias("distance"))


@register("vec_set")
def q_vec_set(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", vec.vec_set("embedding", 0, F.col("label")).alias("vec_first_set"),
                    vec.append_bias("embedding").alias("vec_bias"))


@register("vec_map")
def q_vec_map(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", vec.vec_map("embedding", lambda x: x * 2.0 + 1.0).alias("vec_mapped"))


@register("vec_reduce")
def q_vec_reduce(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    sq = vec.vec_reduce("embedding", lambda acc, x: acc + x * x)
    return e.select("vec_id", F.round(sq, 6).alias("sum_sq"))


@register("vec_entries")
def q_vec_entries(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return vec.vec_entries(e, "embedding", keep=["vec_id"])


@register("vec_argmax")
def q_vec_argmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", vec.vec_argmax("embedding").alias("argmax"))


def _word_lengths(spark, sf_dir) -> DataFrame:
    """Sparse (map) vectors of the documents: the number of words by their length."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    counts = words.where("w <> ''").groupBy("doc_id", F.length("w").alias("k")).agg(F.count("*").cast("double").alias("n"))
    return counts.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("a"))


def _sparse_pairs(spark, sf_dir) -> DataFrame:
    own = written(_word_lengths(spark, sf_dir), "word-lengths")
    return own.join(own.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b")), "doc_id")


@register("sparse_vec_ops")
def q_sparse_vec_ops(spark, sf_dir):
    p = _sparse_pairs(spark, sf_dir)
    return p.select("doc_id",
                    F.round(vec.map_dot("a", "b"), 6).alias("dot"),
                    F.round(vec.map_distance("a", "b"), 6).alias("distance"),
                    vec.map_get("a", 5).alias("a5"),
                    F.size(vec.map_add("a", "b")).alias("n_add"),
                    F.size(vec.map_hadamard("a", "b")).alias("n_prod"),
                    F.round(vec.map_reduce(vec.map_map("a", F.abs), lambda acc, x: acc + x), 6)
                    .alias("l1"))


#: A word map in memory against its compressed words on disk: pairs of maps are dealt by that.
MAP_BYTES = 8


def _doc_tf_pairs(spark, sf_dir) -> DataFrame:
    # both sides of the pair read one written word-count table (computed once)
    docs = table(spark, sf_dir, "documents")
    tf = written(vec.word_counts(docs, "doc_id", "text", "tf"), "word-counts")
    size = MAP_BYTES * max(input_bytes(docs), input_bytes(tf))
    nxt = tf.select((F.col("doc_id") - 1).alias("doc_id"), F.col("tf").alias("tf2"))
    return spread(tf, "doc_id", size=size).join(spread(nxt, "doc_id", size=size), on="doc_id", how="inner")


@register("text_vec_dot")
def q_text_vec_dot(spark, sf_dir):
    p = _doc_tf_pairs(spark, sf_dir)
    return p.select("doc_id", vec.map_dot("tf", "tf2").alias("dot"),
                    F.round(vec.map_distance("tf", "tf2"), 6).alias("distance"),
                    vec.map_get("tf", "the").alias("n_the"))


@register("text_vec_add")
def q_text_vec_add(spark, sf_dir):
    p = _doc_tf_pairs(spark, sf_dir)
    s = p.select("doc_id", vec.map_add("tf", "tf2").alias("s"))
    return s.select("doc_id", F.explode("s").alias("word", "value"))


@register("text_vec_hadamard")
def q_text_vec_hadamard(spark, sf_dir):
    p = _doc_tf_pairs(spark, sf_dir)
    s = p.select("doc_id", vec.map_hadamard("tf", "tf2").alias("s"))
    return s.select("doc_id", F.explode("s").alias("word", "value"))


# ------------------------------------------------------------------ branch tests

@register("numeric_test")
def q_numeric_test(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINE_ORDER, cond.numeric_test("l_quantity", 25.0).alias("branch_lt"),
                     cond.numeric_test("l_quantity", 25.0, equal_test=True).alias("branch_eq"))


@register("nominal_test")
def q_nominal_test(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINE_ORDER, cond.nominal_test("l_returnflag", "R").alias("branch"))


@register("multiway_test")
def q_multiway_test(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINE_ORDER, cond.multiway_test(F.col("l_linenumber") - 1).alias("branch"))


@register("rule_predicate")
def q_rule_predicate(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINE_ORDER, *[cond.rule_predicate("l_discount", 0.05, op).alias(f"branch_op{op}")
                                    for op in (0, 1, 2, 3)])


# ------------------------------------------------------------------ learners' statistics

from driftwood.functions import stats as ST  # noqa: E402
from driftwood.operators import bayes, observers, splits  # noqa: E402
from driftwood.operators.examples import code_nominal, to_long  # noqa: E402

# Class and nominal domains of the lineitem examples.
RETURNFLAG_DOMAIN = ["A", "N", "R"]
LINESTATUS_DOMAIN = ["F", "O"]
NUMERIC_FEATURES = ["f_qty", "f_price", "f_disc", "f_tax"]
NOMINAL_FEATURES = ["f_status", "f_line"]
NOMINAL_SIZES = {0: 2, 1: 7}


def _line_examples(spark, sf_dir) -> DataFrame:
    """lineitem as examples: 4 numeric features, 2 nominal, class = return flag."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LINE_ORDER, "l_linestatus",
        F.col("l_quantity").alias("f_qty"),
        (F.col("l_extendedprice") / 1000.0).alias("f_price"),
        (F.col("l_discount") * 100.0).alias("f_disc"),
        (F.col("l_tax") * 100.0).alias("f_tax"),
        code_nominal("l_linestatus", LINESTATUS_DOMAIN).alias("f_status"),
        (F.col("l_linenumber") - 1).cast("double").alias("f_line"),
        code_nominal("l_returnflag", RETURNFLAG_DOMAIN).cast("int").alias("label"))


def _numeric_long(ex: DataFrame, extra=()) -> DataFrame:
    return to_long(ex, [*LINE_ORDER, *extra], NUMERIC_FEATURES, label="label")


def _nominal_long(ex: DataFrame, extra=()) -> DataFrame:
    return to_long(ex, [*LINE_ORDER, *extra], NOMINAL_FEATURES, label="label")


def _round_stats(g: DataFrame, keys) -> DataFrame:
    return g.select(*keys, "n", F.round("mean", 6).alias("mean"),
                    F.round(ST.gaussian_variance("n", "m2"), 6).alias("variance"),
                    "min", "max")


@register("gaussian_stats")
def q_gaussian_stats(spark, sf_dir):
    g = observers.gaussian_stats(_numeric_long(_line_examples(spark, sf_dir)))
    return _round_stats(g, ["feature", "label"])


@register("merge_gaussian_stats")
def q_merge_gaussian_stats(spark, sf_dir):
    ex = _line_examples(spark, sf_dir)
    a = observers.gaussian_stats(_numeric_long(ex.filter(F.col("l_linestatus") == "F")))
    b = observers.gaussian_stats(_numeric_long(ex.filter(~F.col("l_linestatus").eqNullSafe("F"))))
    return _round_stats(observers.merge_gaussian_stats(a, b), ["feature", "label"])


@register("gaussian_density")
def q_gaussian_density(spark, sf_dir):
    ex = _line_examples(spark, sf_dir)
    lg = _numeric_long(ex)
    g = observers.gaussian_stats(lg)
    j = lg.join(F.broadcast(g.select("feature", "label", "n", "mean", "m2")), ["feature", "label"])
    return j.select(*LINE_ORDER, "feature",
                    F.round(ST.gaussian_density("value", "n", "mean", "m2"), 9).alias("density"))


def _nominal_stats(spark, sf_dir, ex=None) -> DataFrame:
    ex = ex if ex is not None else _line_examples(spark, sf_dir)
    return observers.nominal_stats(_nominal_long(ex))


@register("nominal_stats")
def q_nominal_stats(spark, sf_dir):
    return _nominal_stats(spark, sf_dir)


@register("merge_nominal_stats")
def q_merge_nominal_stats(spark, sf_dir):
    ex = _line_examples(spark, sf_dir)
    a = _nominal_stats(spark, sf_dir, ex.filter(F.col("f_qty") < 25))
    b = _nominal_stats(spark, sf_dir, ex.filter(F.col("f_qty") >= 25))
    return observers.merge_nominal_stats(a, b)


@register("nominal_probability")
def q_nominal_probability(spark, sf_dir):
    p = observers.nominal_probability(_nominal_stats(spark, sf_dir), NOMINAL_SIZES)
    return p.select("feature", "label", "value", F.round("probability", 9).alias("probability"))


def _gstats(spark, sf_dir, leaf=False) -> DataFrame:
    ex = _line_examples(spark, sf_dir)
    keys = ["l_linestatus"] if leaf else []
    lg = _numeric_long(ex, keys)
    return observers.gaussian_stats(lg, [*keys, "feature", "label"])


@register("split_points")
def q_split_points(spark, sf_dir):
    p = observers.split_points(_gstats(spark, sf_dir))
    return p.select("feature", "point_idx", F.round("point", 6).alias("point"))


def _gauss_post(spark, sf_dir) -> DataFrame:
    g = _gstats(spark, sf_dir)
    return observers.gaussian_split_weights(g, observers.split_points(g))


@register("gaussian_split_weights")
def q_gaussian_split_weights(spark, sf_dir):
    p = _gauss_post(spark, sf_dir)
    return p.select("feature", "point_idx", "branch", "label", F.round("w", 6).alias("w"))


@register("nominal_binary_splits")
def q_nominal_binary_splits(spark, sf_dir):
    return observers.nominal_binary_splits(_nominal_stats(spark, sf_dir))


@register("nominal_multiway_split")
def q_nominal_multiway_split(spark, sf_dir):
    return observers.nominal_multiway_split(_nominal_stats(spark, sf_dir))


def _all_candidates(spark, sf_dir) -> DataFrame:
    """Numeric cut candidates and nominal binary candidates as one post table."""
    num = _gauss_post(spark, sf_dir).select(
        "feature", F.col("point_idx").alias("cand"), "branch", "label", "w")
    nom = observers.nominal_binary_splits(_nominal_stats(spark, sf_dir)).select(
        (F.col("feature") + 4).alias("feature"), F.col("split_value").cast("int").alias("cand"),
        "branch", "label", "w")
    return num.unionByName(nom)


@register("info_gain")
def q_info_gain(spark, sf_dir):
    m = splits.info_gain(_all_candidates(spark, sf_dir), ["feature", "cand"])
    return m.select("feature", "cand", F.round("merit", 6).alias("merit"))


@register("gini_merit")
def q_gini_merit(spark, sf_dir):
    m = splits.gini_merit(_all_candidates(spark, sf_dir), ["feature", "cand"])
    return m.select("feature", "cand", F.round("merit", 6).alias("merit"))


@register("variance_reduction")
def q_variance_reduction(spark, sf_dir):
    """Regression target f_price, split candidates = the G7 cut points of f_qty."""
    ex = _line_examples(spark, sf_dir)
    pts = observers.split_points(_gstats(spark, sf_dir)).filter("feature = 0")
    cuts = [r.point for r in pts.orderBy("point_idx").collect()]  # at most `bins` values
    mom = splits.cut_moments(ex, "f_qty", "f_price", cuts)
    m = splits.variance_reduction(mom, ["point_idx"])
    return m.select("point_idx", F.round("merit", 4).alias("merit"))


@register("best_split_per_feature")
def q_best_split_per_feature(spark, sf_dir):
    m = splits.info_gain(_all_candidates(spark, sf_dir), ["feature", "cand"])
    b = splits.best_split_per_feature(m, ["feature"], ["cand"])
    return b.select("feature", "cand", F.round("merit", 6).alias("merit"))


def _leaf_suggestions(spark, sf_dir):
    """Per leaf (= line status), the best info-gain cut of each numeric feature."""
    g = _gstats(spark, sf_dir, leaf=True)
    pts = observers.split_points(g, group_cols=["l_linestatus", "feature"])
    post = observers.gaussian_split_weights(g, pts, group_cols=["l_linestatus", "feature"])
    m = splits.info_gain(post.withColumnRenamed("point_idx", "cand"),
                         ["l_linestatus", "feature", "cand"])
    best = splits.best_split_per_feature(m, ["l_linestatus", "feature"], ["cand"])
    leaves = g.filter("feature = 0").groupBy("l_linestatus").agg(F.sum("n").alias("weight"))
    no_split = leaves.select("l_linestatus", F.lit(float("-inf")).alias("merit"))
    ranked = splits.rank_split_suggestions(best, ["l_linestatus"], no_split)
    bounds = splits.hoeffding_bound(leaves, "weight", "info_gain", 3)
    return ranked, bounds


@register("rank_split_suggestions")
def q_rank_split_suggestions(spark, sf_dir):
    ranked, _ = _leaf_suggestions(spark, sf_dir)
    return ranked.select("l_linestatus", "feature", "rank", F.round("merit", 6).alias("merit"))


@register("hoeffding_bound")
def q_hoeffding_bound(spark, sf_dir):
    _, bounds = _leaf_suggestions(spark, sf_dir)
    return bounds.select("l_linestatus", "weight", F.round("bound", 9).alias("bound"))


@register("should_split")
def q_should_split(spark, sf_dir):
    ranked, bounds = _leaf_suggestions(spark, sf_dir)
    d = splits.should_split(ranked, bounds, ["l_linestatus"])
    return d.select("l_linestatus", "best_feature", "split")


@register("poor_features")
def q_poor_features(spark, sf_dir):
    """Class = line status, the whole table as one leaf: of the six features (one of them the
    status itself), those far behind the best."""
    ex = _line_examples(spark, sf_dir).withColumn("label", F.col("f_status").cast("int"))
    g = observers.gaussian_stats(_numeric_long(ex))
    num = observers.gaussian_split_weights(g, observers.split_points(g)).select(
        "feature", F.col("point_idx").alias("cand"), "branch", "label", "w")
    nom = observers.nominal_binary_splits(observers.nominal_stats(_nominal_long(ex))).select(
        (F.col("feature") + 4).alias("feature"), F.col("split_value").cast("int").alias("cand"), "branch", "label", "w")
    m = splits.info_gain(num.unionByName(nom), ["feature", "cand"]).withColumn("leaf", F.lit(0))
    best = splits.best_split_per_feature(m, ["leaf", "feature"], ["cand"])
    leaves = ex.agg(F.count(F.lit(1)).cast("double").alias("weight")).withColumn("leaf", F.lit(0))
    ranked = splits.rank_split_suggestions(best, ["leaf"], leaves.select("leaf", F.lit(float("-inf")).alias("merit")))
    return splits.poor_features(ranked, splits.hoeffding_bound(leaves, "weight", "info_gain", 2), ["leaf"])


# ------------------------------------------------------------------ naive Bayes

def _labelled_tf(spark, sf_dir, docs=None) -> DataFrame:
    docs = docs if docs is not None else table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # only labelled documents are tokenized (semi-join before the word counts)
    size = input_bytes(docs)
    lab = spread(lab, "doc_id", size=size)
    docs = spread(docs.select("doc_id", "text"), "doc_id", size=size).join(lab.select("doc_id"), "doc_id", "left_semi")
    tf = vec.word_counts(docs, "doc_id", "text", "tf", dealt=True)
    return tf.join(lab, "doc_id")


def _nb_table(model: bayes.NBModel) -> DataFrame:
    counts = model.class_counts.select("label", F.lit(None).cast("string").alias("feature"),
                                       F.col("n").alias("mass"))
    return model.feature_sums.select("label", "feature", "mass").unionByName(counts)


@register("nb_train")
def q_nb_train(spark, sf_dir):
    return _nb_table(bayes.nb_train(_labelled_tf(spark, sf_dir), "tf"))


@register("nb_merge")
def q_nb_merge(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a = bayes.nb_train(_labelled_tf(spark, sf_dir, docs.filter(F.col("lang") == "en")), "tf")
    b = bayes.nb_train(_labelled_tf(spark, sf_dir, docs.filter(~F.col("lang").eqNullSafe("en"))), "tf")
    return _nb_table(bayes.nb_merge(a, b))


@register("nb_params")
def q_nb_params(spark, sf_dir):
    pri, cond_t = bayes.nb_params(bayes.nb_train(_labelled_tf(spark, sf_dir), "tf"))
    p = pri.select("label", F.lit(None).cast("string").alias("feature"),
                   F.round("log_prior", 9).alias("log_p"))
    c = cond_t.select("label", "feature", F.round("log_cond", 9).alias("log_p"))
    return c.unionByName(p)


@register("nb_predict")
def q_nb_predict(spark, sf_dir):
    model = bayes.nb_train(_labelled_tf(spark, sf_dir), "tf")
    tf_all = vec.word_counts(table(spark, sf_dir, "documents"), "doc_id", "text", "tf")
    return bayes.nb_predict(model, tf_all, ["doc_id"], "tf")


@register("nb_prequential")
def q_nb_prequential(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    st = li.select(*LINE_ORDER, "l_shipdate",
                   F.when(F.col("l_linestatus") == "F", F.lit("EXAMPLE")).otherwise(F.lit("QUERY"))
                   .alias("cmd"),
                   F.col("l_quantity").alias("a"), F.round(F.col("l_discount") * 100).alias("b"),
                   F.round(F.col("l_tax") * 100).alias("c"),
                   code_nominal("l_returnflag", RETURNFLAG_DOMAIN).cast("int").alias("label"))
    out = bayes.nb_prequential(st, ["a", "b", "c"], "label", "cmd", ["l_shipdate", *LINE_ORDER],
                               classes=[0, 1, 2])
    return out.filter(F.col("cmd") == "QUERY").select(*LINE_ORDER, "prediction")


@register("nb_prequential_words")
def q_nb_prequential_words(spark, sf_dir):
    """F5 on word counts: in the order of their ids, labelled documents are examples and the others queries."""
    docs = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = vec.word_counts(docs, "doc_id", "text", "tf").join(spread(lab, "doc_id", size=input_bytes(docs)), "doc_id", "left").withColumn(
        "cmd", F.when(F.col("label").isNotNull(), "EXAMPLE").otherwise("QUERY"))
    out = bayes.nb_prequential_entries(rows, ["doc_id"], "tf", "label", "cmd", ["doc_id"], classes=[0, 1])
    return out.filter(F.col("prediction").isNotNull())


def _observer_votes(spark, sf_dir, log10: bool) -> DataFrame:
    ex = _line_examples(spark, sf_dir)
    g = observers.gaussian_stats(_numeric_long(ex))
    nstat = observers.nominal_stats(_nominal_long(ex)).withColumn("feature", F.col("feature") + 4)
    cw = ex.groupBy("label").agg(F.count(F.lit(1)).cast("double").alias("w"))
    sizes = {4 + k: v for k, v in NOMINAL_SIZES.items()}
    return bayes.observer_nb_votes(ex, LINE_ORDER, g, nstat, cw, NUMERIC_FEATURES, NOMINAL_FEATURES,
                                   log10=log10, nominal_sizes=sizes)


@register("observer_nb_votes")
def q_observer_nb_votes(spark, sf_dir):
    from pyspark.sql import Window

    v = _observer_votes(spark, sf_dir, False)
    post = F.col("vote") / F.sum("vote").over(Window.partitionBy(*LINE_ORDER))
    return v.select(*LINE_ORDER, "label", F.round(post, 6).alias("posterior"))


@register("observer_nb_log_votes")
def q_observer_nb_log_votes(spark, sf_dir):
    v = _observer_votes(spark, sf_dir, True)
    return v.select(*LINE_ORDER, "label", F.round("log_vote", 6).alias("log_vote"))


# ------------------------------------------------------------------ ensemble / table helpers

from driftwood.operators import ensemble, statistics  # noqa: E402


@register("majority_vote")
def q_majority_vote(spark, sf_dir):
    ex = _line_examples(spark, sf_dir).select("l_orderkey", F.col("label").alias("vote"))
    return ensemble.majority_vote(ex, ["l_orderkey"], "vote")


@register("poisson_weights")
def q_poisson_weights(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    return ensemble.poisson_weights(li, 1.0, LINE_ORDER, seed=1)


@register("normalize_counts")
def q_normalize_counts(spark, sf_dir):
    ex = table(spark, sf_dir, "lineitem")
    cnt = ex.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).cast("double").alias("n"))
    out = ensemble.normalize_counts(cnt, "n", ["l_suppkey"])
    return out.select("l_suppkey", "l_returnflag", F.round("fraction", 9).alias("fraction"))


@register("crosstab")
def q_crosstab(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return ensemble.crosstab(li, "l_returnflag", "l_linestatus", LINESTATUS_DOMAIN)


@register("crosstab_transpose")
def q_crosstab_transpose(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return ensemble.crosstab(li, "l_linestatus", "l_returnflag", RETURNFLAG_DOMAIN)


@register("one_vs_rest")
def q_one_vs_rest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    dist = li.groupBy("l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).cast("double").alias("w"))
    return ensemble.one_vs_rest(dist, "l_linestatus", "l_returnflag")


@register("save_load_model")
def q_save_load_model(spark, sf_dir):
    from driftwood.session import scratch_path

    model = bayes.nb_train(_labelled_tf(spark, sf_dir), "tf")
    path = scratch_path(spark, "nb-model")
    ensemble.save_model({"class_counts": model.class_counts, "feature_sums": model.feature_sums},
                        path)
    loaded = ensemble.load_model(spark, path, ["class_counts", "feature_sums"])
    return _nb_table(bayes.NBModel(loaded["class_counts"], loaded["feature_sums"]))


@register("add_arrays")
def q_add_arrays(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    s = ensemble.add_arrays(e, "embedding", ["label"], "vec_sum")
    return s.select("label", F.transform("vec_sum", lambda x: F.round(x, 6)).alias("vec_sum"))


# ------------------------------------------------------------------ statistics (K1-K4)

@register("accuracy_with_error")
def q_accuracy_with_error(spark, sf_dir):
    pred = q_nb_predict(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = pred.join(lab, "doc_id").join(docs, "doc_id")
    out = statistics.accuracy_with_error(j, "prediction", "quality", ["lang"])
    return out.select("lang", F.round("accuracy", 9).alias("accuracy"), "n",
                      F.round("std_error", 9).alias("std_error"))


@register("gaussian_tail")
def q_gaussian_tail(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    out = statistics.gaussian_tail(ev, "value", ["event_type"])
    return out.select("event_id", F.round("z", 6).alias("z"), F.round("cdf", 6).alias("cdf"))


@register("chi_square_test")
def q_chi_square_test(spark, sf_dir):
    out = statistics.chi_square_test(_nominal_long(_line_examples(spark, sf_dir)))
    return out.select("feature", F.round("statistic", 6).alias("statistic"), "dof",
                      F.round("p_value", 9).alias("p_value"))


@register("anova_f_test")
def q_anova_f_test(spark, sf_dir):
    out = statistics.anova_f_test(_numeric_long(_line_examples(spark, sf_dir)))
    return out.select("feature", F.round("f_stat", 6).alias("f_stat"), "df_between", "df_within",
                      F.round("p_value", 9).alias("p_value"))


# ------------------------------------------------------------------ Hoeffding tree

from driftwood.operators.tree import HoeffdingTree  # noqa: E402

TREE_FEATURES = NUMERIC_FEATURES + NOMINAL_FEATURES
TREE_NOMINAL = {4: 2, 5: 7}
#: Rows of a training block: the number of blocks, so of split attempts, grows with the table.
TREE_ROWS_PER_BLOCK = 8_000
#: Command lines of an epoch of ``ht_stream``.
TREE_ROWS_PER_EPOCH = 16_000
#: Epochs of the first micro-batch of ``ht_stream``; the next holds twice as many, and so on.
TREE_EPOCHS_PER_BATCH = 256


def _tree(leaf_type="majority", split_all=False) -> HoeffdingTree:
    return HoeffdingTree(TREE_FEATURES, 3, nominal=TREE_NOMINAL, grace=200, leaf_type=leaf_type, split_all=split_all)


def _trained_tree(spark, sf_dir, leaf_type="majority", split_all=False) -> HoeffdingTree:
    """Train on lineitem in line-key order."""
    return _tree(leaf_type, split_all).fit(_line_examples(spark, sf_dir), LINE_ORDER, rows_per_block=TREE_ROWS_PER_BLOCK)


def _nodes(ht: HoeffdingTree, spark) -> DataFrame:
    n = ht.nodes_df(spark)
    return n.select("node_id", "parent_id", "branch", "depth", "kind", "feature", "test",
                    F.round("value", 6).alias("value"),
                    F.transform("class_dist", lambda x: F.round(x, 6)).alias("class_dist"))


@register("ht_route")
def q_ht_route(spark, sf_dir):
    ht = _trained_tree(spark, sf_dir)
    return ht.with_leaf(_line_examples(spark, sf_dir)).select(*LINE_ORDER, "leaf")


@register("ht_block_stats")
def q_ht_block_stats(spark, sf_dir):
    """H2 over the whole table routed through the trained tree."""
    ht = _trained_tree(spark, sf_dir)
    cd, g, n = ht.block_stats(_line_examples(spark, sf_dir))
    return g.select("leaf", "feature", "label", "n", F.round("mean", 6).alias("mean"),
                    F.round("m2", 3).alias("m2"), "min", "max")


@register("ht_merge")
def q_ht_merge(spark, sf_dir):
    """H3: the root's statistics after merging the blocks one by one."""
    ht = _trained_tree_without_growth(spark, sf_dir)
    g, _ = ht.stats_frames(spark)
    return g.select("feature", "label", "n", F.round("mean", 6).alias("mean"), F.round("m2", 3).alias("m2"), "min", "max")


def _trained_tree_without_growth(spark, sf_dir) -> HoeffdingTree:
    ht = _tree()
    ht.grow = False
    return ht.fit(_line_examples(spark, sf_dir), LINE_ORDER, rows_per_block=TREE_ROWS_PER_BLOCK)


@register("ht_deactivate")
def q_ht_deactivate(spark, sf_dir):
    """H6: the only feature is constant, so "do not split" wins and the leaf is closed."""
    ex = _line_examples(spark, sf_dir).where("l_linestatus = 'F'")
    ht = HoeffdingTree(["f_status"], 3, nominal={0: 2}, grace=200)
    ht.fit(ex, LINE_ORDER, rows_per_block=max(1, ex.count()), id_cols=LINE_ORDER)
    return ht.nodes_df(spark).select("node_id", "kind", "class_dist")


@register("ht_train")
def q_ht_train(spark, sf_dir):
    return _nodes(_trained_tree(spark, sf_dir), spark)


@register("ht_attempt_split_all")
def q_ht_attempt_split_all(spark, sf_dir):
    return _nodes(_trained_tree(spark, sf_dir, split_all=True), spark)


@register("ht_predict")
def q_ht_predict(spark, sf_dir):
    return _trained_tree(spark, sf_dir).predict(_line_examples(spark, sf_dir), LINE_ORDER)


@register("ht_predict_nb")
def q_ht_predict_nb(spark, sf_dir):
    return _trained_tree(spark, sf_dir, "nb").predict(_line_examples(spark, sf_dir), LINE_ORDER)


@register("ht_save_load")
def q_ht_save_load(spark, sf_dir):
    """The trained tree's tables, saved and read into another tree, which then predicts."""
    trained, path = _trained_tree(spark, sf_dir, "nb").model_tables(spark), scratch_path(spark, "ht-model")
    ensemble.save_model(trained, path)
    loaded = _tree("nb").load_tables(ensemble.load_model(spark, path, list(trained)))
    return loaded.predict(_line_examples(spark, sf_dir), LINE_ORDER)


@register("ht_predict_adaptive")
def q_ht_predict_adaptive(spark, sf_dir):
    return _trained_tree(spark, sf_dir, "adaptive").predict(_line_examples(spark, sf_dir), LINE_ORDER)


@register("ht_rules")
def q_ht_rules(spark, sf_dir):
    return _trained_tree(spark, sf_dir).rules(spark)


@register("ht_shape")
def q_ht_shape(spark, sf_dir):
    return _trained_tree(spark, sf_dir).shape(spark)


@register("ht_pure_leaves")
def q_ht_pure_leaves(spark, sf_dir):
    return _trained_tree(spark, sf_dir).pure_leaves(spark)


# ------------------------------------------------------------------ linear models

import math as _math  # noqa: E402

from driftwood.operators import linear  # noqa: E402

# The parameter vector used by the linear-model queries
# (64 feature weights sin(i+1)/4, bias 0.1 last).
LINEAR_W0 = [_math.sin(i + 1) / 4.0 for i in range(64)] + [0.1]


def _emb_binary(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding",
                    F.when(F.col("label") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("y"))


def _dot(spark, sf_dir) -> DataFrame:
    e = _emb_binary(spark, sf_dir)
    return e.select("vec_id", "y", linear.linear_score("embedding", LINEAR_W0).alias("dot"))


@register("linear_score")
def q_linear_score(spark, sf_dir):
    return _dot(spark, sf_dir).select("vec_id", F.round("dot", 6).alias("score"))


@register("linear_predict")
def q_linear_predict(spark, sf_dir):
    d = _dot(spark, sf_dir)
    return d.select("vec_id", linear.linear_predict("dot", "squared").alias("pred_squared"),
                    linear.linear_predict("dot", "logistic").alias("pred_logistic"))


@register("linear_loss")
def q_linear_loss(spark, sf_dir):
    d = _dot(spark, sf_dir)
    return d.select("vec_id", *[F.round(linear.linear_loss("y", "dot", k), 9).alias(f"loss_{k}")
                                for k in linear.LOSSES])


@register("linear_prob")
def q_linear_prob(spark, sf_dir):
    d = _dot(spark, sf_dir)
    return d.select("vec_id", *[F.round(linear.linear_prob("dot", k), 9).alias(f"prob_{k}")
                                for k in ("squared", "hinge", "logistic")])


@register("linear_gradient")
def q_linear_gradient(spark, sf_dir):
    e = _emb_binary(spark, sf_dir)
    parts = [linear.linear_gradient(e, "embedding", "y", LINEAR_W0, k)
             .select(F.lit(k).alias("loss"), "index", F.round("grad", 6).alias("grad"))
             for k in linear.LOSSES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("regularize")
def q_regularize(spark, sf_dir):
    g = linear.linear_gradient(_emb_binary(spark, sf_dir), "embedding", "y", LINEAR_W0, "squared")
    return g.select("index", *[F.round(linear.regularize("grad", k), 6).alias(f"reg_{k}")
                               for k in ("l1", "l2", "zero")])


@register("linear_update")
def q_linear_update(spark, sf_dir):
    g = linear.linear_gradient(_emb_binary(spark, sf_dir), "embedding", "y", LINEAR_W0, "squared")
    w = spark.createDataFrame(list(enumerate(LINEAR_W0)), "index int, weight double")
    out = linear.linear_update(w, g, scale=0.01)
    return out.select("index", F.round("weight", 6).alias("weight"))


@register("linear_train")
def q_linear_train(spark, sf_dir):
    w = linear.linear_train(_emb_binary(spark, sf_dir), "embedding", "y", 64, loss="squared",
                            steps=3, learning_rate=0.1, reg="l2", reg_param=0.01, init=LINEAR_W0)
    df = spark.createDataFrame(list(enumerate(w)), "index int, weight double")
    return df.select("index", F.round("weight", 6).alias("weight"))


# ------------------------------------------------------------------ membership and search

from driftwood.operators import membership, substring  # noqa: E402

BLOOM_FPP = 0.01


def _machinery(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "MACHINERY")


@register("bloom_build")
def q_bloom_build(spark, sf_dir):
    members = _machinery(spark, sf_dir)
    return membership.bloom_build(members, "c_custkey", membership.distinct_values(members, "c_custkey"), BLOOM_FPP)


@register("bloom_probe")
def q_bloom_probe(spark, sf_dir):
    members = _machinery(spark, sf_dir)
    n = membership.distinct_values(members, "c_custkey")
    bits = membership.bloom_build(members, "c_custkey", n, BLOOM_FPP)
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    return membership.bloom_probe(bits, cust, "c_custkey", ["c_custkey"], n, BLOOM_FPP)


@register("bloom_probe_asof")
def q_bloom_probe_asof(spark, sf_dir):
    """Data = order customers arriving in order-key order; query c arrives at 40 * c."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") * 40).alias("q_seq"))
    return membership.bloom_probe_asof(orders, "o_custkey", "o_orderkey", cust, "c_custkey", "q_seq",
                                       ["c_custkey"], membership.distinct_values(orders, "o_custkey"), BLOOM_FPP)


def _finished(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@register("bloom_probe_blocks")
def q_bloom_probe_blocks(spark, sf_dir):
    """D2 on a blocked filter: order lines against the finished orders."""
    n = membership.distinct_values(_finished(spark, sf_dir), "o_orderkey")
    bits = membership.bloom_build(_finished(spark, sf_dir), "o_orderkey", n, BLOOM_FPP, blocked=True)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    return membership.bloom_probe(bits, lines, "l_orderkey", LINE_ORDER, n, BLOOM_FPP).drop("answer")


@register("bloom_probe_asof_blocks")
def q_bloom_probe_asof_blocks(spark, sf_dir):
    """D3 on a blocked filter: was a line's part ordered under a smaller order key?"""
    data = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_partkey")
    return membership.bloom_probe_asof(data, "l_partkey", "l_orderkey", data, "l_partkey", "l_orderkey", LINE_ORDER,
                                       membership.distinct_values(data, "l_partkey"), BLOOM_FPP, blocked=True).drop("answer")


SUBSTRING_Q = 4


@register("substring_index")
def q_substring_index(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark")
    return substring.substring_index(bench, "item_id", "text", SUBSTRING_Q)


@register("substring_search")
def q_substring_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    idx = substring.substring_index(docs, "doc_id", "text", SUBSTRING_Q)
    bench = table(spark, sf_dir, "benchmark")
    hits = substring.substring_search(idx, docs, "doc_id", "text", bench, ["item_id"], "text",
                                      SUBSTRING_Q)
    return hits.select("item_id", F.col("id").alias("doc_id"))


@register("substring_search_asof")
def q_substring_search_asof(spark, sf_dir):
    """A benchmark item arriving at 25 * item_id sees documents with a smaller doc_id."""
    docs = table(spark, sf_dir, "documents")
    idx = substring.substring_index(docs, "doc_id", "text", SUBSTRING_Q)
    bench = table(spark, sf_dir, "benchmark").withColumn("q_seq", F.col("item_id") * 25)
    hits = substring.substring_search(idx, docs, "doc_id", "text", bench, ["item_id"], "text",
                                      SUBSTRING_Q, doc_seq="doc_id", query_seq="q_seq")
    return hits.select("item_id", F.col("id").alias("doc_id"))


@register("substring_search_words")
def q_substring_search_words(spark, sf_dir):
    """Word queries (every distinct word of the conversations' texts, short ones included)
    against the benchmark texts: (word, item_id) pairs."""
    conv = table(spark, sf_dir, "conversations")
    words = conv.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    bench = table(spark, sf_dir, "benchmark")
    idx = substring.substring_index(bench, "item_id", "text", SUBSTRING_Q)
    hits = substring.substring_search(idx, bench, "item_id", "text", words, ["word"], "word",
                                      SUBSTRING_Q)
    return hits.select("word", F.col("id").alias("item_id"))


# ------------------------------------------------------------------ formats

from driftwood.session import scratch_path  # noqa: E402
from driftwood.sources import arff  # noqa: E402

LINE_ARFF = arff.ArffSpec("lineitem", [
    *[arff.Attribute(c) for c in LINE_ORDER + NUMERIC_FEATURES],
    arff.Attribute("f_status", LINESTATUS_DOMAIN),
    arff.Attribute("f_line", [str(i) for i in range(7)]),
    arff.Attribute("class", RETURNFLAG_DOMAIN)])
LENGTH_ARFF = arff.ArffSpec("documents", [arff.Attribute("doc_id"), *[arff.Attribute(f"n{i}") for i in range(1, 65)],
                                          arff.Attribute("words")])


def _line_arff_path(spark, sf_dir) -> str:
    ex = _line_examples(spark, sf_dir)
    path = scratch_path(spark, "lineitem-arff")
    arff.write_arff(ex, path, LINE_ARFF, [*LINE_ORDER, *NUMERIC_FEATURES, "f_status", "f_line", "label"])
    return path


@register("read_arff")
def q_read_arff(spark, sf_dir):
    return arff.read_arff(spark, _line_arff_path(spark, sf_dir), nominal_class=True)


@register("read_arff_spec")
def q_read_arff_spec(spark, sf_dir):
    """A2: the header given in memory, the data read without looking for one."""
    spec = arff.parse_arff_header(arff.arff_header(LINE_ARFF), nominal_class=True)
    return arff.read_arff(spark, _line_arff_path(spark, sf_dir), spec=spec)


@register("write_arff")
def q_write_arff(spark, sf_dir):
    """The written lines (header file + data files) read back as text."""
    path = _line_arff_path(spark, sf_dir)
    return spark.read.text(f"{path}/header").unionByName(spark.read.text(f"{path}/data"))


@register("read_arff_sparse")
def q_read_arff_sparse(spark, sf_dir):
    """Word counts by length (most are 0) written as sparse rows and read back."""
    path = scratch_path(spark, "word-lengths-arff")
    own = _word_lengths(spark, sf_dir)
    cols = [F.coalesce(F.try_element_at("a", F.lit(i)), F.lit(0.0)).alias(f"n{i}") for i in range(1, 65)]
    wide = own.select(F.col("doc_id").cast("double").alias("doc_id"), *cols, F.aggregate(
        F.map_values("a"), F.lit(0.0), lambda s, x: s + x).alias("words"))
    arff.write_arff(wide, path, LENGTH_ARFF, wide.columns, sparse=True)
    return arff.read_arff(spark, path)


@register("read_examples")
def q_read_examples(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "emb-examples")
    e.select(arff.example_line(F.col("label"), F.col("embedding"), F.lit(1.0)).alias("value")) \
        .write.text(path)
    return arff.read_examples(spark, path)


@register("read_examples_sparse")
def q_read_examples_sparse(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    sp = vec.dense_to_map(F.col("embedding"))
    path = scratch_path(spark, "emb-examples-sparse")
    e.select(arff.example_line(F.col("label"), sp, kind="sparse").alias("value")).write.text(path)
    r = arff.read_examples(spark, path, kind="sparse")
    return r.select("label", F.explode("features").alias("index", "value"), "weight")


@register("read_text_features")
def q_read_text_features(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cnt = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    lines = cnt.groupBy("user_id").agg(F.concat_ws(",", F.collect_list(
        F.concat("event_type", F.lit(":"), F.col("n").cast("string")))).alias("_l"))
    lines = lines.select(F.concat(F.lit("user:"), F.col("user_id").cast("string"), F.lit(","),
                                  "_l").alias("value"))
    path = scratch_path(spark, "text-features")
    lines.write.text(path)
    r = arff.read_text_features(spark, path)
    return r.select(F.explode("features").alias("key", "value"))


# ------------------------------------------------------------------ streams

from driftwood.operators import dataflow  # noqa: E402
from driftwood.sources import sinks as stream_sinks  # noqa: E402
from driftwood.streaming import keyed as stream_keyed  # noqa: E402
from driftwood.streaming import learners as stream_learners  # noqa: E402
from driftwood.streaming import ordered as stream_ordered  # noqa: E402
from driftwood.streaming import runner  # noqa: E402

STREAM_FILES = 4


def _stream_through(spark, df: DataFrame, order_cols, step, name: str) -> DataFrame:
    """Stage ``df`` as files in order ranges, stream them one per micro-batch."""
    staged = runner.stage_files(df, order_cols, STREAM_FILES, name + "-src")
    r = runner.StatefulBatches(spark, step, name, file_batches=True)
    return runner.run_file_stream(spark, staged, df.schema, r)


@register("running_max_subarray_stream")
def q_running_max_subarray_stream(spark, sf_dir):
    ev = _event_ints(spark, sf_dir)
    out = _stream_through(spark, ev, EVENT_ORDER,
                          stream_ordered.kadane_step("x", EVENT_ORDER, ["user_id"]), "kadane")
    return out.select("user_id", "event_id", "x", "max_ending_here", "max_subarray")


@register("running_max_subarray_keyed_stream")
def q_running_max_subarray_keyed_stream(spark, sf_dir):
    """C4 with the users' states in Spark's state store."""
    ev = _event_ints(spark, sf_dir)
    path, files = runner.stage_files(ev, EVENT_ORDER, STREAM_FILES, "kadane-keyed-src")
    out, stream = scratch_path(spark, "kadane-keyed"), spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files).parquet(path)
    rows = stream_keyed.running_max_subarray(stream, "x", EVENT_ORDER, ["user_id"])
    stream_sinks.start_sink(rows, "parquet", path=out, checkpoint=scratch_path(spark, "kadane-keyed-ckpt")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).select("user_id", "event_id", "x", "max_ending_here", "max_subarray")


@register("zip_stream")
def q_zip_stream(spark, sf_dir):
    """B3 on two live inputs: line quantities and order totals, each from its own folder and at its own rate."""
    x = table(spark, sf_dir, "lineitem").select(F.lit("x").alias("side"), *[F.col(c).cast("bigint").alias(f"k{i}") for i, c in enumerate(LINE_ORDER)],
                                                F.col("l_quantity").alias("v"))
    none = F.lit(0).cast("bigint")
    y = table(spark, sf_dir, "orders").select(F.lit("y").alias("side"), F.col("o_orderkey").alias("k0"), none.alias("k1"), none.alias("k2"),
                                              none.alias("k3"), F.col("o_totalprice").alias("v"))
    order = [f"k{i}" for i in range(4)]
    streams = []
    for name, df, epochs in (("x", x, STREAM_FILES), ("y", y, STREAM_FILES + 1)):
        path, files = runner.stage_files(df, order, epochs, f"zip-{name}-src")
        streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path))
    run = runner.StatefulBatches(spark, stream_ordered.zip_step("side", "x", "y", order, append=True), "zip-stream",
                                 append_state=True, file_batches=True)
    stream_sinks.start_sink(dataflow.merge_streams(*streams), "foreach_batch", batch_fn=run,
                            checkpoint=scratch_path(spark, "zip-stream-ckpt")).awaitTermination()
    return run.output().select("pos", F.col("x.v").alias("l_quantity"), F.col("y.v").alias("o_totalprice"))


@register("rls_stream")
def q_rls_stream(spark, sf_dir):
    out = _stream_through(spark, _line_xy(spark, sf_dir), LINE_ORDER,
                          stream_ordered.rls_step("x", "y", LINE_ORDER), "rls")
    return out.select(*LINE_ORDER, "theta", F.round("weight", 6).alias("weight"),
                      F.round("prediction", 6).alias("prediction"))


@register("follow_the_leader_stream")
def q_follow_the_leader_stream(spark, sf_dir):
    out = _stream_through(spark, _line_ftl(spark, sf_dir), LINE_ORDER,
                          stream_ordered.ftl_step("x", "y", LINE_ORDER), "ftl")
    return out.select(*LINE_ORDER, "leader", "prediction")


# ------------------------------------------------------------------ streams

from driftwood.sources import commands, sinks, tail  # noqa: E402
from driftwood.streaming import membership as stream_membership  # noqa: E402
from driftwood.streaming import substring as stream_substring  # noqa: E402
from driftwood.streaming import tree as stream_tree  # noqa: E402


@register("bloom_stream")
def q_bloom_stream(spark, sf_dir):
    """Order customers (data, arriving by order key) and all customers (queries,
    arriving at 40 * key) merged into one stream sharing one filter."""
    data = table(spark, sf_dir, "orders").select(F.lit("data").alias("kind"),
                                                 F.col("o_orderkey").alias("seq"),
                                                 F.col("o_custkey").alias("value"))
    qs = table(spark, sf_dir, "customer").select(F.lit("query").alias("kind"),
                                                 (F.col("c_custkey") * 40).alias("seq"),
                                                 F.col("c_custkey").alias("value"))
    merged = dataflow.merge_streams(data, qs)
    n = membership.distinct_values(table(spark, sf_dir, "orders"), "o_custkey")
    staged = runner.stage_files(merged, ["seq", "kind"], STREAM_FILES, "bloom-src")
    run = runner.StatefulBatches(spark, stream_membership.bloom_step(n=n, fpp=BLOOM_FPP, append=True), "bloom", append_state=True,
                                 merge=stream_membership.earliest)
    out = runner.run_file_stream(spark, staged, merged.schema, run)
    return out.filter(F.col("kind") == "query").select(
        F.col("value").alias("c_custkey"), "maybe", "answer")


NB_ROWS_PER_EPOCH = 400
LINEAR_ROWS_PER_EPOCH = 125
#: Epochs of the first micro-batch of ``nb_stream`` and ``linear_stream``; the next holds twice as many, and so on.
LEARNER_EPOCHS_PER_BATCH = 256


@register("nb_stream")
def q_nb_stream(spark, sf_dir):
    """F1, F2, F4 test-then-train: every document is answered by the labelled documents of earlier epochs."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = vec.word_counts(table(spark, sf_dir, "documents"), "doc_id", "text", "tf").join(lab, "doc_id", "left")
    staged = runner.stage_files(written(rows, "nb-stream-rows"), ["doc_id"], None, "nb-stream-src", rows_per_epoch=NB_ROWS_PER_EPOCH,
                                first_run=LEARNER_EPOCHS_PER_BATCH)
    step = stream_learners.nb_step(["doc_id"], "tf", order_cols=["doc_id"], rows_per_epoch=NB_ROWS_PER_EPOCH)
    return runner.run_file_stream(spark, staged, rows.schema, runner.StatefulBatches(spark, step, "nb-stream", file_batches=True)).drop("epoch")


@register("linear_stream")
def q_linear_stream(spark, sf_dir):
    """I2, I8 test-then-train: one gradient step an epoch, vectors arriving by id."""
    rows = _emb_binary(spark, sf_dir)
    step = stream_learners.linear_step(["vec_id"], "embedding", "y", 64, learning_rate=0.1, reg="l2", reg_param=0.01, init=LINEAR_W0,
                                       order_cols=["vec_id"], rows_per_epoch=LINEAR_ROWS_PER_EPOCH)
    staged = runner.stage_files(rows, ["vec_id"], None, "linear-stream-src", rows_per_epoch=LINEAR_ROWS_PER_EPOCH,
                                first_run=LEARNER_EPOCHS_PER_BATCH)
    out = runner.run_file_stream(spark, staged, rows.schema, runner.StatefulBatches(spark, step, "linear-stream", file_batches=True))
    return out.select("vec_id", F.round("score", 6).alias("score"), "prediction")


@register("substring_search_stream")
def q_substring_search_stream(spark, sf_dir):
    """Documents (strings, arriving by doc id) and benchmark items (queries,
    arriving at 25 * item id) on one stream."""
    docs = table(spark, sf_dir, "documents").select(
        F.lit("string").alias("kind"), F.col("doc_id").alias("seq"), F.col("doc_id").alias("id"),
        "text")
    qs = table(spark, sf_dir, "benchmark").select(
        F.lit("query").alias("kind"), (F.col("item_id") * 25).alias("seq"),
        F.col("item_id").alias("id"), "text")
    merged = docs.unionByName(qs)
    path = runner.stage_files(merged, ["seq", "kind"], STREAM_FILES, "substring-src")
    r = runner.StatefulBatches(spark, stream_substring.substring_step(), "substring",
                               append_state=True, partition_by=stream_substring.PARTITIONS, file_batches=True, split_by="id")
    out = runner.run_file_stream(spark, path, merged.schema, r)
    return out.select(F.col("q_id").alias("item_id"), F.col("id").alias("doc_id"))


@register("ht_stream")
def q_ht_stream(spark, sf_dir):
    """Command lines (EXAMPLE for finished lines, QUERY for open ones) written as
    files, read as a text stream (A6) in epochs of as many lines by position, dispatched (B5); each
    epoch's queries are answered by the tree so far, then its examples are learned (H12).  A micro-batch
    takes a run of epochs."""
    ex = _line_examples(spark, sf_dir)
    cmds = dataflow.tag_commands(ex, "EXAMPLE").withColumn(
        "cmd", F.when(F.col("l_linestatus") == "F", F.lit("EXAMPLE")).otherwise(F.lit("QUERY")))
    cols = [*LINE_ORDER, *NUMERIC_FEATURES, "f_status", "f_line", "label"]
    lines = cmds.select(*LINE_ORDER, commands.command_line(
        F.col("cmd"), arff.arff_dense_line(cmds, LINE_ARFF, cols)).alias("value"))
    staged, files = runner.stage_files(lines, LINE_ORDER, None, "ht-cmd", text="value", rows_per_epoch=TREE_ROWS_PER_EPOCH,
                                       first_run=TREE_EPOCHS_PER_BATCH)
    stream = commands.read_command_stream(spark, staged, LINE_ARFF, max_files_per_trigger=files)
    ht = HoeffdingTree(TREE_FEATURES, 3, nominal=TREE_NOMINAL, grace=200)
    step = stream_tree.tree_step(ht, LINE_ORDER, LINE_ORDER, rows_per_epoch=TREE_ROWS_PER_EPOCH)
    r = runner.StatefulBatches(spark, step, "ht-stream", file_batches=True)
    q = (stream.writeStream.foreachBatch(r).option("checkpointLocation",
                                                   scratch_path(spark, "ht-stream-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return r.output().select(*LINE_ORDER, "prediction")


@register("tail_commands")
def q_tail_commands(spark, sf_dir):
    """Order commands in growing files, tailed by byte offset into a parquet sink."""
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(";", F.when(F.col("o_orderstatus") == "F", "EXAMPLE").otherwise("QUERY"), F.concat_ws(
        ",", "o_orderkey", "o_custkey", "o_orderpriority")).alias("value"))
    source, out = scratch_path(spark, "order-commands"), scratch_path(spark, "order-commands-out")
    lines.write.text(source)
    stream = tail.tail_lines(spark, source, piece_bytes=1 << 18)
    parts = F.split(F.substring_index("value", ";", -1), ",")
    rows = stream.select(F.substring_index("value", ";", 1).alias("cmd"), parts[0].cast("bigint").alias("o_orderkey"),
                         parts[1].cast("bigint").alias("o_custkey"), parts[2].alias("o_orderpriority"))
    sinks.start_sink(rows, "parquet", path=out, checkpoint=scratch_path(spark, "order-commands-ckpt")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@register("dispatch_commands")
def q_dispatch_commands(spark, sf_dir):
    """Tag orders by status, merge, dispatch; per route the row count."""
    od = table(spark, sf_dir, "orders")
    ex = dataflow.tag_commands(od.filter(F.col("o_orderstatus") == "F"), "EXAMPLE")
    qu = dataflow.tag_commands(od.filter(F.col("o_orderstatus") == "O"), "QUERY")
    other = dataflow.tag_commands(od.filter(~F.coalesce(F.col("o_orderstatus").isin("F", "O"), F.lit(False))), "NOOP")
    merged = dataflow.merge_streams(dataflow.merge_streams(ex, qu), other)
    e, q, o = dataflow.dispatch_commands(merged)
    return (e.select(F.lit("EXAMPLE").alias("route"), "o_orderkey")
            .unionByName(q.select(F.lit("QUERY").alias("route"), "o_orderkey"))
            .unionByName(o.select(F.lit("OTHER").alias("route"), "o_orderkey")))


@register("weighted_examples")
def q_weighted_examples(spark, sf_dir):
    """weight = label / 10, a derived label column, feature 0 set to -1."""
    e = table(spark, sf_dir, "embeddings")
    w = dataflow.with_weight(e, F.col("label") / 10.0)
    w = dataflow.with_feature(w, "embedding", 0, -1.0)
    w = dataflow.with_label(w, F.col("label") + 1, "label2")
    return w.select("vec_id", "weight", "label2", F.col("embedding")[0].alias("f0"))

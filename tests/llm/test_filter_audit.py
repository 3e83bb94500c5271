import re
from collections import defaultdict
from itertools import permutations

from driftwood.llm import filter_audit

BIG = "Lorem ipsum dolor " + " ".join(f"w{k}" for k in range(60))
TEXTS = [BIG, BIG, BIG + " $", "a b c", None, "", "", "x y " * 40, "SHOUT " * 60, "A" * 200, " ".join(f"Q{k}" for k in range(80)),
         "é " * 70, "word " * 100_000, BIG + " &", "tab\tnew\nline\x0bvt\x85nel", "ÀÉÎ up"]


def checks(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
             "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": re.search(r"[#$%&*|]", text) is not None, "E": copy}
    return {k for k, v in fails.items() if v}


def brute(rows, labels):
    """Every order run step by step over every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = defaultdict(list)
    for i, text, source in rows:
        copy = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in rows)
        docs[source or ""].append((i, checks(text or "", copy)))
    out = {}
    for part, members in docs.items():
        removals = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removals[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in m for _, m in members) - len(gone),
                                                   sum(m == {f} for _, m in members), sum(i in good for i, _ in gone),
                                                   sum(i in toxic for i, _ in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(removals[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_audit_equals_running_every_order(spark):
    from pyspark.sql import functions as F

    rows = [(k, t, f"s{k % 3}" if k % 4 else None) for k, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0], "s1"), (0, TEXTS[0], "s1"), (None, BIG, "s1"), (None, None, ""), (50, BIG, ""), (51, "only", "hot")]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 16, 2)] + [(3, None, None), (3, 1, 1), (None, 1, 1), (1, 0, 1), (50, 1, 0)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("_sha", F.lit(1)).withColumn(
        "part", F.lit("clash")).withColumn("quality", F.lit(1)).repartition(3)
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("source", F.lit("clash"))
    want = brute(rows, labels)
    assert audited(filter_audit.audit(docs, said)) == want
    assert len(want) == 600 * 5  # '', s0, s1, s2, hot
    assert filter_audit.audit(docs.where("false"), said).collect() == []
    unlabelled = audited(filter_audit.audit(docs, None))
    assert {k: (*v[:4], 0, 0, v[6]) for k, v in want.items()} == unlabelled


def test_own_filters_and_efficiency(spark):
    """Two filters and the copies: the values of a part add up to what all filters remove, times the orders."""
    rows = [(k, "ab" * (k % 5) + "#" * (k % 2), "s") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    from pyspark.sql import functions as F

    got = filter_audit.audit(docs, None, part_col=None, filters=lambda t: {"S": F.length(t) < 4, "H": t.contains("#")}).collect()
    assert len(got) == 3 * 2 * 3 and {r.part for r in got} == {""}
    last = [r for r in got if r.step == 3]
    removed = 30 - last[0].kept
    assert len({r.kept for r in last}) == 1
    shapley = {r.filter_order[r.step - 1]: r.shapley for r in got}
    assert sum(shapley.values()) == 6 * removed

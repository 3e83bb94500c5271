"""Secret scan (operator 8): fixed patterns plus sliding-window entropy.

Only DataFrame functions.  Positions of regex matches come from cutting the
text at the matches: the k-th match starts after the first k pieces and the
first k-1 matches.  Offsets are code points, ends are exclusive.

Base spans (``assign``, ``access``, ``hex``) are leftmost non-overlapping
matches per kind; matches that fail the length rule are dropped after
matching, so they still use up their text.

Entropy spans: candidate strings are runs of the base64 alphabet of at least
``window`` characters.  For
each character class (hex, base64) a fold moves a window of ``window`` characters over the candidate, keeping one count per
character of the class; a step adds one count, takes one off and corrects the
running sum of c*log2(c), so a step's cost does not depend on the candidate's
length.  Windows at or above the class threshold are merged into spans.  Windows that
overlap an allow-list match are suppressed (a candidate is cut at its matches); base spans
are never suppressed.

Defined results: null text counts as empty (no spans, the digest of the empty
string); repeated rows and null ids give one row each; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, pattern, group whose length counts, least length
BASE_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: What a text must hold for a kind to have a span; spares the others the cutting.
BASE_HINTS = {"hex": r"[0-9a-f]{32}", "access": r"AKIA[A-Z0-9]{12}",
              "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""}

#: class name, alphabet, entropy threshold in bits per character
CLASSES = (
    ("entropy_hex", "0123456789abcdefABCDEF", 3.0),
    ("entropy_b64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
)

#: Parts of candidates that are known not to be secrets.
ALLOW_LIST = (
    r"(?i:example|sample|placeholder|changeme|dummy|xxxx)",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(?:1|256|384|512)-[A-Za-z0-9+/=]+$",
    r"(?i:abcdefghij)|0123456789",
)

SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """Spans (start, kind, end) of the matches whose ``group`` has ``least`` characters."""
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("piece"),
                       F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                       F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        keep = F.length(x["part"]) >= least
        return F.struct(end.alias("pos"),
                        F.when(keep, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    init = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(cut, init, step, lambda acc: acc["out"])


def base_spans(text: Column, kind: int) -> Column:
    name, pattern, group, least = BASE_KINDS[kind]
    return F.when(text.rlike(BASE_HINTS[name]), _matches(text, pattern, kind, group, least)).otherwise(
        F.array().cast(SPAN))


def _between(string: Column, known: str) -> Column:
    """What is left of a string (start, hit) between the matches of ``known``."""
    hit = string["hit"]
    cut = F.arrays_zip(F.split(hit, known, -1).alias("piece"), F.regexp_extract_all(hit, F.lit(known), F.lit(0)).alias("gone"))

    def step(acc, x):
        piece = F.array(F.struct(acc["pos"].alias("start"), x["piece"].alias("hit")))
        return F.struct((acc["pos"] + F.length(x["piece"]) + F.coalesce(F.length(x["gone"]), F.lit(0))).alias("pos"),
                        F.concat(acc["out"], piece).alias("out"))

    init = F.struct(string["start"].alias("pos"), F.array().cast("array<struct<start:int,hit:string>>").alias("out"))
    return F.aggregate(cut, init, step, lambda acc: acc["out"])


def _clogc(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _moves(hit: Column, alphabet: str, window: int) -> Column:
    """array<struct<i, new, old>>: the code that enters and the one that leaves at each step.

    Codes are 1-based alphabet positions, 0 outside the class; -1: none leaves yet.
    """
    codes = F.transform(F.split(hit, ""), lambda ch: F.instr(F.lit(alphabet), ch))
    leaving = F.concat(F.array_repeat(F.lit(-1), window), codes)
    return F.filter(F.transform(F.arrays_zip(codes.alias("new"), leaving.alias("old")), lambda x, i: F.struct(
        i.alias("i"), x["new"].alias("new"), x["old"].alias("old"))), lambda x: x["new"].isNotNull())


def _moved(alphabet: str, window: int) -> Column:
    return F.transform("_r", lambda s: F.struct(s["start"].alias("start"), _moves(s["hit"], alphabet, window).alias("moves")))


def _hot_runs(moves: Column, size: int, window: int, threshold: float) -> Column:
    """Runs [start, end) covered by windows with entropy >= threshold.

    A window that holds a character outside the class is never hot.
    """
    runs = "array<struct<start:int,end:int>>"

    def one(acc):
        return F.array(F.struct(acc["start"].alias("start"), acc["last"].alias("end")))

    def step(acc, x):
        i, new, old = x["i"], x["new"], x["old"]
        c_old = F.coalesce(F.get(acc["cnt"], old), F.lit(0))
        c_new = F.get(acc["cnt"], new) - F.when(old == new, 1).otherwise(0)
        less = F.when(old >= 0, _clogc(c_old) - _clogc(c_old - 1)).otherwise(F.lit(0.0))
        total = acc["s"] - less + _clogc(c_new + 1) - _clogc(c_new)
        cnt = F.transform(acc["cnt"], lambda c, k: c + F.when(k == new, 1).otherwise(0)
                          - F.when(k == old, 1).otherwise(0))
        outside = (F.get(acc["cnt"], F.lit(0)) + F.when(new == 0, 1).otherwise(0)
                   - F.when(old == 0, 1).otherwise(0))
        # entropy of the window: log2(W) - sum(c * log2 c) / W
        entropy = F.log2(F.lit(float(window))) - total / window
        hot = (i >= window - 1) & (outside == 0) & (entropy >= threshold - 1e-9)
        first = i - (window - 1)
        opens = hot & (acc["last"] < first)
        closes = opens & (acc["last"] >= 0)
        return F.struct(cnt.alias("cnt"), total.alias("s"),
                        F.when(opens, first).otherwise(acc["start"]).alias("start"),
                        F.when(hot, i + 1).otherwise(acc["last"]).alias("last"),
                        F.when(closes, F.concat(acc["out"], one(acc))).otherwise(acc["out"]).alias("out"))

    init = F.struct(F.array_repeat(F.lit(0), size + 1).alias("cnt"), F.lit(0.0).alias("s"),
                    F.lit(0).alias("start"), F.lit(-1).alias("last"), F.array().cast(runs).alias("out"))
    return F.aggregate(moves, init, step,
                       lambda acc: F.when(acc["last"] >= 0, F.concat(acc["out"], one(acc))).otherwise(acc["out"]))


def entropy_spans(strings: Column, k: int, window: int) -> Column:
    """Spans of class ``k`` in array<struct<start, moves>>."""
    name, alphabet, least = CLASSES[k]
    return F.flatten(F.transform(strings, lambda s: F.transform(
        _hot_runs(s["moves"], len(alphabet), window, least), lambda r: F.struct(
            (s["start"] + r["start"]).alias("start"), F.lit(len(BASE_KINDS) + k).alias("kind"),
            (s["start"] + r["end"]).alias("end")))))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                 allow_list: Sequence[str] = ALLOW_LIST, keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, ``text`` (null: empty), ``base`` and
    ``spans`` (arrays of start, kind, end in order of start, then kind), plus
    the input columns named in ``keep``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"),
                     *[F.col(f"`{c}`") for c in keep])
    # a candidate is a whole run of the alphabet; the look-behind keeps the search to one attempt a word
    char = "[A-Za-z0-9+/_=-]"
    run = "(?<!%s)%s{%d,}" % (char, char, window)
    text, none = F.col("text"), F.array().cast(SPAN)
    found = rows.select("*", *[base_spans(text, k).alias(f"_b{k}") for k in range(len(BASE_KINDS))],
                        F.when(text.rlike(run), _matches(text, run, 0, 0, window)).otherwise(none).alias("_r"))
    found = found.withColumn("_r", F.transform("_r", lambda s: F.struct(
        s["start"].alias("start"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("hit"))))
    if allow_list:
        known = "|".join(f"(?:{p})" for p in allow_list)
        found = found.withColumn("_r", F.flatten(F.transform("_r", lambda s: F.when(s["hit"].rlike(known), _between(s, known)).otherwise(F.array(s)))))
        found = found.withColumn("_r", F.filter("_r", lambda s: F.length(s["hit"]) >= window))
    # the moves are bound to a field, so the fold does not work them out again at each step
    found = found.withColumns({f"_m{k}": _moved(alphabet, window) for k, (_, alphabet, _) in enumerate(CLASSES)})
    found = found.withColumn("_e", F.when(F.size("_r") > 0, F.concat(*[
        entropy_spans(F.col(f"_m{k}"), k, window) for k in range(len(CLASSES))])).otherwise(none))
    found = found.withColumn("base", F.array_sort(F.concat(*[F.col(f"_b{k}") for k in range(len(BASE_KINDS))])))
    return found.select("doc_id", "text", *keep, "base", F.array_sort(F.concat("base", "_e")).alias("spans"))


def span_string(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in BASE_KINDS], *[F.lit(c[0]) for c in CLASSES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every (merged) span replaced by ``mark``."""
    def step(acc, s):
        piece = F.array(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit(mark))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(s["start"] >= acc["pos"], F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    init = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, init, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text) - acc["pos"]))))


def redact_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                   mark: str = "[SECRET]", **options) -> DataFrame:
    """The input's rows and columns with secrets replaced; a text without secrets
    (null included) stays as it is.  ``length_col`` takes the new length of changed texts."""
    at = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    inner = df.select(*[F.col(f"`{c}`").alias(a) for c, a in at.items()])
    found = find_secrets(inner, at[id_col], at[text_col], keep=list(at.values()), **options)
    found = found.withColumn("_new", redacted(F.col("text"), F.col("spans"), mark))
    hit = F.size("spans") > 0
    out = {text_col: F.when(hit, F.col("_new")).otherwise(F.col(at[text_col]))}
    if length_col in at:
        out[length_col] = F.when(hit, F.length("_new").cast(df.schema[length_col].dataType)).otherwise(F.col(at[length_col]))
    return found.select(*[out.get(c, F.col(at[c])).alias(c) for c in df.columns])


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, per document."""
    found = find_secrets(df, id_col, text_col, **options)
    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_string(F.col("base")), 256).alias("base_sha256"),
                        span_string(F.col("spans")).alias("spans"))


def _oracle(window: int = 20) -> str:
    """DuckDB twin of ``secret_report``: entropies window by window."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"

    def cut(name: str, pattern: str, group: int) -> str:
        return f"""{name} AS MATERIALIZED (
SELECT r, hits[k] AS hit, parts[k] AS part, list_sum(list_transform(pieces[1:k], lambda x: length(x)))
  + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0) AS start
FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (SELECT r, string_split_regex(t, {quote(pattern)}) AS pieces,
  regexp_extract_all(t, {quote(pattern)}, 0) AS hits, regexp_extract_all(t, {quote(pattern)}, {group}) AS parts FROM d)))"""

    ctes = ["d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"]
    ctes += [cut(name, pattern, group) for name, pattern, group, _ in BASE_KINDS]
    ctes.append("base AS (" + " UNION ALL ".join(
        f"SELECT r, {k} AS kind, '{name}' AS name, CAST(start AS BIGINT) AS s, CAST(start + length(hit) AS BIGINT) AS e FROM {name} WHERE length(part) >= {least}"
        for k, (name, _, _, least) in enumerate(BASE_KINDS)) + ")")
    ctes.append(cut("run", "[A-Za-z0-9+/_=-]{%d,}" % window, 0))
    known = quote("|".join(f"(?:{p})" for p in ALLOW_LIST))
    ctes.append(f"""piece AS MATERIALIZED (SELECT r, pieces[k] AS hit, start + coalesce(list_sum(list_transform(pieces[1:k - 1], lambda x: length(x))), 0)
  + coalesce(list_sum(list_transform(gone[1:k - 1], lambda x: length(x))), 0) AS start
FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS k FROM (SELECT r, start, string_split_regex(hit, {known}) AS pieces,
  regexp_extract_all(hit, {known}, 0) AS gone FROM run)))""")
    ctes.append(f"""win AS MATERIALIZED (SELECT r, start, i, substr(hit, CAST(i + 1 AS BIGINT), {window}) AS w
FROM (SELECT *, unnest(range(0, length(hit) - {window - 1})) AS i FROM piece))""")
    entropy = f"""list_sum(list_transform(list_distinct(string_split(w, '')), lambda c:
  -(length(w) - length(replace(w, c, ''))) / {window}.0 * log2((length(w) - length(replace(w, c, ''))) / {window}.0)))"""
    for k, (name, alphabet, least) in enumerate(CLASSES):
        ctes.append(f"""{name}_h AS (SELECT r, start, i, CASE WHEN i > lag(i) OVER (PARTITION BY r, start ORDER BY i) + {window} THEN 1 ELSE 0 END AS cut
FROM win WHERE length(translate(w, '{alphabet}', '')) = 0 AND {entropy} >= {least} - 1e-9)""")
        ctes.append(f"""{name} AS (SELECT r, {len(BASE_KINDS) + k} AS kind, '{name}' AS name, CAST(start + min(i) AS BIGINT) AS s,
  CAST(start + max(i) + {window} AS BIGINT) AS e
FROM (SELECT r, start, i, sum(cut) OVER (PARTITION BY r, start ORDER BY i) AS g FROM {name}_h) GROUP BY r, start, g)""")
    every = " UNION ALL ".join(["SELECT * FROM base", *(f"SELECT * FROM {name}" for name, _, _ in CLASSES)])
    joined = "string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    ctes.append(f"b AS (SELECT r, {joined} AS text, {', '.join(f'count(CASE WHEN kind = {k} THEN 1 END) AS n_{n}' for k, (n, *_) in enumerate(BASE_KINDS))} FROM base GROUP BY r)")
    ctes.append(f"a AS (SELECT r, {joined} AS text FROM ({every}) GROUP BY r)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, {', '.join(f'coalesce(n_{n}, 0) AS n_{n}' for n, *_ in BASE_KINDS)},
  sha256(coalesce(b.text, '')) AS base_sha256, coalesce(a.text, '') AS spans
FROM d LEFT JOIN b ON b.r = d.r LEFT JOIN a ON a.r = d.r"""


ORACLE = _oracle()

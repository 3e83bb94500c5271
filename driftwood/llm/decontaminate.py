"""Benchmark decontamination by template canonicalisation (operator 10).

Only DataFrame functions.  A text becomes a list of canonical words: lower
case, with typed placeholders for numbers, names (title-case words
inside a sentence) and units beside a number.  Windows
of ``window`` canonical words are hashed and joined with the benchmark's.

Consecutive windows of a document that match consecutive windows of an item
form a run.  A run counts only if its slots are consistent: one slot value of
the item always meets the same value in the document, and different names stay
different.  So a question with other numbers and names is caught, and two
texts that share only a frame of placeholders are not.  A document is
contaminated by an item if it holds a consistent run of ``min_windows`` windows
(13 words at the defaults), or of the share ``containment`` of the item's
windows if those are fewer.

Names at the start of a text or sentence, after a line break, a quotation mark, a
bracket or a colon, and number words, are slots of the wide templates only.  These
are looked at besides the narrow ones, not instead: a copy in capitals or small
letters keeps its ordinary words there.

Two passes keep the work small and lose nothing.  Any run of r windows covers a
window whose position divides by r, so the first pass hashes every r-th window
only (r: the least run that any item asks for), narrow and wide in one projection, and yields candidate documents;
the second looks at all windows of those.  Marks and placeholders are set on whole texts, so
there is no work per word but cutting.  The benchmark's windows and the
candidate ids are broadcast only if their counted number is at most
``broadcast_rows``; beyond that the joins shuffle and AQE splits frequent keys.

Defined results: null or empty texts have no words and are never contaminated,
nor are rows with a null id reported; rows with one id and different texts are judged
(and dropped) one by one and reported once under the id; an item shorter
than ``window`` words is one window of its own length, an item without words
never matches; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftwood.llm.common import row_key, text_rows, written

#: Canonical words of a name, a unit or sign, and a number; in a text, marks before title-case words
#: inside a sentence (NAME) and elsewhere (TITLE).
NAME, UNIT, TITLE, NUM = "\u0001", "\u0002", "\u0003", "\u0004"

#: Units that stand next to a number.
UNITS = ("mg", "g", "kg", "lb", "lbs", "oz", "t", "mm", "cm", "m", "km", "in", "ft", "mi", "mile", "miles",
         "metre", "metres", "meter", "meters", "ml", "l", "litre", "litres", "liter", "liters", "ms", "s",
         "sec", "seconds", "min", "minutes", "h", "hr", "hour", "hours", "day", "days", "week", "weeks",
         "month", "months", "year", "years", "usd", "eur", "gbp", "dollars", "euros", "pounds", "percent")

#: Number words, slots like digits in wide templates.
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
                "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty",
                "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million")


_WORD = r"[\p{L}\p{N}]"


def _marked(text: Column) -> Column:
    """Lower case; title-case words marked, numbers in one piece and apart from letters, signs beside them as UNIT."""
    t = F.regexp_replace(text, rf"(?=\p{{Lu}}\p{{Ll}})(?<!{_WORD})", TITLE)
    t = F.regexp_replace(t, rf"{TITLE}(?<=[\p{{Ll}}\p{{N}},;]\x20{TITLE})", NAME)
    plain = F.regexp_replace(t, r"[.,](?<=\p{N}[.,])(?=\p{N})", "")
    plain = F.regexp_replace(plain, r"[$€£](?=\x20?\p{N})|[%°$€£](?<=\p{N}\x20?[%°$€£])", f" {UNIT} ")
    plain = F.regexp_replace(plain, r"(?<=\p{N})(?=\p{L})", " ")
    return F.lower(F.when(text.rlike(r"\p{N}"), plain).otherwise(t))


def _split(text: Column, ends: str) -> Column:
    """Runs of letters, numerals and ``ends``; an empty string where the text starts or ends otherwise."""
    return F.split(text, rf"[^\p{{L}}\p{{N}}{ends}]+")


def _trimmed(words: str) -> Column:
    first = F.when(F.get(words, F.lit(0)) == "", 2).otherwise(1)
    last = F.when(F.element_at(words, -1) == "", 1).otherwise(0)
    return F.slice(words, first, F.greatest(F.size(words) - last - first + 1, F.lit(0))).alias(words)


def _canonical(marked: Column, wide: bool) -> Column:
    """The canonical words of a marked text, not yet trimmed. ``wide``: every title-case word is a name, number words are numbers."""
    t = marked
    if wide:
        t = F.regexp_replace(t, rf"[{NAME}{TITLE}]?+(?=[a-z])(?<!{_WORD})(?:{'|'.join(NUMBER_WORDS)})(?!{_WORD})", NUM)
    t = F.regexp_replace(t, rf"[{NAME}{TITLE}]{_WORD}+" if wide else rf"{NAME}{_WORD}+", NAME)
    numbered = F.regexp_replace(t, rf"(?=\p{{N}})(?<!{_WORD})\p{{N}}++", NUM)
    beside = rf"({NUM}[^\p{{L}}\p{{N}}{NAME}{UNIT}{NUM}]+)(?:{'|'.join(UNITS)})(?!{_WORD})"
    numbered = F.regexp_replace(numbered, beside, f"$1{UNIT}")
    return _split(F.when(t.rlike(rf"[\p{{N}}{NUM}]"), numbered).otherwise(t), NAME + UNIT + NUM)


def templates(df: DataFrame, id_col: str, text_col: str, wide: bool = False) -> DataFrame:
    """doc_id, row (hash of id and text), h (canonical words), slot (placeholder and value, null beside other words).

    ``wide``: every title-case word is a name, wherever it stands, and number words are numbers."""
    marked = text_rows(df, id_col, text_col).select("doc_id", row_key().alias("row"), _marked(F.col("text")).alias("t"))
    words = marked.select("doc_id", "row", _canonical(F.col("t"), wide).alias("h"), _split(F.col("t"), UNIT).alias("w"))
    return words.select("doc_id", "row", _trimmed("h"), _trimmed("w")).select("doc_id", "row", "h", F.zip_with("w", "h", lambda w, c: F.when(
        c.isin(NAME, NUM, UNIT), F.concat(c, w))).alias("slot"))


def _hash_at(words: str, i: Column, size: Column) -> Column:
    return F.xxhash64(F.slice(words, i + 1, size))


def _starts(words: str, size: Column, stride: int = 1) -> Column:
    return F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size, F.lit(stride)))


def _windows(size: Column) -> Column:
    """array<struct<pos, key, slots>> of all windows of ``size`` words."""
    return F.transform(_starts("h", size), lambda i: F.struct(
        i.alias("pos"), _hash_at("h", i, size).alias("key"),
        F.filter(F.slice("slot", i + 1, size), lambda x: x.isNotNull()).alias("slots")))


def _slot_offsets(pos: Column, size: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), size - 1), lambda k: F.get(F.col("slot"), pos + k).isNotNull())


def benchmark_windows(bench: DataFrame, id_col: str, text_col: str, window: int, min_windows: int,
                      containment: float, wide: bool = False) -> DataFrame:
    """item_id, size, item_windows, need (least run), ipos, key, islots, iat (offsets of the slots in the window)."""
    t = templates(bench, id_col, text_col, wide).where((F.size("h") > 0) & F.col("doc_id").isNotNull())
    size = F.least(F.lit(window), F.size("h"))
    n = F.size("h") - size + 1
    need = F.least(F.lit(min_windows), F.ceil(n * F.lit(containment)).cast("int"))
    return t.select(F.col("doc_id").alias("item_id"), size.alias("size"), n.alias("item_windows"), need.alias("need"),
                    "slot", F.explode(_windows(size)).alias("w")).select(
        "item_id", "size", "item_windows", "need", F.col("w.pos").alias("ipos"), F.col("w.key").alias("key"),
        F.col("w.slots").alias("islots"), _slot_offsets(F.col("w.pos"), F.col("size")).alias("iat")).distinct()


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = 8, min_windows: int = 6,
                 containment: float = 0.8, broadcast_rows: int = 1_000_000, cut_runs: bool = False,
                 wide_names: bool = False, by_row: bool = False) -> DataFrame:
    """(doc_id, item_id, longest_run, item_windows, n_slots) of every contaminated pair.

    ``cut_runs``: runs are cut at clashing slots (as in the DuckDB twin); else a run with a clash is left out.
    ``wide_names``: pairs that the templates miss are looked for with wide templates too (see ``templates``).
    ``by_row``: one result for each ``row`` (hash of id and text) of a document."""
    forms = (False, True) if wide_names else (False,)
    items = None
    for wide in forms:
        own = benchmark_windows(bench, item_col, item_text_col, window, min_windows, containment, wide).withColumn("wide", F.lit(wide))
        items = own if items is None else items.unionAll(own)
    items = written(items, "bench-windows")
    sizes = {r["size"]: r for r in items.groupBy("size").agg(  # at most `window` rows
        F.min("need").alias("need"), F.count("*").alias("n")).collect()}
    if not sizes:
        sizes = {window: {"need": min_windows, "n": 0}}

    def small(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= broadcast_rows else df

    near = _candidates(docs.where(F.col(f"`{id_col}`").isNotNull()), items, sizes, small, id_col, text_col, forms)
    hits = None
    for wide in forms:
        t = templates(near, id_col, text_col, wide)
        for size, r in sorted(sizes.items()):
            own = items.where((F.col("size") == size) & (F.col("wide") == F.lit(wide)))
            part = t.select("doc_id", "row", F.explode(_windows(F.lit(size))).alias("w")).select(
                "doc_id", "row", "w.pos", "w.key", "w.slots").join(small(own, r["n"]), "key")
            hits = part if hits is None else hits.unionAll(part)
    found = _found(hits, cut_runs)
    if wide_names:
        pair = Window.partitionBy("doc_id", "row", "item_id")
        found = found.withColumn("narrow", F.min("wide").over(pair)).where(F.col("wide") == F.col("narrow"))
    found = found.drop("wide", "narrow")
    if by_row:
        return found
    return found.groupBy("doc_id", "item_id", "item_windows").agg(
        F.max("longest_run").alias("longest_run"), F.max("n_slots").alias("n_slots")).select(
        "doc_id", "item_id", "longest_run", "item_windows", "n_slots")


def _sampled(words: str, size: int, stride: int) -> Column:
    """Hashes of the windows of ``size`` words at every ``stride``-th position."""
    hashes = F.transform(_starts(words, F.lit(size), stride), lambda i: _hash_at(words, i, F.lit(size)))
    return F.coalesce(hashes, F.array().cast("array<bigint>"))


def _candidates(docs: DataFrame, items: DataFrame, sizes: dict, small, id_col: str, text_col: str, forms: tuple) -> DataFrame:
    """The documents that share a window at one of every ``need`` positions with an item, in either form."""
    marked = text_rows(docs, id_col, text_col).select("doc_id", _marked(F.col("text")).alias("t"))
    names = [f"h{int(wide)}" for wide in forms]
    words = marked.select("doc_id", *[_canonical(F.col("t"), wide).alias(n) for wide, n in zip(forms, names)]).select(
        "doc_id", *map(_trimmed, names))
    found = None
    for size, r in sorted(sizes.items()):
        keys = small(items.where(F.col("size") == size).select("key").distinct(), r["n"])
        sampled = F.concat(*[_sampled(n, size, r["need"]) for n in names])
        hit = words.select("doc_id", F.explode(sampled).alias("key")).join(keys, "key", "left_semi").select("doc_id")
        found = hit if found is None else found.unionAll(hit)
    found = written(found.distinct(), "bench-candidates").withColumnRenamed("doc_id", "_id")
    return docs.join(small(found, found.count()), F.col(f"`{id_col}`").cast("bigint") == F.col("_id"), "left_semi")


def _found(hits: DataFrame, cut_runs: bool) -> DataFrame:
    """doc_id, row, item_id, wide, longest_run, item_windows, n_slots of the windows' consistent runs."""
    hits = hits.select("doc_id", "row", "item_id", "wide", "item_windows", "need", "size", "ipos",
                       (F.col("pos") - F.col("ipos")).alias("diag"), "islots", "slots", "iat").distinct()
    at = Window.partitionBy("doc_id", "row", "item_id", "wide", "diag").orderBy("ipos")
    key = ["doc_id", "row", "item_id", "wide", "diag", "run"]
    runs = hits.withColumn("run", F.col("ipos") - F.row_number().over(at))
    whole = Window.partitionBy(*key)
    runs = runs.withColumn("length", F.count("*").over(whole)).withColumn("first", F.min("ipos").over(whole))
    runs = runs.where(F.col("length") >= F.col("need"))
    runs = written(runs, "bench-runs")
    good = _stretches(runs, key, cut_runs)
    return good.groupBy("doc_id", "row", "item_id", "wide", "item_windows").agg(
        F.max("length").cast("bigint").alias("longest_run"), F.greatest(F.max("s"), F.lit(0)).alias("n_slots")).select(
        "doc_id", "row", "item_id", "wide", "longest_run", F.col("item_windows").cast("bigint").alias("item_windows"), "n_slots")


def _stretches(runs: DataFrame, key: list[str], cut_runs: bool) -> DataFrame:
    """The windows of ``runs`` inside a consistent stretch of ``need`` windows; ``length`` of the stretch that ends there, ``s`` slots.

    Of two slots that clash a stretch holds one at most, so the second moves the
    earliest start of all stretches that reach it behind the first."""
    pairs = runs.where(F.size("islots") > 0).select(*key, "ipos", F.explode(F.arrays_zip(
        F.col("iat").alias("k"), F.col("islots").alias("i"), F.col("slots").alias("d"))).alias("p")).select(
        *key, (F.col("ipos") + F.col("p.k")).alias("at"), "p.i", "p.d").distinct()
    same_i, same_d = (Window.partitionBy(*key, c).orderBy("at") for c in "id")
    clash = pairs.withColumn("value", F.when(F.lag("d").over(same_i) != F.col("d"), F.lag("at").over(same_i))).withColumn(
        "name", F.when(F.col("i").startswith(NAME) & (F.lag("i").over(same_d) != F.col("i")), F.lag("at").over(same_d)))
    cuts = clash.select(*key, "at", (F.greatest("value", "name") + 1).alias("cut")).where("cut is not null")
    if not cut_runs:
        return runs.join(cuts.select(*key).distinct(), key, "left_anti").withColumn("s", F.size("islots"))
    ends = runs.select(*key, "item_windows", "need", "ipos", F.col("first").alias("low"), F.size("islots").alias("s"),
                       (F.col("ipos") + F.col("size") - 1).alias("at")).unionByName(cuts, allowMissingColumns=True)
    so_far = Window.partitionBy(*key).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("start", F.greatest("low", F.max("cut").over(so_far))).where("ipos is not null")
    length = F.col("ipos") - F.col("start") + 1
    ends = ends.withColumn("length", F.when(length >= F.col("need"), length))
    later = Window.partitionBy(*key).orderBy("ipos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    first = F.min(F.when(F.col("length").isNotNull(), F.col("start"))).over(later)
    return ends.withColumn("first", first).where(F.col("first") <= F.col("ipos"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text no item contaminates; rows without an id stay."""
    options = {"cut_runs": True, "wide_names": True} | options
    bad = contaminated(docs, bench, id_col=id_col, by_row=True, **options).select(
        F.col("doc_id").alias("_bad"), F.col("row").alias("_bad_row")).distinct()
    bad = written(bad, "bench-bad")
    if bad.count() <= options.get("broadcast_rows", 1_000_000):
        bad = F.broadcast(bad)
    same = (F.col(f"`{id_col}`").cast("bigint") == F.col("_bad")) & (
        row_key(id_col, options.get("text_col", "text")) == F.col("_bad_row"))
    return docs.join(bad, same, "left_anti")


def _oracle(window: int = 8, min_windows: int = 6, containment: float = 0.8) -> str:
    """DuckDB twin of ``contaminated`` with cut runs and wide templates.

    Words are classified one by one here, and a stretch is looked for among all pairs of a run's windows."""
    units, numbers = (", ".join(f"'{u}'" for u in words) for words in (UNITS, NUMBER_WORDS))

    def twice(text: str, pattern: str, to: str) -> str:
        # a match uses up the character that the next one needs before it
        return f"regexp_replace(regexp_replace({text}, '{pattern}', '{to}', 'g'), '{pattern}', '{to}', 'g')"

    def canon(name: str, table: str, key: str, wide: bool) -> list[str]:
        if wide:
            t = r"regexp_replace(coalesce(text, ''), '(^|[^\p{L}\p{N}])(\p{Lu}\p{Ll})', '\1' || chr(1) || '\2', 'g')"
        else:
            t = twice("coalesce(text, '')", r"([\p{Ll}\p{N},;] )(\p{Lu}\p{Ll})", r"\1' || chr(1) || '\2")
        t = twice(t, r"(\p{N})[.,](\p{N})", r"\1\2")
        t = f"regexp_replace({t}, '[$€£]( ?\\p{{N}})', ' ' || chr(2) || ' \\1', 'g')"
        t = f"regexp_replace({t}, '(\\p{{N}} ?)[%°$€£]', '\\1 ' || chr(2) || ' ', 'g')"
        t = twice(t, r"(\p{N})(\p{L})", r"\1 \2")
        words = f"list_filter(string_split_regex({t}, '[^\\p{{L}}\\p{{N}}\\x01\\x02]+'), lambda x: x <> '')"

        def number(x: str) -> str:
            return f"(regexp_matches({x}, '^\\p{{N}}')" + (f" OR ltrim(lower({x}), chr(1)) IN ({numbers}))" if wide else ")")

        kind = f"""CASE WHEN {number('x')} THEN '<num>' WHEN starts_with(x, chr(1)) THEN '<name>'
    WHEN x = chr(2) OR (lower(x) IN ({units}) AND coalesce({number('w[i - 1]')}, false)) THEN '<unit>' ELSE lower(x) END"""
        source = name if name.startswith("item") else f"{name}, (SELECT DISTINCT size FROM item{name[3:]}_g)"
        size = f"least({window}, len(c))" if name.startswith("item") else "size"
        return [f"{name}_w AS MATERIALIZED (SELECT {key} AS id, {words} AS w FROM {table} WHERE {key} IS NOT NULL)",
                f"{name} AS MATERIALIZED (SELECT id, w, list_transform(w, lambda x, i: {kind}) AS c FROM {name}_w)",
                f"""{name}_g AS MATERIALIZED (SELECT id, size, len(c) - size + 1 AS n, i, array_to_string(c[i + 1:i + size], chr(31)) AS g,
list_filter(list_transform(range(i + 1, i + size + 1), lambda k: CASE WHEN c[k] IN ('<name>', '<num>', '<unit>')
  THEN {{'k': k - i - 1, 'v': c[k] || ltrim(lower(w[k]), chr(1))}} END), lambda x: x IS NOT NULL) AS slots
FROM (SELECT id, w, c, size, unnest(range(0, len(c) - size + 1)) AS i
  FROM (SELECT id, w, c, {size} AS size FROM {source}) WHERE len(c) >= size AND size > 0))"""]

    def found(form: str, wide: bool) -> list[str]:
        run = "doc_id, item_id, diag, run"
        return [
            *canon(f"item{form}", "benchmark", "item_id", wide), *canon(f"doc{form}", "documents", "doc_id", wide),
            f"""hit{form} AS MATERIALIZED (SELECT DISTINCT d.id AS doc_id, b.id AS item_id, b.n, b.size, b.i AS ipos, d.i - b.i AS diag,
  b.slots AS islots, d.slots FROM doc{form}_g d JOIN item{form}_g b ON b.g = d.g AND b.size = d.size)""",
            f"""run{form} AS MATERIALIZED (SELECT *, ipos - row_number() OVER (PARTITION BY doc_id, item_id, diag ORDER BY ipos) AS run,
  least({min_windows}, ceil(n * {containment})) AS need FROM hit{form})""",
            f"""pair{form} AS MATERIALIZED (SELECT DISTINCT {run}, ipos + i.k AS at, i.v AS i, d.v AS d
  FROM (SELECT {run}, ipos, unnest(islots) AS i, unnest(slots) AS d FROM run{form} WHERE len(islots) > 0))""",
            f"""clash{form} AS MATERIALIZED (SELECT {run}, a.at AS low, b.at AS high FROM pair{form} a JOIN pair{form} b USING ({run})
  WHERE a.at < b.at AND ((a.i = b.i AND a.d <> b.d) OR (a.d = b.d AND a.i <> b.i AND starts_with(b.i, '<name>'))))""",
            f"""stretch{form} AS MATERIALIZED (SELECT {run}, a.n, a.ipos AS first, b.ipos AS last
  FROM run{form} a JOIN run{form} b USING ({run}) WHERE b.ipos - a.ipos + 1 >= a.need AND NOT EXISTS (
    SELECT 1 FROM clash{form} k WHERE (k.doc_id, k.item_id, k.diag, k.run) = (a.doc_id, a.item_id, a.diag, a.run)
      AND k.low >= a.ipos AND k.high < b.ipos + b.size))""",
            f"""found{form} AS (SELECT doc_id, item_id, n, max(last - first + 1) AS longest_run, max(len(islots)) AS n_slots
  FROM stretch{form} JOIN run{form} USING ({run}, n) WHERE ipos BETWEEN first AND last GROUP BY doc_id, item_id, n)"""]

    return "WITH " + ",\n".join([*found("", False), *found("x", True)]) + """
SELECT doc_id, item_id, longest_run, CAST(n AS BIGINT) AS item_windows, CAST(n_slots AS INTEGER) AS n_slots
FROM (SELECT * FROM found UNION ALL SELECT * FROM foundx ANTI JOIN found USING (doc_id, item_id))"""


ORACLE = _oracle()

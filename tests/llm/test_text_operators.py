import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from driftwood.llm import blocks, langid, queries, sampling, substrings
from driftwood.llm.common import documents
from tests.conftest import SF001
from tests.llm.conftest import ODD

WORDS = {"xa": "the of and to in is that for with on as are this by".split(), "xb": "der die und das ist nicht ein von mit für".split(),
         "xc": "el la de que y los por una con para".split()}


def spoken(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "ka", "lo", "mi"]) for _ in range(n))


def test_language_by_compression(spark):
    rng = random.Random(1)
    rows = [(k, spoken(rng, lang, rng.randint(30, 200)), lang) for k, lang in enumerate(["xa", "xb", "xc", "xa"] * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("held_out", langid.held_out("doc_id"))
    flags = {r.doc_id: r.held_out for r in df.collect()}
    assert all(flags[k] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in flags)
    learned = langid.train(df.where("not held_out"), sample_docs=20, dict_bytes=1 << 13)
    assert list(learned) == ["xa", "xb", "xc"] and all(len(v) <= 1 << 13 for v in learned.values())
    got = langid.identify(df, learned, keep=("lang", "held_out")).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_sizes_are_block_sums(spark):
    import zstandard as z

    raw = {"a": b"hello world " * 20, "b": b"hallo welt " * 20}
    sizes = langid.Sizes(raw, 5, 64)
    data = langid.normalised("Hello, World! 123 hello " * 20)
    expected = []
    for text in raw.values():
        d = z.ZstdCompressionDict(text, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=5)
        c = z.ZstdCompressor(level=5, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        expected.append(sum(len(c.compress(data[i:i + 64])) for i in range(0, len(data), 64)))
    assert sizes(data) == expected and sizes.best("Hello, World! hello")[0] == "a"


def test_language_odd_rows(spark, docs_of):
    learned = {"a": b"lost id one word " * 30, "b": b"zzz yyy www " * 30}
    assert langid.normalised("½ ² Ⅷ 12_") == b"" and langid.normalised("½ B") == "½ b".encode()
    got = langid.identify(docs_of(ODD), learned).collect()
    assert len(got) == len(ODD)
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred == "und" for r in langid.identify(docs_of(ODD), {}).collect())
    assert langid.identify(docs_of(ODD).limit(0), learned).count() == 0
    empty = docs_of(ODD, lang="a").limit(0)
    assert langid.train(empty) == {}
    kept = langid.keep_identified(docs_of(ODD), learned)
    assert kept.columns == docs_of(ODD).columns
    assert {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3})


def weighted_jaccard(a, b):
    a, b = (Counter(re.findall(r"\w+", t.lower())) for t in (a, b))
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def test_sampling_estimates_weighted_jaccard():
    rng = random.Random(2)
    errors = []
    for seed in range(12):
        sampler = sampling.Sampler(256, seed=seed)
        a = " ".join(rng.choice("abcdefghijkl") * rng.randint(1, 2) for _ in range(120))
        b = a[:len(a) // 2] + " ".join(rng.choice("abcdefghijkl") * rng.randint(1, 2) for _ in range(60))
        errors.append(sampling.likeness(sampler.signature(a), sampler.signature(b)) - weighted_jaccard(a, b))
    assert abs(float(np.mean(errors))) < 0.03 and max(map(abs, errors)) < 0.15


def test_sampling_does_not_depend_on_the_cache():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(400))) for _ in range(40)]
    wide, narrow = sampling.Sampler(32), sampling.Sampler(32, room=64)
    for t in texts + texts[::-1]:
        assert (wide.signature(t) == narrow.signature(t)).all()


def test_edits_follow_the_chain(spark, docs_of):
    rng = random.Random(4)
    rows = [(rng.randrange(-50, 5000), " ".join(f"w{rng.randrange(90)}é" for _ in range(rng.randrange(60)))) for _ in range(150)]
    rows = list({k: (k, t) for k, t in rows}.values()) + [(6000, None), (6001, "🙂" * 501), (6002, "x")]
    got = {r.doc_id: r for r in sampling.fingerprint_edits(docs_of(rows), samples=16).collect()}
    order = sorted(((k, t or "") for k, t in rows), reverse=True)
    sampler = sampling.Sampler(16)
    for i, (k, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, changed, after = (sampler.signature(t) for t in (text, edited, following))
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == own.byteswap().tobytes().hex() and r.edited_fingerprint == changed.byteswap().tobytes().hex()
        assert r.near_edited == sampling.likeness(own, changed) and r.near_next == sampling.likeness(own, after)


def test_edits_odd_rows(docs_of):
    got = sampling.fingerprint_edits(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2, 3)}) == 1
    one = sampling.fingerprint_edits(docs_of([(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert one[0].edited_sha256 == hashlib.sha256(("a b c d"[:4] + "a b").encode()).hexdigest()
    assert sampling.fingerprint_edits(docs_of([(1, "x")]).limit(0)).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    m = blocks.Labeller(hidden=3, dim=5)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = rng.normal(size=(4, 2, 5)), rng.integers(0, 2, (4, 2)).astype(float)
    mask = np.array([[1, 1], [1, 1], [1, 1], [1, 0]], float)

    def loss():
        p = m.forward(x, mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    g = m.gradients(x, mask, y)
    for k, v in m.p.items():
        at = tuple(rng.integers(s) for s in v.shape)
        old = v[at]
        v[at] = old + 1e-4
        up = loss()
        v[at] = old - 1e-4
        down = loss()
        v[at] = old
        assert math.isclose((up - down) / 2e-4, g[k][at], abs_tol=2e-4)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "</p><p>no";</script></head><body><nav><ul><li><a href=x>Home</a>
<li><a href=y>News</a></ul></nav><!-- <p>hidden</p> --><div class="cookie notice">We use cookies</div><article><h1>Title &amp; more</h1>
<p><b>First   part<br>goes on &eacute;<p>Second &lt;part&gt; 5 < 6</p><div class="ad">Buy now</div></article>
<section class="comments"><div class="comment"><p>First!</p></div></section><footer>&copy; x</footer>"""


def test_leaf_blocks():
    got = [(t, list(p)[-1]) for p, t, _ in blocks.leaf_blocks(PAGE)]
    assert got == [("T", "title"), ("Home", "li"), ("News", "li"), ("We use cookies", "notice"), ("Title & more", "h1"),
                   ("First part goes on é", "b"), ("Second <part> 5 < 6", "p"), ("Buy now", "ad"), ("First!", "p"), ("© x", "footer")]
    for odd in ("", "<", "<p", "</", "<!--", "<script>", "<a href=\"x>y", "a<b>c</b", "<p>" * 2000, "&am", "<div class='x"):
        blocks.leaf_blocks(odd)
    assert [t for _, t, _ in blocks.leaf_blocks("a<script>x</scr")] == ["a"]
    assert [t for _, t, _ in blocks.leaf_blocks("<p>x &am<b>p; &lt;b&gt;</b> &#233;&nbsp;y")] == ["x &amp; <b> é y"]


def test_main_text(spark):
    rng = random.Random(5)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit."]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, expected = [], {}
    for k in range(120):
        main = [say(rng.randint(3, 40)) for _ in range(rng.randint(1, 5))]
        tag = "article" if k % 2 else "main"
        html = (f"<html><head><title>{say(3)}</title></head><body><nav><ul><li><a>{say(1)}</a></ul></nav><div class='ad'>{say(6)}</div>"
                f"<{tag}><h1>{main[0]}</h1>" + "".join(f"<p>{t}</p>" for t in main[1:]) + f"</{tag}><footer>{say(4)}</footer></body></html>")
        rows.append((k, f"http://x/{k}", html))
        expected[k] = "\n\n".join(main)
    rows += [(500, "u", None), (501, None, ""), (None, None, PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    model = blocks.train(pages, sample_pages=60, composed=250)
    got = blocks.extract(pages, model).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert sum(by[k].text == t for k, t in expected.items()) >= 118
    assert by[500].text == by[501].text == "" and by[500].n_chars == 0
    assert by[None].text == "Title & more\n\nFirst part goes on é\n\nSecond <part> 5 < 6"
    assert blocks.extract(pages.limit(0), blocks.train(pages.limit(0))).count() == 0


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(d, dtype=np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), len(substrings._runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return out


def test_column_wise_construction():
    rng = random.Random(6)
    for k in range(200):
        length, m = rng.choice([1, 3, 4, 6]), rng.randint(1, 7)
        strings = [bytes(rng.choice(b"ab" if k % 2 else b"abcd") for _ in range(rng.randint(1, 25))) for _ in range(m)]
        if k % 3 == 0 and m > 1:
            strings[1] = strings[0]
        seen = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
        expected = [[seen[s[i:i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        assert [x.tolist() for x in substrings.sorted_windows(strings, length)] == expected
        for size in (1, 1 << 16):
            assert [x.tolist() for x in substrings.repeated_windows(strings, length, size)] == expected


@pytest.mark.parametrize("length,options", [(20, {}), (20, {"group_bytes": 1}), (20, {"collection_bytes": 1}), (7, {"gram": 7}), (12, {"gram": 1})])
def test_repeats_match_brute_force(docs_of, length, options):
    rng = random.Random(length)
    pool = ["".join(rng.choice("abcé ") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    texts = ["".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("defgh漢") for _ in range(9)) for _ in range(rng.randint(0, 9)))
             for _ in range(60)]
    texts += [None, "", "z" * 300, "xy" * 200, texts[0], texts[1], "short"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (None, texts[5]), (5, "other text under a used id " * 2)]
    expected = Counter((k, *e) for (k, _), e in zip(rows, brute_repeats([t for _, t in rows], length)))
    got = substrings.remove_repeats(docs_of(rows), length=length, **options).drop("kept").collect()
    assert Counter(tuple(r) for r in got) == expected


def test_repeats_odd_rows(docs_of):
    rows = ODD[:8] + [(7, "x" * 3000)]
    expected = Counter((k, *e) for (k, _), e in zip(rows, brute_repeats([t for _, t in rows], 200)))
    assert Counter(tuple(r) for r in substrings.remove_repeats(docs_of(rows)).drop("kept").collect()) == expected
    assert len(substrings.remove_repeats(docs_of(ODD)).collect()) == len(ODD)
    assert substrings.remove_repeats(docs_of(ODD).limit(0)).count() == 0


def test_repeats_of_many_equal_rows(docs_of):
    """Rows equal in id and text: ranges are kept once, whatever their number."""
    text = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(700))
    rows = [(1, text)] * 3000 + [(None, "xy" + text[:350])] * 2000 + [(2, text[:150] + "?" + text[150:]), (3, "Z" * 150)]
    got = Counter(tuple(r) for r in substrings.remove_repeats(docs_of(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans").collect())
    assert got == Counter({(1, 700, 700, 1): 3000, (None, 352, 352, 1): 2000, (2, 701, 550, 1): 1, (3, 150, 0, 0): 1})


def test_deep_pages_take_linear_time_and_memory():
    import time
    import tracemalloc

    for page, n in (("<b>" * 300_000 + "end", 1), ("<div><p>w" * 20_000, 20_000), ("<p><button>" + "<ul>" * 50_000, 0),
                    ("".join(f"<div class=c{k}>x" for k in range(20_000)), 20_000)):
        tracemalloc.start()
        began = time.time()
        got = blocks.leaf_blocks(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == n and time.time() - began < 60 and peak < 200 << 20
        assert blocks.features(got[:50]).shape[1] == blocks.DIM


def plain_article(page):
    """The text blocks of the article element, taken with patterns; what is marked as an advert or the like goes."""
    import html
    import re

    found = re.search(r"<article[^>]*>(.*?)</article>", page or "", re.S)
    if not found:
        return None
    inner = re.sub(r"<!--.*?-->|<(script|style|noscript)\b.*?</\1>", "", found[1], flags=re.S)
    inner = re.sub(r"<(div|aside|section|p|form|nav) [^>]*(?:class|id)=\"?[^\">]*\b(?:ad|ads|advert|promo|related|share|comments|newsletter|cookie)\b.*?</\1>", "",
                   inner, flags=re.S)
    parts = re.split(r"</?(?:h[1-6]|p|div|ul|ol|li|blockquote|section|pre|table|tr|td|th|figure|figcaption|aside|form|nav)\b[^>]*>", inner)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", t))).split()) for t in parts]
    return "\n\n".join(t for t in parts if t)


def test_main_text_equals_the_article_taken_with_patterns(spark):
    pages = documents(spark, SF001, "pages")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in queries.QUERIES["op5_main_text"](spark, SF001).collect()}
    known = {k: t for k, t in want.items() if t is not None}
    assert len(known) > 20 and set(got) == set(want)
    assert {k for k, t in known.items() if got[k] != t} == set()


def test_main_text_repeated_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    pages = documents(spark, SF001, "pages").limit(12)
    deep = spark.createDataFrame([(900, "u", "<i>" * 20_000 + "x"), (901, None, None), (901, None, None), (None, "n", "")], pages.schema)
    df = pages.union(pages).union(deep).withColumn("text", F.lit("clash")).withColumn("path", F.lit(1)).withColumn("n_chars", F.lit(2))
    got = blocks.extract(df, blocks.train(df)).select("page_id", "url", "text", "n_chars").collect()
    assert len(got) == 28 and all(r.n_chars == len(r.text) for r in got)
    assert all(n % 2 == 0 for (i, *_), n in Counter(tuple(r) for r in got).items() if i is not None and i != 900)

import random

import public_tokenizers
import pytest
import sentencepiece

from driftwood.llm import queries, token_counts
from driftwood.llm.common import documents
from tests.conftest import SF001
from tests.llm.conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(n=400):
    rng = random.Random(3)
    parts = [" ", "  ", "    ", "\n", "\n\n", "\t", "\r\n", "▁", "the", "The", " of", "über", "漢字", "🙂", "é", "<s>", "</s>",
             "<unk>", "<0x0A>", "\x00", "　", ".", ",", "123", "4.5", "x" * 70, "\xa0", "tion", "ﬁ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_units_add_up_to_the_library(library):
    model = token_counts.model_of(MODEL)
    assert model.cuts
    counts = token_counts.Counts(model, {" the": len(library.encode("the"))}, {}, 50, 48, 40)  # small caches and slices
    for text in odd_texts() + [t or "" for _, t in ODD]:
        assert counts.count(text) == len(library.encode(text)), repr(text[:80])
        assert len(counts.cache) <= 50 + 60


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_slices_keep_units_whole(library, size):
    model = token_counts.model_of(MODEL)
    counts = token_counts.Counts(model, {}, {}, 50, 48, size)
    for text in odd_texts(150) + ["a    b   \n  c▁▁ d", "   x", " " * 20 + "tion", "\n \n  the  \n"]:
        assert "".join(token_counts.slices(model, text, size)) == (" " + text if text else "")
        assert counts.count(text) == len(library.encode(text)), repr(text)


def test_packing_and_summaries():
    counts = {" the": 5, "": 2, "漢字": 7, "\ud800": 1}
    assert token_counts.unpack_units(token_counts.pack_units(counts)) == counts
    assert token_counts.unpack_units(token_counts.pack_units({})) == {}
    many = {str(k): k for k in range(1, 101)}
    kept = token_counts.thinned(many, 10)
    assert set(kept) == {str(k) for k in range(91, 101)} and kept["100"] == 10
    assert token_counts.thinned(many, 100) == many


def test_frequent_units_of_all_partitions(spark):
    rows = [(k, "common words here " * 3 + f"rare{k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(70)  # two levels of merging
    table = token_counts.unpack_units(token_counts.frequent_units(df, MODEL, entries=8))
    assert {" common", " words", " here"} <= set(table) and len(table) <= 8
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert table[" common"] == len(sp.encode("common"))


@pytest.mark.parametrize("table", [None, b"\0\0\0\0"])
def test_rows(spark, docs_of, library, table):
    df = docs_of(ODD, n_tokens=1, unit="clash", part=3)
    got = token_counts.count_tokens(df, limit=100, table=table)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in ODD), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got.collect())
    assert token_counts.count_tokens(df.where("false")).collect() == []


def test_json_model(docs_of):
    from tokenizers import Tokenizer

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tok = Tokenizer.from_file(public_tokenizers.path(name))
        rows = [(k, t) for k, t in enumerate(odd_texts(60))] + [(900, "a <|endoftext|> b"), (901, None)]
        got = token_counts.count_tokens(docs_of(rows), public_tokenizers.path(name)).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def test_query(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_token_counts"](spark, SF001).collect()}
    docs = documents(spark, SF001).collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or ""))
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (n, n > 4096)

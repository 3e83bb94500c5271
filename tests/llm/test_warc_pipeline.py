import base64
import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from driftwood.llm import queries, warc
from driftwood.llm.common import documents
from tests.conftest import SF001


def page_rows():
    rows = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (7, "http://a/7\r\nX: y", "<p>same</p>"),
            (3, "http://b", "é漢" * 50), (4, None, None), (5, "http://c", ""), (6, "http://d", "x" * 100_000),
            (8, "u", "twice"), (8, "u", "twice"), (8, "v", "twice"), (None, "n", "<p>no id</p>"), (9, "w", "\r\n\r\nWARC/1.1\r\n")]
    return rows


def pages(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(page_rows(), "page_id bigint, url string, html string")
    return df.withColumn("digest", F.lit("clash")).withColumn("top", F.lit(1))


@pytest.mark.parametrize("least", [0, 1, 11, 10**6])
def test_archive_records(spark, tmp_path, least):
    warc.write_archive(pages(spark), str(tmp_path), revisit_bytes=least)
    got = warc.read_archive(spark, str(tmp_path)).collect()
    assert len(got) == len(page_rows())
    best = {}
    for i, _, h in page_rows():
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    payload_of = Counter()
    for r in got:
        data = bytes(r.payload)
        sha1 = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.payload_digest == sha1 and r.payload_bytes == len(data)
        payload_of[(r.page_id, data)] += 1
        top = best[data.decode()]
        if r.record_type == "revisit":
            assert len(data) >= least and r.refers_to == (None if top < 0 else top)
        else:
            assert r.refers_to is None and (len(data) < least or (r.page_id or -1) == top)
        head = bytes(r.head).decode()
        warc_head, http_head, rest = head.split("\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in warc_head.split("\r\n")[1:])
        body = bytes(r.record)[len(warc_head.encode()) + 4:-4]
        assert int(fields["Content-Length"]) == len(body) and bytes(r.record).endswith(b"\r\n\r\n") and rest == ""
        assert body == (http_head + "\r\n\r\n").encode() + (data if r.record_type == "response" else b"")
    assert payload_of == Counter((i, (h or "").encode()) for i, _, h in page_rows())
    responses = Counter(bytes(r.payload) for r in got if r.record_type == "response" and r.payload_bytes >= least)
    assert all(n == 1 for n in responses.values())


def test_archive_stores_payloads_once_and_checks_them(spark, tmp_path):
    warc.write_archive(pages(spark), str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/payloads")
    assert stored.count() == len({h or "" for _, _, h in page_rows()})
    from pyspark.sql import functions as F

    bad = str(tmp_path / "bad")
    spark.read.parquet(f"{tmp_path}/records").write.parquet(f"{bad}/records")
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="payload digest differs"):
        warc.read_archive(spark, bad).collect()
    empty = str(tmp_path / "empty")
    warc.write_archive(pages(spark).limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_pipeline_stages(spark):
    docs = documents(spark, SF001)
    rows = {r.doc_id: r for r in docs.collect()}
    left, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        before = left
        left = stage(spark, left, SF001).cache()
        seen.append((name, before, left))
    names = [n for n, *_ in seen]
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "packing"]
    for _, before, after in seen[:-1]:
        assert after.columns == docs.columns and after.schema == before.schema
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    # language ID: no letter, no document
    assert all(any(c.isalpha() for c in rows[i].text or "") for i in ids(seen[0][2]))
    assert len(ids(seen[0][2])) >= 0.97 * len(rows)
    # one document of each group
    from driftwood.llm.simhash import near_duplicates
    groups = {r.doc_id: r.component_id for r in near_duplicates(seen[1][1]).collect()}
    assert ids(seen[1][2]) == set(groups.values())
    # decontamination: exactly those with an item's words
    import re
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [words(r.text) for r in documents(spark, SF001, "benchmark").collect()]
    holds = {i for i in ids(seen[2][1]) if any(f" {x} " in f" {words(rows[i].text)} " for x in items)}
    assert ids(seen[2][1]) - ids(seen[2][2]) >= holds
    assert len(ids(seen[2][1]) - ids(seen[2][2])) <= len(holds) + 2
    # secrets are gone, all else stays
    from tests.llm.test_secret_decontaminate import brute_base
    for r in seen[3][2].collect():
        assert not brute_base(r.text) and r.n_chars == len(r.text)
        if not brute_base(rows[r.doc_id].text):
            assert r.text == rows[r.doc_id].text or "[SECRET]" in r.text
    # all ids are packed
    from tests.llm.test_simhash_packing import check_pieces
    from driftwood.llm.tokens import bpe, default_paths
    encode = bpe(default_paths()).ids
    check_pieces([r.asDict() for r in seen[4][2].collect()], {r.doc_id: len(encode(r.text)) + 1 for r in seen[3][2].collect()})


def test_registered(spark):
    import __spark_entry__ as entry

    names = [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert [int(k[2:].split("_")[0]) for k in queries.QUERIES] == list(range(1, 14)) and set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert "op7_warc" in entry.oracle_sql()

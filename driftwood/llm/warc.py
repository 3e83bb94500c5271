"""Content-addressed WARC archive (operator 7).

``write_archive`` keeps two tables under one folder: ``payloads`` holds every
distinct payload once, under its SHA-256, and ``records`` the exact header
bytes (WARC and HTTP) of every record with the digest of its payload.
``read_archive`` joins them, checks the digest of every payload it reads and gives back the
records; a record's bytes are its headers, the payload (none for a revisit)
and the closing line ends.

Of the records with equal payloads of at least ``revisit_bytes`` bytes, that with the
largest id is the response and the others revisit it; records with smaller
payloads are all responses.

Grouping works on digests and ids, pre-aggregated before the shuffle, payloads too:
a payload that a third of all pages share leaves each task once.  Reading shuffles
payloads only if they are asked for, each once however many records it has.

Defined results: a null payload is empty; null ids order before all others and
a revisit of a record without id refers to null; of repeated rows that are the
largest, one is the response; line ends in a URL are percent-encoded; an empty
table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm.common import written
from driftwood.session import scratch_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EOL = "\r\n"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: 20 bits (5 hex digits) make 4 characters."""
    digest = F.sha1(data)

    def char(k: int) -> Column:
        bits = F.conv(F.substring(digest, k // 4 * 5 + 1, 5), 16, 10).cast("int")
        return F.substring(F.lit(ALPHABET), F.shiftright(bits, 15 - 5 * (k % 4)).bitwiseAND(31) + 1, F.lit(1))

    return F.concat(*[char(k) for k in range(32)])


def _record_id(page_id: Column, nth: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"),
                    nth.cast("string"), F.lit(">"))


def _headers(date: str) -> Column:
    """Header bytes of a record with columns page_id, nth, url, sha1, bytes, revisit, to_id, to_url."""
    def line(name: str, *value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit(EOL))

    url = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(EOL * 2))
    revisit = F.col("revisit")
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("nth"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url(F.col("url"))), line("WARC-Payload-Digest", F.lit("sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", _record_id(F.col("to_id"), F.lit(1))),
            line("WARC-Refers-To-Target-URI", url(F.col("to_url"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit(EOL), http)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` under ``path``."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # identical rows become one with a number, then one record each again
    light = rows.select("page_id", "url", "digest", base32_sha1(F.col("payload")).alias("sha1"),
                        F.octet_length("payload").cast("bigint").alias("bytes"))
    light = written(light.groupBy("digest", "sha1", "bytes", "page_id", "url").agg(F.count("*").alias("n")), "warc-light")
    top = written(light.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("top")).select(
        F.col("digest").alias("to_digest"), F.col("top.page_id").alias("to_id"), F.col("top.url").alias("to_url")), "warc-top")

    at_top = F.col("page_id").eqNullSafe(F.col("to_id")) & F.col("url").eqNullSafe(F.col("to_url"))
    records = light.join(top, F.col("digest") == F.col("to_digest")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth")).withColumn(
        "revisit", (F.col("bytes") >= revisit_bytes) & ~(at_top & (F.col("nth") == 1)))
    records.select("digest", _headers(date).cast("binary").alias("head")).write.parquet(f"{path}/records")

    # equal payloads meet in the partial aggregate first: a task sends each digest once
    stored = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, refers_to, url, head, payload, payload_bytes, record, payload_digest``; fails on a wrong digest.

    ``payload`` is the full payload, of revisits too; ``record`` the record as it stands in a WARC file.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    checked = payloads.select(F.col("digest").alias("_digest"), "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1"),
                              (F.sha2("payload", 256) == F.col("digest")).alias("whole"))
    records = spark.read.schema("digest string, head binary").parquet(f"{path}/records")
    text = F.col("head").cast("string")
    parsed = records.select("digest", "head", field(text, "WARC-Type").alias("record_type"),
                            field(text, "WARC-Record-ID").alias("record_id"), field(text, "WARC-Refers-To").alias("refers"),
                            field(text, "WARC-Target-URI").alias("url"), field(text, "WARC-Payload-Digest").alias("stated"))
    # a record without its payload must fail too, not vanish
    joined = parsed.join(checked, F.col("digest") == F.col("_digest"), "left")
    right = F.coalesce(F.col("whole") & (F.concat(F.lit("sha1:"), "sha1") == F.col("stated")), F.lit(False))
    number = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d+):", 1), F.lit("")).cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("payload digest differs: "), "record_id"))
    # figures are taken before the join: without the payload columns no payload moves
    return joined.select(
        number("record_id").alias("page_id"), "record_type", number("refers").alias("refers_to"), "url", "head",
        F.when(right, F.col("payload")).otherwise(wrong).alias("payload"), "payload_bytes",
        F.concat("head", F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")),
                 F.lit((EOL * 2).encode())).alias("record"), F.when(right, F.col("sha1")).otherwise(wrong).alias("payload_digest"))


def archive_report(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to an archive, read it back and list its records."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(pages, path, **options)
    return read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(s, CAST(k // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""

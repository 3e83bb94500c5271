"""Corpus pipeline: language ID, near-duplicate removal, decontamination, secret removal, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.

ORACLE_SQL is None: compression sizes, SimHash components and online packing
are not expressible in SQL.  ``tests/llm/test_pipeline.py`` compares the stages
with brute-force versions.
"""

from __future__ import annotations

from driftwood.llm import langid
from driftwood.llm.common import documents, written
from driftwood.llm.decontaminate import drop_contaminated
from driftwood.llm.packing import pack
from driftwood.llm.secret_scan import redact_secrets
from driftwood.llm.simhash import drop_near_duplicates


def language_stage(spark, docs, sf_dir):
    """Drops the documents whose language the compression classifier rejects."""
    return langid.keep_identified(docs, langid.train(docs))


def near_duplicate_stage(spark, docs, sf_dir):
    """Keeps one document (the least id) of each group of SimHash near-duplicates."""
    return drop_near_duplicates(docs)


def benchmark_stage(spark, docs, sf_dir):
    """Drops the documents that hold a benchmark question, re-parameterised or not."""
    return drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def secret_stage(spark, docs, sf_dir):
    """Replaces secrets in the texts; ``n_chars`` follows the text. No document goes."""
    return redact_secrets(docs, length_col="n_chars")


def packing_stage(spark, docs, sf_dir):
    """The pieces of the packed token sequences, ids included."""
    return pack(docs, with_ids=True)


STAGES = [("language_id", language_stage), ("simhash_near_dedup", near_duplicate_stage),
          ("benchmark_decontamination", benchmark_stage), ("secret_scan", secret_stage), ("packing", packing_stage)]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs

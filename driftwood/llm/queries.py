"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from driftwood.llm import (blocks, decontaminate, filter_audit, langid, packing, sampling, secret_scan, simhash, substrings,
                           token_counts, training_order, vector_codes, warc)
from driftwood.llm.common import documents


def op1_training_order(spark, sf_dir):
    return training_order.order_report(documents(spark, sf_dir))


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_fingerprints(spark, sf_dir):
    return sampling.fingerprint_edits(documents(spark, sf_dir))


def op4_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


def op5_main_text(spark, sf_dir):
    pages = documents(spark, sf_dir, "pages")
    return blocks.extract(pages, blocks.train(pages))


def op6_repeats(spark, sf_dir):
    return substrings.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op7_warc(spark, sf_dir):
    return warc.archive_report(documents(spark, sf_dir, "pages"))


def op8_secret_scan(spark, sf_dir):
    return secret_scan.secret_report(documents(spark, sf_dir))


def op9_language(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out("doc_id"))
    learned = langid.train(docs.where("not held_out"))
    return langid.identify(docs, learned, keep=("held_out",)).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), cut_runs=True,
                                      wide_names=True)


def op11_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir))


def op12_vector_codes(spark, sf_dir):
    return vector_codes.code_report(documents(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_training_order, op2_simhash, op3_fingerprints, op4_packing, op5_main_text, op6_repeats, op7_warc,
                                   op8_secret_scan, op9_language, op10_decontaminate, op11_token_counts, op12_vector_codes, op13_filter_audit)}
ORACLE: dict[str, str] = {"op6_repeats": substrings.ORACLE, "op7_warc": warc.ORACLE, "op8_secret_scan": secret_scan.ORACLE,
                          "op10_decontaminate": decontaminate.ORACLE, "op12_vector_codes": vector_codes.ORACLE,
                          "op13_filter_audit": filter_audit.ORACLE}

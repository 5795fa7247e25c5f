"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import chat, decontaminate, filter_audit, fingerprint, html_extract, language, lm_score, mixing, neardup, pii, quality, repeats, vector_file
from strata.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs, ~language.held_out_rule()), language.held_out_rule())


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_repeats": op2_repeats, "op3_html": op3_html, "op4_mixing": op4_mixing, "op5_quality": op5_quality, "op6_pii": op6_pii, "op7_fingerprint": op7_fingerprint,
           "op8_neardup": op8_neardup, "op9_language": op9_language, "op10_chat": op10_chat, "op11_filter_audit": op11_filter_audit, "op12_lm_score": op12_lm_score, "op13_centroids": op13_centroids}
ORACLES = {"op1_decontaminate": decontaminate.ORACLE, "op4_mixing": mixing.ORACLE, "op10_chat": chat.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op13_centroids": vector_file.ORACLE}

"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.llm import (
    decontamination,
    html_text,
    language,
    lattice_dedup,
    lattice_lm,
    merkle,
    packing,
    prefix_trie,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from innledger.llm.common import held_out
from innledger.llm.labelled import FOLDS, HELD_OUT_PART
from innledger.llm.oracles import ORACLE  # noqa: F401

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SUBWORDS = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.tokenized_pieces(docs, TOKENIZER)
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.packed(digests)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _predicted(spark: SparkSession, sf_dir: str, classifier) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scores = classifier.scored(docs.select("doc_id", "text"), classifier.trained(docs, labels))
    return scores.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD_OUT_PART).alias("held_out"),
        "score",
        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def _languages(docs: DataFrame) -> DataFrame:
    return language.identified(docs.select("doc_id", "text"), language.trained(docs)).select(
        "doc_id",
        held_out("doc_id", language.FOLDS, language.HELD_OUT_PART).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


QUERIES = {
    "op1_best_fit_packing": lambda spark, sf: pack_documents(_table(spark, sf, "documents")),
    "op2_suffix_array_dedup": lambda spark, sf: suffix_dedup.removal_report(
        _table(spark, sf, "documents")
    ),
    "op3_simhash_near_dedup": lambda spark, sf: _near_duplicates(_table(spark, sf, "documents")),
    "op4_toxicity": lambda spark, sf: _predicted(spark, sf, toxicity),
    "op5_embedding_near_dedup": lambda spark, sf: lattice_dedup.near_duplicates(
        _table(spark, sf, "embeddings")
    ),
    "op6_html_extraction": lambda spark, sf: html_text.extracted(
        _table(spark, sf, "pages").select("page_id", "url", "html")
    ),
    "op7_benchmark_decontamination": lambda spark, sf: decontamination.leaked_pairs(
        _table(spark, sf, "documents"), _table(spark, sf, "benchmark")
    ),
    "op8_quality_classifier": lambda spark, sf: _predicted(spark, sf, quality),
    "op9_language_id": lambda spark, sf: _languages(_table(spark, sf, "documents")),
    "op10_lm_scoring": lambda spark, sf: lattice_lm.scored(
        _table(spark, sf, "documents"), ~held_out("doc_id", 7, 2), SUBWORDS
    ),
    "op11_substring_dedup": lambda spark, sf: substring_dedup.cut(
        _table(spark, sf, "documents").select("doc_id", "text")
    ).drop("text", "kept_text"),
    "op12_merkle_manifest": lambda spark, sf: merkle.tamper_report(
        _table(spark, sf, "documents")
    ),
    "op13_conversation_prefix_trie": lambda spark, sf: prefix_trie.rebuilt_trie(
        _table(spark, sf, "conversations")
    ),
}

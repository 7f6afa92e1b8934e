"""The operators applied to whole tables of the data set."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from verdant.llm import (conversations, hyperlang, linedup, mixing, packing, quality, resample, secrets, setsketch, suffixes, tokens,
                         toxicity, vectorgraph)
from verdant.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return add


@_query("op1_secret_scan")
def secret_query(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word_index", "part", F.sha2("found", 256).alias("finding_sha256"), "length", "score", "is_secret")


@_query("op2_packing", packing.oracle())
def packing_query(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@_query("op3_line_alignment")
def line_query(spark, sf_dir):
    return linedup.line_report(table(spark, sf_dir, "documents"))


@_query("op4_vector_graph", vectorgraph.ORACLE)
def vector_query(spark, sf_dir):
    return vectorgraph.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@_query("op5_quality_rules")
def quality_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = quality.judged(docs, carry=("doc_id",))
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "quality")


@_query("op6_hyperdimensional")
def language_query(spark, sf_dir):
    return hyperlang.identify(table(spark, sf_dir, "documents"))


@_query("op7_suffix_array")
def suffix_query(spark, sf_dir):
    return suffixes.repeated_bytes(table(spark, sf_dir, "documents"), passage_words=51).drop("spans")


@_query("op8_setsketch", setsketch.ORACLE)
def setsketch_query(spark, sf_dir):
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@_query("op9_toxicity")
def toxicity_query(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op10_mixing", mixing.ORACLE.format(documents="documents"))
def mixing_query(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@_query("op11_token_counts")
def token_query(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query("op12_importance_resampling")
def resample_query(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op13_conversation_repair")
def conversation_query(spark, sf_dir):
    return conversations.repair_conversations(conversations.damaged(table(spark, sf_dir, "conversations")))

"""Registered queries of the training-data operators and their DuckDB twins.

Each ``opN_<name>`` applies its operator with production parameters to the
whole intended table.
"""

from __future__ import annotations

from shopsignals.llm import lm_scoring as lm
from shopsignals.llm import quality_crf as crf
from shopsignals.llm import quality_rules as rules
from shopsignals.llm import chat_format, embedding_dup, line_dedup, merkle, mixing, near_dup, packing, whitening
from shopsignals.llm import token_count as tokens
from shopsignals.llm import toxicity as tox
from shopsignals.llm import twins
from shopsignals.llm.common import documents, labels

QUERIES: dict = {}
SQL: dict[str, str] = {"op1_quality_rules": twins.QUALITY_RULES, "op6_template_line_dedup": twins.LINE_DEDUP, "op12_merkle_manifest": twins.MERKLE_MANIFEST}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark, sf_dir):
    return rules.quality_rules(documents(spark, sf_dir))


@query
def op9_token_counts(spark, sf_dir):
    return tokens.token_counts(documents(spark, sf_dir))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query
def op8_source_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@query
def op2_toxicity(spark, sf_dir):
    return tox.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op5_line_crf_quality(spark, sf_dir):
    return crf.quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op7_bottom_k_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(documents(spark, sf_dir), size=4, threshold=80)


@query
def op6_template_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(documents(spark, sf_dir))


@query
def op10_nn_descent_near_dup(spark, sf_dir):
    return embedding_dup.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op4_log_bilinear_scores(spark, sf_dir):
    return lm.lm_scores(documents(spark, sf_dir))


@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.document_manifest(documents(spark, sf_dir))


@query
def op13_chat_formatting(spark, sf_dir):
    return chat_format.chat_formatting(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

"""The registered queries of this subpackage and their SQL twins.

Each ``opN_<name>`` runs its operator with production parameters over the
whole table and derives the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    divergence,
    jaccard_join,
    langid,
    line_dedup,
    lm_scoring,
    mixing,
    pii,
    resample,
    suffix_dedup,
    tokens,
    topk,
    url_cascade,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op7(table(spark, sf_dir, "documents"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op9(table(spark, sf_dir, "documents"))


@query
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.op3(table(spark, sf_dir, "documents"))


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op1(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op5_decontamination"] = decontaminate.ORACLE


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op8(table(spark, sf_dir, "documents"))


@query
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op10(table(spark, sf_dir, "embeddings"), every_row=True)


ORACLE["op10_topk_search"] = topk.ORACLE


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.op2(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op6(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op4(table(spark, sf_dir, "documents"))


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.op11(table(spark, sf_dir, "pages"))


ORACLE["op11_url_filters"] = url_cascade.ORACLE


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.op12(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_importance_resampling"] = resample.ORACLE


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.op13(table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = divergence.ORACLE

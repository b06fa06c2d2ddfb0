"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (clusters, decontaminate, linededup, packing, perplexity, pieces, pii, simhash, spelling, substrings,
               topk, toxicity, urlrep)
from .shared import bounded_batches


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_url_filter": urlrep.op1_url_filter,
        "op2_toxic_passages": toxicity.op2_toxic_passages,
        "op3_sentencepiece": pieces.op3_sentencepiece,
        "op4_exact_top_k": topk.op4_exact_top_k,
        "op5_personal_data": pii.op5_personal_data,
        "op6_line_dedup": linededup.op6_line_dedup,
        "op7_substring_dedup": substrings.op7_substring_dedup,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_quality_classifier": perplexity.op9_quality_classifier,
        "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
        "op11_centroid_clusters": clusters.op11_centroid_clusters,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_best_fit_packing": packing.op13_best_fit_packing,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _bounded(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": urlrep.OP1_SQL,
        "op4_exact_top_k": topk.OP4_SQL,
        "op11_centroid_clusters": clusters.OP11_SQL,
        "op12_spelling_variants": spelling.OP12_SQL,
    }

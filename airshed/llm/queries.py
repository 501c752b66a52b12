"""Queries of this subpackage, one per operator and the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from airshed.llm import (bpe_stream, decontam, fim, line_runs, periodic_runs, quality_rules, secret_scan, sharding,
                         simhash, suffix_dedup, surrogates, wavelet, weak_labels)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.q_simhash,
    "op2_secret_scan": secret_scan.q_secret_scan,
    "op3_quality_rules": quality_rules.q_quality_rules,
    "op4_weak_labels": weak_labels.q_weak_labels,
    "op5_bpe": bpe_stream.q_bpe,
    "op6_decontaminate": decontam.q_decontaminate,
    "op7_suffix_dedup": suffix_dedup.q_suffix_dedup,
    "op8_line_dedup": line_runs.q_line_dedup,
    "op9_token_ids": wavelet.q_token_ids,
    "op10_surrogates": surrogates.q_surrogates,
    "op11_periodic_runs": periodic_runs.q_periodic_runs,
    "op12_fill_in_middle": fim.q_fill_in_middle,
    "op13_shards": sharding.q_shards,
    "pipeline": corpus_pipeline.run,
}

_ORACLES: dict[str, str | None] = {
    "op6_decontaminate": decontam.ORACLE,
    "op8_line_dedup": line_runs.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_shards": sharding.ORACLE,
    "pipeline": corpus_pipeline.ORACLE_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in _ORACLES.items() if sql is not None}

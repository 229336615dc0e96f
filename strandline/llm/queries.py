"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL where it can be stated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import (
    decontamination,
    language_id,
    license_scan,
    lm_score,
    near_dedup,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    suffix_dedup,
    warc_bundles,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    t = _table
    return {
        "op1_decontamination": lambda s, d: decontamination.report(t(s, d, "documents"), t(s, d, "benchmark")),
        "op2_sentencepiece": lambda s, d: sentencepiece_codec.round_trip(t(s, d, "documents"), sentencepiece_codec.default_model()),
        "op3_secret_scan": lambda s, d: secret_scan.report(t(s, d, "documents")),
        "op4_suffix_dedup": lambda s, d: suffix_dedup.report(t(s, d, "documents")),
        "op5_near_dedup": lambda s, d: near_dedup.report(t(s, d, "documents")),
        "op6_warc": lambda s, d: warc_bundles.report(t(s, d, "pages")),
        "op7_license_scan": lambda s, d: license_scan.report(t(s, d, "documents")),
        "op8_language_id": lambda s, d: language_id.report(t(s, d, "documents")),
        "op9_quality_rules": lambda s, d: quality_rules.report(t(s, d, "documents"), t(s, d, "labels")),
        "op10_lm_score": lambda s, d: lm_score.report(t(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.ORACLE,
        "op3_secret_scan": secret_scan.ORACLE,
        "op4_suffix_dedup": suffix_dedup.ORACLE,
        "op5_near_dedup": near_dedup.ORACLE,
        "op6_warc": warc_bundles.ORACLE,
    }

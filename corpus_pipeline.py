"""The corpus pipeline: each stage calls one operator, and what it decides takes effect on the documents that go on.

1. quality: documents that the quality rules reject go.
2. near_duplicates: one document of each group of near duplicates stays.
3. decontamination: documents with a benchmark passage go.
4. secrets: secrets are replaced by a mark; the documents stay.
5. sentencepiece: the remaining texts become piece ids, which decode to the same text.

All stages but the last return the columns of documents; the last returns
doc_id, source, lang, ids, n_pieces and exact (the ids decode to the text).

Null and empty texts are rejected by the quality rules, as are all texts of fewer
than 20 words; rows with a null doc_id are near duplicates of nothing; repeated
rows are one document from the second stage on; an empty table gives no rows;
texts are worked on whole; further columns go through to the fourth stage.

The models and the Hamming join have no SQL form, so ORACLE_SQL is None; the
tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontamination, near_dedup, quality_rules, secret_scan, sentencepiece_codec
from strandline.llm.store import stored


#: Percent of their five-word shingles that near duplicates have in common.
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept(docs, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = sentencepiece_codec.encode_decode(docs, sentencepiece_codec.default_model())
    return both.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("sentencepiece", encode),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each stage's result is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs

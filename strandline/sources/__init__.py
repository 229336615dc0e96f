"""Readers and writers of alignment, sequence, annotation and call-table files."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Make the formats sam, fasta, fai, fastq and rmsk known to spark.read.format(...)."""
    from strandline.sources import formats

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # the sam reader takes chrom and pos filters
    for source in (formats.SamSource, formats.FastaSource, formats.FaiSource, formats.FastqSource, formats.RmskSource):
        spark.dataSource.register(source)

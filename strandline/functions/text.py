"""Column functions on plain text, names and keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import col

DECOYS = ("hs37d5", "MT", "chrMT")


def split_any(s, delimiters: str) -> Column:
    """Split at any of the characters; empty tokens are dropped."""
    return F.filter(F.split(col(s), "[" + re.escape(delimiters) + "]"), lambda t: t != "")


def tokenize(s, delimiter: str) -> Column:
    """Split at a string; empty tokens stay."""
    return F.split(col(s), r"\Q" + delimiter + r"\E", -1)


def trim(s) -> Column:
    return F.regexp_replace(col(s), r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")


def last_place(s, *patterns: str) -> Column:
    """0-based last place of the first pattern that occurs; -1 if none does."""
    text = col(s)
    place = lambda p: F.char_length(text) - F.locate(p[::-1], F.reverse(text)) - len(p) + 1
    return F.coalesce(*[F.when(F.contains(text, F.lit(p)), place(p)) for p in patterns], F.lit(-1))


def with_chr(chrom, wanted) -> Column:
    c = col(chrom)
    return F.when(wanted & ~c.startswith("chr"), F.concat(F.lit("chr"), c)).when(~wanted & c.startswith("chr"), F.substring(c, 4, 1 << 30)).otherwise(c)


def is_decoy(chrom) -> Column:
    return col(chrom).rlike("[_.]") | col(chrom).isin(*DECOYS)


def barcode(s) -> Column:
    return F.replace(col(s), F.lit("-"), F.lit("_"))


def tag(tags, name: str, default) -> Column:
    return F.coalesce(F.try_element_at(col(tags), F.lit(name)), F.lit(default))


def or_none(s) -> Column:
    return F.when(col(s) == "", "none").otherwise(col(s))


def quality_encoding(q) -> Column:
    """SANGER if a code of ! to : is there, ILLUMINA if one of J to h is, else UNKNOWN."""
    return F.when(col(q).rlike("[!-:]"), "SANGER").when(col(q).rlike("[J-h]"), "ILLUMINA").otherwise("UNKNOWN")


def file_format(first_line) -> Column:
    c = F.substring(col(first_line), 1, 1)
    return F.when(c == ">", "FASTA").when(c == "@", "FASTQ").otherwise("OTHER")


def is_gzip(path) -> Column:
    return col(path).endswith(".gz")


def is_discordant(chrom, pos, mate_chrom, mate_pos, threshold: int = 2000) -> Column:
    return (col(chrom) != col(mate_chrom)) | (F.abs(col(mate_pos) - col(pos)) > threshold)


def is_discordant_by_size(chrom, mate_chrom, tlen, size: float, deviation: float) -> Column:
    """False for an unknown mate contig, true for another one, else by the insert size."""
    return F.when(col(mate_chrom) == "*", False).when(col(mate_chrom) != col(chrom), True).otherwise(F.abs(col(tlen)) > size + 3 * deviation)

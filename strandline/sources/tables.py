"""Readers and writers of the text tables, by Spark's own text and CSV sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline import schemas
from strandline.functions import sequence, text


def calls(spark: SparkSession, path: str) -> DataFrame:
    """The call table; header rows (first token `sample`) are left out, and -1 breakpoints are null."""
    rows = spark.read.schema(schemas.CALL).csv(path, sep="\t", mode="PERMISSIVE").where("sample <> 'sample'")
    return rows.withColumns({c: F.nullif(F.col(c), F.lit(-1).cast("long")) for c in ("pbp", "nbp")})


def breakpoints(table: DataFrame) -> DataFrame:
    """chrom and pos: the breakpoint of the side with more clips."""
    return table.select(F.col("chr").alias("chrom"), F.when(F.col("pcr") >= F.col("ncr"), F.col("pbp")).otherwise(F.col("nbp")).alias("pos"))


def sites(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos and features (of repeated sites together, least rows first) from white-space separated lines."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("p"))
    one = rows.select(F.col("p")[0].alias("chrom"), F.col("p")[1].cast("long").alias("pos"), F.slice("p", F.lit(3), F.size("p")).cast("array<int>").alias("f"))
    return one.groupBy("chrom", "pos").agg(F.flatten(F.array_sort(F.collect_list("f"))).alias("features"))


def names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("name"))


def blacklist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, pos long, cov long").csv(path, sep="\t").where("chrom IS NOT NULL")


def genes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GENE).csv(path, sep="\t")


def repeats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPEAT).csv(path, sep="\t")


def blast_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BLAST).csv(path, sep="\t", comment="#")


def fai(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FAI).csv(path, sep="\t")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """value and the order of lines: file, block and row within its split."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", place.alias("place"))


def insert_sizes(spark: SparkSession, path: str, k: float = 3.0) -> DataFrame:
    """read_group, median, sd, isu, isd from lines of read group, median and sd (tab separated); other lines are headers. The last line of a read group counts."""
    f = F.split("value", "\t")
    rows = _numbered(spark, path).select(f[0].alias("read_group"), F.try_element_at(f, F.lit(2)).try_cast("double").alias("median"), F.try_element_at(f, F.lit(3)).try_cast("double").alias("sd"), "place").where("median IS NOT NULL")
    last = rows.groupBy("read_group").agg(F.max_by(F.struct("median", "sd"), "place").alias("v")).select("read_group", "v.*")
    return last.withColumn("isu", F.col("median") + k * F.col("sd") + 1).withColumn("isd", F.col("median") - k * F.col("sd") - 1)


def line_count(spark: SparkSession, path: str, least: int = 0) -> int:
    """Lines with at least so many characters, blanks at the end not counted if `least` is given."""
    return spark.read.text(path).where(F.char_length(F.rtrim("value")) >= least if least else F.lit(True)).count()


def last_line(spark: SparkSession, path: str) -> str | None:
    got = _numbered(spark, path).agg(F.max_by("value", "place").alias("v")).first()
    return got.v


def whole_files(spark: SparkSession, path: str, pattern: str = "") -> DataFrame:
    """path, size and content of the files whose path has the regular expression, in all folders below; content is read only if selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("path").rlike(pattern)).select("path", F.col("length").alias("size"), F.decode("content", "UTF-8").alias("content"))


def read_groups_listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("read_group")).where("read_group <> ''")


def point_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, pos long").csv(path, sep="\t").where("pos IS NOT NULL")


def header_contigs(spark: SparkSession, path: str) -> DataFrame:
    """chrom, len, index (order in the header) and has_chr of the contigs that a SAM header names."""
    rows = _numbered(spark, path).where(F.col("value").startswith("@SQ"))
    field = lambda tag: F.regexp_extract("value", f"\t{tag}:([^\t]+)", 1)
    named = rows.select(field("SN").alias("chrom"), field("LN").cast("long").alias("len"), "place")
    return named.select("chrom", "len", (F.row_number().over(Window.orderBy("place")) - 1).alias("index"), F.col("chrom").startswith("chr").alias("has_chr"))


def with_contig_names(df: DataFrame, contigs: DataFrame, index: str, out: str = "chrom") -> DataFrame:
    """`df` with the name of a contig's index; `*` for an unknown one."""
    return df.join(contigs.select(F.col("index").alias(index), F.col("chrom").alias(out)), index, "left").withColumn(out, F.coalesce(out, F.lit("*")))


def merged_sam(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of several SAM files (column value), with the header of the first one only."""
    first = spark.read.text(paths[0])
    rest = [spark.read.text(p).where(~F.col("value").startswith("@")) for p in paths[1:]]
    return reduce(DataFrame.union, rest, first)


def trimmed_fastq(records: DataFrame) -> DataFrame:
    """name, seq and qual without N at the ends of the bases; a record of N alone keeps one."""
    s = F.col("seq")
    front = F.char_length(F.regexp_extract(s, "^(N*)", 1))
    body = sequence.trim_n(s)
    start = F.when(front == F.char_length(s), 0).otherwise(front)
    return records.select("name", body.alias("seq"), F.substring("qual", start + 1, F.char_length(body)).alias("qual"))


def as_row(kind: Column, layouts: dict[str, list[Column]], other: list[Column]) -> Column:
    """A tab-separated row, whose columns depend on the kind; nulls are left out."""
    line = lambda columns: F.concat_ws("\t", *[c.cast("string") for c in columns])
    out = line(other)
    for name, columns in layouts.items():
        out = F.when(kind == name, line(columns)).otherwise(out)
    return out


def without_zero(df: DataFrame, breakpoints: list[str], kind: str | None = None, simple: tuple[str, ...] = ()) -> DataFrame:
    """Rows without a breakpoint of 0; of simple kinds only the first four count."""
    some = lambda names: reduce(Column.__or__, [F.col(c) == 0 for c in names])
    zero = some(breakpoints)
    if kind:
        zero = F.when(F.col(kind).isin(*simple), some(breakpoints[:4])).otherwise(zero)
    return df.where(~zero)


def contigs(alignments: DataFrame) -> DataFrame:
    """The contigs that alignments are on, and whether their names have the prefix chr."""
    return alignments.where("chrom IS NOT NULL").groupBy("chrom").agg(F.max("pos").alias("last_pos")).withColumn("has_chr", F.col("chrom").startswith("chr"))


def fetch(fasta: DataFrame, regions: DataFrame, name: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Bases of 0-based closed regions, clamped to the contig; swapped ends give the reverse complement, unknown contigs an empty text."""
    both = regions.join(fasta.select(F.col("name").alias(name), F.col("seq").alias("_seq")), name, "left")
    low, high = F.greatest(F.least(start, end), F.lit(0)), F.greatest(start, end)
    bases = F.coalesce(F.substring("_seq", (low + 1).cast("int"), (high - low + 1).cast("int")), F.lit(""))
    return both.withColumn("bases", F.when(F.col(start) > F.col(end), sequence.reverse_complement(bases)).otherwise(bases)).drop("_seq")


def fetch_indexed(path: str, index: DataFrame, regions: DataFrame, name: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """As fetch(), by the index of the FASTA file at `path` (as the format fai gives it): only the regions' own bytes are read.

    The regions need no other columns than these three; repeated ones each count.
    """
    import pyarrow as pa

    from strandline.sources import formats

    place = lambda c: F.col("offset") + F.floor(F.col(c) / F.col("line_blen")) * F.col("line_len") + F.col(c) % F.col("line_blen")
    low, high = F.greatest(F.least(start, end), F.lit(0)), F.least(F.greatest(start, end), F.col("len") - 1)
    both = regions.select(name, start, end).join(index.withColumnRenamed("name", name), name, "left").withColumn("_low", low).withColumn("_high", high)
    some = F.col("_low") <= F.col("_high")
    both = both.withColumn("_from", F.when(some, place("_low"))).withColumn("_size", F.when(some, place("_high") + 1 - F.col("_from"))).select(name, start, end, "_from", "_size")

    def run(batches):
        for batch in batches:
            wanted = zip(batch.column("_from").to_pylist(), batch.column("_size").to_pylist(), strict=True)
            raw = [formats.read_range(path, at, n).decode().replace("\n", "").replace("\r", "") if n else "" for at, n in wanted]
            yield pa.record_batch([*(batch.column(c) for c in (name, start, end)), pa.array(raw, pa.string())], [name, start, end, "bases"])

    types = {f.name: f.dataType.simpleString() for f in both.schema}
    got = both.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in (name, start, end)) + ", bases string")
    return got.withColumn("bases", F.when(F.col(start) > F.col(end), sequence.reverse_complement("bases")).otherwise(F.col("bases")))


def flanks(fasta: DataFrame, sites: DataFrame, extend: int) -> DataFrame:
    """chrom, pos, side and bases: [pos - extend, pos) and [pos + 1, pos + extend); a left flank that begins before the contig is left out."""
    both = sites.join(fasta.select(F.col("name").alias("chrom"), "seq"), "chrom")
    left = F.when(F.col("pos") >= extend, F.struct(F.lit("L").alias("side"), F.substring("seq", (F.col("pos") - extend + 1).cast("int"), F.lit(extend)).alias("bases")))
    right = F.struct(F.lit("R").alias("side"), F.substring("seq", (F.col("pos") + 2).cast("int"), F.lit(extend - 1)).alias("bases"))
    return both.select("chrom", "pos", F.explode(F.filter(F.array(left, right), lambda x: x.isNotNull())).alias("f")).select("chrom", "pos", "f.*")


def as_fastq(name: Column, seq: Column, qual: Column, reverse: Column) -> Column:
    """A FASTQ record; reverse-strand reads are turned back to their own direction."""
    s, q = F.when(reverse, sequence.reverse_complement(seq)).otherwise(seq), F.when(reverse, F.reverse(qual)).otherwise(qual)
    return F.concat(F.lit("@"), name, F.lit("\n"), s, F.lit("\n+\n"), q)


def as_fastq_pair(a: Column, b: Column, suffix: str = "") -> tuple[Column, Column]:
    """Both mates' records, structs of name, seq, qual, reverse and barcode (or null): names get the suffix, _1 or _2 and the barcode."""
    def one(r: Column, n: int) -> Column:
        name = F.concat(r["name"], F.lit(f"{suffix}_{n}"), F.when(r["barcode"].isNotNull(), F.concat(F.lit(" BX:"), r["barcode"])).otherwise(""))
        return as_fastq(name, r["seq"], r["qual"], r["reverse"])

    return one(a, 1), one(b, 2)


def as_fasta(name: Column, seq: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), seq)


def write_lines(lines: DataFrame, path: str, gzip: bool = False) -> None:
    lines.write.mode("overwrite").text(path, compression="gzip" if gzip else "none")


def write_sites(sites: DataFrame, path: str) -> None:
    """Tab-separated sites, without those on decoy contigs."""
    kept = sites.where(~text.is_decoy("chrom"))
    kept.select(F.concat_ws("\t", "chrom", "pos", F.array_join(F.col("features").cast("array<string>"), "\t")).alias("value")).write.mode("overwrite").text(path)

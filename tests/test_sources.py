import gzip

import pytest

from pyspark.sql import functions as F

from strandline import schemas, sources
from strandline.functions import cigar, text
from strandline.operators import relational
from strandline.sources import tables

SAM = """@HD\tVN:1.6
@SQ\tSN:1\tLN:5000
r1\t97\t1\t101\t60\t10S40M\t2\t500\t0\tACGTACGTACAAAA\tIIIIIIIIIIIIII\tBX:Z:AA-1\tHP:i:1
r2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII
r3\t145\t1\t301\t20\t40M9S\t=\t2500\t0\tACGT\tIIII
"""


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sources.register(spark)


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    rows = {r.name: r for r in spark.read.format("sam").load(str(tmp_path)).collect()}
    assert rows["r1"].pos == 100 and rows["r1"].tags == {"BX": "AA-1", "HP": "1"} and rows["r1"].cigar[0] == ("S", 10)
    assert rows["r2"].chrom is None and rows["r2"].next_pos is None and rows["r2"].cigar == []
    assert rows["r3"].next_chrom == "1" and rows["r3"].next_pos == 2499


def test_sam_filters_are_pushed(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    got = spark.read.format("sam").load(str(tmp_path)).where("chrom = '1' AND pos >= 200 AND pos < 400")
    assert [r.name for r in got.collect()] == ["r3"]


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_splits_lose_and_repeat_nothing(spark, tmp_path, size):
    (tmp_path / "a.sam").write_text(SAM)
    (tmp_path / "b.fa").write_text(">x one\nACGT\nAC\n>y\n\nGG\n>z\n")
    assert sorted(r.name for r in spark.read.format("sam").option("splitBytes", size).load(str(tmp_path)).collect()) == ["r1", "r2", "r3"]
    assert sorted(map(tuple, spark.read.format("fasta").option("splitBytes", size).load(str(tmp_path)).collect())) == [("x", "ACGTAC", 6), ("y", "GG", 2), ("z", "", 0)]


def test_gzip_and_fastq(spark, tmp_path):
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write("@r1 x\nACGT\nAC\n+\n@III\nII\n@r2\nA\n+r2\n+\n")
    assert [tuple(r) for r in spark.read.format("fastq").load(str(tmp_path)).collect()] == [("r1", "ACGTAC", "@IIIII"), ("r2", "A", "+")]


def test_rmsk(spark, tmp_path):
    (tmp_path / "r.out").write_text("SW perc\nscore div\n\n100 1.5 0 0 1 100 200 (0) + L1HS LINE/L1 1 100 (5) 1\n90 2.5 0 0 1 300 400 (0) C AluY SINE/Alu (5) 80 7 2\n")
    rows = spark.read.format("rmsk").option("extend", 10).load(str(tmp_path)).orderBy("start").collect()
    assert [(r.start, r.end, r.is_rc, r.cns_start, r.cns_end) for r in rows] == [(90, 210, False, 1, 100), (290, 410, True, 7, 80)]
    assert spark.read.format("rmsk").option("classFilter", "LINE/L1").load(str(tmp_path)).count() == 1


def test_fetch_and_flanks(spark):
    fasta = spark.createDataFrame([("1", "ACGTTTGGCC", 10)], "name string, seq string, len long")
    regions = spark.createDataFrame([("1", 0, 3), ("1", 3, 0), ("1", 8, 99), ("2", 0, 3)], "chrom string, start long, end long")
    assert sorted(r.bases for r in tables.fetch(fasta, regions).collect()) == ["", "ACGT", "ACGT", "CC"]
    sites = spark.createDataFrame([("1", 4), ("1", 1)], "chrom string, pos long")
    assert sorted((r.pos, r.side, r.bases) for r in tables.flanks(fasta, sites, 3).collect()) == [(1, "R", "GT"), (4, "L", "CGT"), (4, "R", "TG")]


def test_scalar_quirks(spark):
    one = spark.createDataFrame([("5S30M2I10D4S", "1", "a.b_a.b")], "c string, chrom string, s string")
    r = one.select(cigar.right_breakpoint("chrom", cigar.parse("c")).alias("a"), cigar.signed_position("chrom", cigar.parse("c"), one.chrom == "1").alias("b"), text.last_place("s", "x", ".b").alias("p"), cigar.longer_clip(cigar.parse("c")).alias("side")).first()
    assert (r.a, r.b, r.p, r.side) == (41, -41, 5, "left")


def test_index_and_fetch_by_it(spark, tmp_path):
    path = tmp_path / "a.fa"
    path.write_text(">x one\nACGTT\nTGGCC\nAAT\n>y\n\n>z\nGG\n")
    index = spark.read.format("fai").load(str(path))
    assert sorted(map(tuple, index.collect())) == [("x", 13, 7, 5, 6), ("y", 0, 26, 0, 1), ("z", 2, 30, 2, 3)]
    rows = [("x", 0, 3), ("x", 3, 0), ("x", 4, 5), ("x", 8, 99), ("x", -5, 1), ("y", 0, 3), ("z", 1, 1), ("w", 0, 3), ("x", 20, 30)]
    regions = spark.createDataFrame(rows, "chrom string, start long, end long")
    key = lambda r: (r.chrom, r.start, r.end, r.bases)
    got = sorted(map(key, tables.fetch_indexed(str(path), index, regions).collect()))
    assert got == sorted(map(key, tables.fetch(spark.read.format("fasta").load(str(path)), regions).collect()))
    assert {r[:3]: r[3] for r in got}[("x", 4, 5)] == "TT" and {r[:3]: r[3] for r in got}[("x", 3, 0)] == "ACGT"
    path.write_text(">x\nACG\nACGT\n")
    with pytest.raises(Exception, match="differ in length"):
        spark.read.format("fai").load(str(path)).collect()


def test_headers_and_merged_files(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    (tmp_path / "b.sam").write_text(SAM.replace("r1", "q1"))
    contigs = tables.header_contigs(spark, str(tmp_path / "a.sam"))
    assert [tuple(r) for r in contigs.collect()] == [("1", 5000, 0, False)]
    named = tables.with_contig_names(spark.createDataFrame([(0,), (7,)], "tid int"), contigs, "tid")
    assert sorted(map(tuple, named.collect())) == [(0, "1"), (7, "*")]
    lines = [r.value for r in tables.merged_sam(spark, [str(tmp_path / f) for f in ("a.sam", "b.sam")]).collect()]
    assert sum(v.startswith("@") for v in lines) == 2 and len(lines) == 8


def test_small_tables(spark, tmp_path):
    (tmp_path / "is.txt").write_text("rg\tmedian\tsd\na\t300\t10\nrg\tmedian\tsd\na\t310\t20\nb\t5\t1\n")
    assert sorted(map(tuple, tables.insert_sizes(spark, str(tmp_path / "is.txt")).collect())) == [("a", 310.0, 20.0, 371.0, 249.0), ("b", 5.0, 1.0, 9.0, 1.0)]
    assert tables.line_count(spark, str(tmp_path / "is.txt")) == 5 and tables.last_line(spark, str(tmp_path / "is.txt")) == "b\t5\t1"
    (tmp_path / "list.txt").write_text("x.bam\n\n  \ny\n")
    assert tables.line_count(spark, str(tmp_path / "list.txt"), 1) == 2 and tables.line_count(spark, str(tmp_path / "list.txt"), 2) == 1
    assert [r.size for r in tables.whole_files(spark, str(tmp_path), r"list\.t.t$").collect()] == [12]
    (tmp_path / "sites.txt").write_text("1 100 3 4\n\n1\t100\t1 2\n2 5\n")
    assert sorted((r.chrom, r.pos, r.features) for r in tables.sites(spark, str(tmp_path / "sites.txt")).collect()) == [("1", 100, [1, 2, 3, 4]), ("2", 5, [])]
    (tmp_path / "names.txt").write_text("r1\n\nr2\n")
    assert sorted(r.name for r in tables.names(spark, str(tmp_path / "names.txt")).collect()) == ["r1", "r2"]
    (tmp_path / "black.txt").write_text("1\t100\t9\n2\t7\t1\n")
    (tmp_path / "points.txt").write_text("1\t200\n")
    points = spark.createDataFrame([("1", 100), ("1", 200), ("2", 8)], "chrom string, pos long")
    black = tables.blacklist(spark, str(tmp_path / "black.txt")).select("chrom", "pos")
    assert [tuple(r) for r in relational.not_listed(points, black, tables.point_list(spark, str(tmp_path / "points.txt"))).collect()] == [("2", 8)]
    rows = spark.createDataFrame([("i", 1, 1, 1, 1, 0), ("t", 1, 1, 1, 1, 0), ("t", 1, 1, 1, 1, 1)], "kind string, a int, b int, c int, d int, e int")
    assert sorted((r.kind, r.e) for r in tables.without_zero(rows, list("abcde"), "kind", ("i",)).collect()) == [("i", 0), ("t", 1)]


def test_records_as_text(spark, tmp_path):
    one = spark.createDataFrame([("r", "NNACN", "!!ABC", "ACGT", "IJKL")], "name string, seq string, qual string, s string, q string")
    assert tuple(tables.trimmed_fastq(one).first()) == ("r", "AC", "AB")
    assert tuple(tables.trimmed_fastq(one.withColumn("seq", F.lit("NNN"))).first())[1] == "N"
    read = lambda reverse: F.struct("name", F.col("s").alias("seq"), F.col("q").alias("qual"), F.lit(reverse).alias("reverse"), F.lit("AA" if reverse else None).cast("string").alias("barcode"))
    a, b = tables.as_fastq_pair(read(False), read(True), "uu1")
    assert tuple(one.select(a.alias("a"), b.alias("b")).first()) == ("@ruu1_1\nACGT\n+\nIJKL", "@ruu1_2 BX:AA\nACGT\n+\nLKJI")
    tables.write_lines(one.select(tables.as_fasta(F.col("name"), F.col("s")).alias("value")), str(tmp_path / "out"), gzip=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == [">r", "ACGT"]
    tables.write_sites(spark.createDataFrame([("1", 5, [1, 2]), ("hs37d5", 6, [3])], "chrom string, pos long, features array<int>"), str(tmp_path / "sites"))
    assert [r.value for r in spark.read.text(str(tmp_path / "sites")).collect()] == ["1\t5\t1\t2"]


def test_call_table(spark, tmp_path):
    fields = schemas.CALL.count(",") + 1
    line = ["s1", "1", "5", "9"] + ["0"] * (fields - 4)
    line[6], line[7], line[15], line[16] = "-1", "77", "1", "4"
    (tmp_path / "calls.txt").write_text("\t".join(["sample"] + ["x"] * (fields - 1)) + "\n" + "\t".join(line) + "\n")
    got = tables.calls(spark, str(tmp_path / "calls.txt"))
    assert got.count() == 1 and got.first().pbp is None
    assert [tuple(r) for r in tables.breakpoints(got).collect()] == [("1", 77)]

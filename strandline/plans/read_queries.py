"""Queries of the read, site and pair operators; the tables stand for alignments, sites and repeat copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions import cigar, kmers, reads, sequence, text
from strandline.operators import intervals, ordered, relational
from strandline.params import Params
from strandline.plans import filter_sites
from strandline.plans.registry import _ACGT, _EV, _SPAN, _events, _orders, query
from strandline.sources import tables

def _bases():
    return F.translate(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 24), "0123456789abcdef", "ACGTACGTACGTACGT")


_CODE = "CAST(list_sum([(strpos('ACGT', substr({0}, i, 1)) - 1) * CAST(power(4, 8 - i) AS BIGINT) FOR i IN range(1, 9)]) AS BIGINT)"
_CLEAN = "NOT regexp_matches(k, 'A{4}|C{4}|G{4}|T{4}')"
_FLAG = "CAST(CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END + CASE WHEN l_quantity > 40 THEN 256 ELSE 0 END + CASE WHEN l_returnflag = 'R' THEN 1024 ELSE 0 END AS BIGINT)"


def _flag():
    return (F.when(F.col("l_linenumber") % 2 == 1, 64).otherwise(128) + F.when(F.col("l_quantity") > 40, 256).otherwise(0) + F.when(F.col("l_returnflag") == "R", 1024).otherwise(0)).cast("long")


# --- functions on bases and codes ---------------------------------------------------


@query(f"""
SELECT p_partkey, length(regexp_replace(s, '[^A]', '', 'g')) > 0.4 * 24 OR length(regexp_replace(s, '[^T]', '', 'g')) > 0.4 * 24 AS poly_at,
  CAST(CASE WHEN regexp_matches(s, 'N|A{{4}}|C{{4}}|G{{4}}|T{{4}}') THEN length(regexp_extract(s, '^(.*?)(N|A{{4}}|C{{4}}|G{{4}}|T{{4}})', 1)) ELSE -1 END AS INT) AS low,
  NOT contains(substr(n, 3, 10), 'N') AS sure, CAST(list_max([length(x) FOR x IN string_split_regex(s, '[^D-Z]')]) AS INT) AS good, CAST(length(regexp_extract(s, '^(A*)', 1)) AS INT) AS lead,
  CAST(CASE WHEN contains(s, 'GAT') THEN length(s) - strpos(reverse(s), 'TAG') - 2 WHEN contains(s, 'A') THEN length(s) - strpos(reverse(s), 'A') ELSE -1 END AS INT) AS last,
  CASE WHEN regexp_extract(s, 'CCC') = '' THEN 'none' ELSE 'CCC' END AS triple
FROM (SELECT *, replace(s, 'GAT', 'N') AS n FROM (SELECT p_partkey, {_ACGT} AS s FROM part))""")
def sequence_tests(t):
    x = t("part").select("p_partkey", _bases().alias("s")).withColumn("n", F.replace("s", F.lit("GAT"), F.lit("N")))
    return x.select("p_partkey", sequence.is_poly_at("s", 0.4).alias("poly_at"), sequence.low_complexity("s").alias("low"), sequence.no_ambiguous("n", 2, 10).alias("sure"), sequence.longest_good_run("s", ord("C")).alias("good"), sequence.leading_run("s", "A").alias("lead"), text.last_place("s", "GAT", "A").alias("last"), text.or_none(F.regexp_extract("s", "CCC", 0)).alias("triple"))


@query(f"""
SELECT p_partkey, concat(chr(CAST(p_size % 40 + 33 AS INT)), chr(CAST(p_size % 7 + 33 AS INT))) AS quals, replace(p_brand, '#', '-') AS bx, 'none' AS hp, replace(p_brand, '#', '_') AS code,
  substr(s, CAST(CASE WHEN p_size % 2 = 0 THEN 24 - p_size % 5 - 6 ELSE p_size % 5 END + 1 AS BIGINT), 6) AS part, CASE WHEN p_brand LIKE '%1' THEN 'FASTA' ELSE 'OTHER' END AS format
FROM (SELECT *, {_ACGT} AS s FROM part)""")
def quality_codes(t):
    bx = F.replace("p_brand", F.lit("#"), F.lit("-"))
    x = t("part").withColumn("s", _bases()).withColumn("tags", F.create_map(F.lit("BX"), bx))
    first = F.when(F.col("p_brand").endswith("1"), ">x").otherwise("x")
    return x.select("p_partkey", sequence.phred_text(F.array((F.col("p_size") % 40).cast("int"), (F.col("p_size") % 7).cast("int"))).alias("quals"), text.tag("tags", "BX", "x").alias("bx"), text.tag("tags", "HP", "none").alias("hp"), text.barcode(text.tag("tags", "BX", "x")).alias("code"), sequence.snip("s", (F.col("p_size") % 5).cast("int"), F.lit(6), F.col("p_size") % 2 == 0).alias("part"), text.file_format(first).alias("format"))


@query(f"""
SELECT p_partkey, code, substr(s, 1, 8) AS back, substr(pre, 1, 8) AS premer, substr(pre, 9, 1) = '0' AS is_forward, CAST(ceil(p_size / 21) AS BIGINT) AS units, coalesce({_CODE.format('m')} * 281474976710656, 0) AS least
FROM (SELECT p_partkey, p_size, s, {_CODE.format('s')} AS code, list_min(list_concat([concat(k, '0') FOR k IN ks IF {_CLEAN}], [concat(reverse(translate(k, 'ACGT', 'TGCA')), '1') FOR k IN ks IF {_CLEAN}])) AS pre,
    list_min([k FOR k IN list_concat([k FOR k IN ks IF {_CLEAN} AND k[1] = 'A'], [reverse(translate(k, 'ACGT', 'TGCA')) FOR k IN ks IF {_CLEAN} AND k[1] = 'A']) IF k[1] IN ('A', 'C')]) AS m
  FROM (SELECT p_partkey, p_size, s, [substr(s, i, 8) FOR i IN range(1, 18)] AS ks FROM (SELECT p_partkey, p_size, {_ACGT} AS s FROM part)))""")
def kmer_codes(t):
    x = t("part").select("p_partkey", "p_size", _bases().alias("s")).withColumn("code", kmers.two_bit(F.substring("s", 1, 8)).cast("long")).withColumn("pre", kmers.premer("s", 8))
    return x.select("p_partkey", "code", kmers.from_two_bit("code", 8).alias("back"), F.col("pre.kmer").alias("premer"), F.col("pre.is_forward").alias("is_forward"), kmers.encoded_length("p_size", 21).alias("units"), kmers.anchored_minimizer("s", 8, "A").cast("long").alias("least"))


@query(f"""
SELECT p_partkey, CAST(CASE WHEN contains(substr(n, o + 8, 5), 'N') THEN o + 12 - strpos(reverse(substr(n, o + 8, 5)), 'N') WHEN contains(substr(n, o + 1, 6), 'N') THEN o + 6 - strpos(reverse(substr(n, o + 1, 6)), 'N') ELSE -1 END AS BIGINT) AS place
FROM (SELECT p_partkey, CAST(p_size % 4 AS BIGINT) AS o, replace({_ACGT}, 'A', 'N') AS n FROM part)""")
def anchors_with_n(t):
    x = t("part").select("p_partkey", (F.col("p_size") % 4).cast("int").alias("o"), F.replace(_bases(), F.lit("A"), F.lit("N")).alias("n"))
    return x.select("p_partkey", reads.anchor_n("n", "o", 6, 5).cast("long").alias("place"))


_CLIPS = "(SELECT l_orderkey, l_linenumber, q, z, n, substr(repeat('ACGGT', 30), 1, n) AS s, CASE WHEN q > z THEN q ELSE n - z END AS cut, l_linenumber % 2 = 0 AS rev FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) % 15 AS q, l_suppkey % 13 AS z, CAST(l_quantity AS BIGINT) % 15 + l_partkey % 60 + 3 + l_suppkey % 13 AS n FROM lineitem))"


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN q > z THEN substr(s, 1, q) WHEN z = 0 THEN '' ELSE right(s, z) END AS kept, q >= 9 AS big, CASE WHEN q = z THEN NULL WHEN rev THEN substr(s, 1, cut) ELSE substr(s, cut + 1) END AS head, CASE WHEN q = z THEN NULL WHEN rev THEN substr(s, cut + 1) ELSE substr(s, 1, cut) END AS tail FROM {_CLIPS}""")
def clip_pieces(t):
    q, p, z = F.col("l_quantity").cast("int") % 15, (F.col("l_partkey") % 60 + 1).cast("int"), (F.col("l_suppkey") % 13).cast("int")
    x = t("lineitem").select("l_orderkey", "l_linenumber", F.substring(F.repeat(F.lit("ACGGT"), F.lit(30)), F.lit(1), q + p + z + 2).alias("s"), cigar.parse(F.concat(q.cast("string"), F.lit("S"), p.cast("string"), F.lit("M2I"), z.cast("string"), F.lit("S"))).alias("c"))
    parts = cigar.clip_parts("s", "c", F.col("l_linenumber") % 2 == 0)
    return x.select("l_orderkey", "l_linenumber", cigar.clip_alignment("s", "s", "c")["seq"].alias("kept"), cigar.is_big_clip("s", F.element_at("c", 1), 9).alias("big"), parts["head"].alias("head"), parts["tail"].alias("tail"))


_PAIRS = f"(SELECT p_partkey, p_size, replace(substr(s, 1, p_size % 25), 'CAT', 'N') AS a, substr(s, 5, p_size % 17 + 3) AS b FROM (SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, {_ACGT} AS s FROM part))"


def _pair_texts(t):
    return t("part").select("p_partkey", F.replace(F.substring(_bases(), F.lit(1), (F.col("p_size") % 25).cast("int")), F.lit("CAT"), F.lit("N")).alias("a"), F.substring(_bases(), F.lit(5), (F.col("p_size") % 17 + 3).cast("int")).alias("b"))


@query(f"""
WITH f AS (
  SELECT p_partkey, 'uu1' AS kind, left(a, 5) AS a, left(b, 5) AS b FROM {_PAIRS} WHERE length(a) >= 5 AND length(b) >= 5
  UNION ALL SELECT p_partkey, 'uu2', right(a, 5), left(b, 5) FROM {_PAIRS} WHERE length(a) >= 10 AND length(b) >= 5
  UNION ALL SELECT p_partkey, 'uu3', left(a, 5), right(b, 5) FROM {_PAIRS} WHERE length(a) >= 5 AND length(b) >= 10
  UNION ALL SELECT p_partkey, 'uu4', right(a, 5), right(b, 5) FROM {_PAIRS} WHERE length(a) >= 10 AND length(b) >= 10
  UNION ALL SELECT p_partkey, 'mu1', a, left(b, 5) FROM {_PAIRS} WHERE length(a) >= 10 AND length(b) >= 5
  UNION ALL SELECT p_partkey, 'mu2', a, right(b, 5) FROM {_PAIRS} WHERE length(a) >= 10 AND length(b) >= 10
  UNION ALL SELECT p_partkey, concat('_', length(a)), left(a, 5), right(a, 5) FROM {_PAIRS} WHERE length(a) >= 10)
SELECT * FROM f WHERE NOT contains(a, 'N') AND NOT contains(b, 'N')""")
def fragment_pairs(t):
    x = _pair_texts(t)
    split = reads.split_read("a", 5, 0)
    one = F.array(F.struct(split["suffix"].alias("kind"), split["left"].alias("a"), split["right"].alias("b")))
    every = F.concat(reads.unmapped_fragments("a", "b", 5, 0), reads.half_mapped_fragments("a", "b", 5, 0), F.when(split.isNotNull(), one).otherwise(F.slice(one, 1, 0)))
    return x.select("p_partkey", F.explode(every).alias("f")).select("p_partkey", "f.*")


# --- reads and mates ---------------------------------------------------------------


@query(f"""
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS INT) AS mate, NOT (f & 1024 > 0 OR f & 256 > 0) AS usable, f & 1024 = 0 AS with_secondary, l_linenumber % 2 = 0 AS pair,
  CASE WHEN l_linestatus = 'F' AND l_linenumber = 3 THEN false WHEN l_linestatus = 'F' AND l_suppkey % 2 = 0 THEN true ELSE abs(l_partkey - 500) > 90 END AS discordant FROM (SELECT *, {_FLAG} AS f FROM lineitem)""")
def pair_flags(t):
    x = t("lineitem").withColumn("f", _flag())
    mate_chrom = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 3), "*").when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 2 == 0), "2").otherwise("1")
    return x.select("l_orderkey", "l_linenumber", reads.mate_number("f").alias("mate"), reads.usable("f").alias("usable"), reads.usable("f", secondary=True).alias("with_secondary"), reads.is_mate_pair("f", F.lit(64)).alias("pair"), text.is_discordant_by_size(F.lit("1"), mate_chrom, F.col("l_partkey") - 500, 60.0, 10.0).alias("discordant"))


@query(f"""
SELECT l_orderkey, arg_max(l_partkey, l_linenumber) FILTER (f & 64 > 0 AND f & 256 = 0) AS first, arg_max(l_partkey, l_linenumber) FILTER (f & 64 > 0 AND f & 256 > 0) AS first_secondary,
  arg_max(l_partkey, l_linenumber) FILTER (f & 64 = 0 AND f & 256 = 0) AS second, arg_max(l_partkey, l_linenumber) FILTER (f & 64 = 0 AND f & 256 > 0) AS second_secondary FROM (SELECT *, {_FLAG} AS f FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)) GROUP BY 1""")
def mate_slots(t):
    x = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.max(c).alias(c) for c in ("l_partkey", "l_quantity", "l_returnflag")]).withColumn("f", _flag())
    bit = lambda b: F.getbit("f", F.lit(b)) == 1
    slots = relational.pair_reads(x, "l_orderkey", bit(6), bit(8), "l_linenumber", ["l_partkey"])
    return slots.select("l_orderkey", *[F.col(f"{s}.l_partkey").alias(s) for s in ("first", "first_secondary", "second", "second_secondary")])


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN q < 10 THEN 'tail' WHEN ho <> 'M' AND to_ = 'M' THEN 'head' END AS one,
  CASE WHEN NOT ((ho = 'M' AND to_ = 'M') OR (ho <> 'M' AND to_ <> 'M')) THEN NULL WHEN q = 0 THEN CASE WHEN hq < tq THEN tn END WHEN hq = tq THEN tn WHEN q < 10 THEN CASE WHEN hq > tq THEN hn ELSE tn END ELSE CASE WHEN hq < tq THEN hn ELSE tn END END AS two
FROM (SELECT *, CASE WHEN ho = 'M' THEN a ELSE c END AS hq, CASE WHEN ho = 'M' THEN b ELSE d END AS tq, CASE WHEN ho = 'M' THEN 'head1' ELSE 'head2' END AS hn, CASE WHEN ho = 'M' THEN 'tail2' ELSE 'tail1' END AS tn
FROM (SELECT l_orderkey, l_linenumber, (l_linenumber - 1) * 5 AS q, CASE WHEN l_partkey % 2 = 0 THEN 'M' ELSE 'S' END AS ho, CASE WHEN l_suppkey % 2 = 0 THEN 'M' ELSE 'S' END AS to_, l_partkey % 3 AS a, l_suppkey % 3 AS b, l_partkey % 4 AS c, l_suppkey % 4 AS d FROM lineitem))""")
def mate_clips(t):
    op = lambda c, other: F.when(F.col(c) % 2 == 0, "M" if not other else "S").otherwise("S" if not other else "M")
    clip = lambda name, o, mapq: F.struct(F.lit(name).alias("name"), o.alias("op"), mapq.alias("mapq"))
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    q = (F.col("l_linenumber") - 1) * 5
    one = reads.mate_clip(q, clip("head", op("l_partkey", False), p), clip("tail", op("l_suppkey", False), s))
    first = F.struct(clip("head1", op("l_partkey", False), p % 3).alias("head"), clip("tail1", op("l_suppkey", True), s % 4).alias("tail"))
    second = F.struct(clip("head2", op("l_partkey", True), p % 4).alias("head"), clip("tail2", op("l_suppkey", False), s % 3).alias("tail"))
    return t("lineitem").select("l_orderkey", "l_linenumber", one["name"].alias("one"), reads.mate_clip_of_two(q, first, second)["name"].alias("two"))


@query(f"SELECT a.event_id, b.sec AS site FROM {_EV} a JOIN (SELECT user_id, sec FROM {_EV} WHERE event_type = 'purchase' UNION ALL SELECT user_id, sec FROM {_EV} WHERE event_type = 'purchase' AND value > 50) b ON a.user_id = b.user_id AND a.sec BETWEEN b.sec - 3600 AND b.sec + 3600")
def mate_lookup_repeated(t):
    e = _events(t)
    one = e.where("event_type = 'purchase'")
    wanted = one.union(one.where("value > 50")).select("user_id", F.col("sec").alias("site"), (F.col("sec") - 3600).alias("low"), (F.col("sec") + 3600).alias("high"))
    return relational.mates_of(e, wanted, ["user_id"], "sec", "low", "high", distinct=False).select("event_id", "site")


@query("SELECT DISTINCT user_id, concat(event_type, '_', CAST(floor(value / 10) AS BIGINT)) AS barcode FROM events WHERE event_type <> 'view'")
def barcodes_at(t):
    code = F.concat("event_type", F.lit("-"), F.floor(F.col("value") / 10).cast("string"))
    x = t("events").withColumn("tags", F.when(F.col("event_type") != "view", F.create_map(F.lit("BX"), code)))
    return relational.barcodes_of(x, ["user_id"])


@query("""
WITH e AS (SELECT event_id, user_id, value, concat(event_type, '_', CAST(floor(value) AS BIGINT)) AS barcode FROM events)
SELECT event_id, barcode FROM e WHERE value < 80 AND barcode IN (SELECT barcode FROM e WHERE user_id < 20)""")
def barcode_reads(t):
    code = F.concat("event_type", F.lit("-"), F.floor("value").cast("string"))
    x = t("events").withColumn("tags", F.create_map(F.lit("BX"), code)).withColumn("flag", F.when(F.col("value") >= 80, 1024).otherwise(0))
    return relational.reads_with(x, relational.barcodes_of(x.where("user_id < 20"), ["user_id"])).select("event_id", "barcode")


@query("SELECT o_orderkey, CAST(floor(o_orderkey / 1000) AS BIGINT) AS shard, o_custkey AS a, o_orderstatus AS b FROM orders")
def mate_shards(t):
    o = t("orders")
    both = relational.fastq_shards(o.select("o_orderkey", "o_custkey"), o.select("o_orderkey", "o_orderstatus"), "o_orderkey", 1000)
    return both.select("o_orderkey", "shard", F.col("a.o_custkey").alias("a"), F.col("b.o_orderstatus").alias("b"))


# --- sites ---------------------------------------------------------------------------


_COUNTS = "(SELECT l_suppkey, l_partkey, count(*) FILTER (l_linenumber % 2 = 1) AS n_left, count(*) FILTER (l_linenumber % 2 = 0) AS n_right, count(*) FILTER (l_returnflag = 'R') AS n_mate FROM lineitem GROUP BY 1, 2)"
_NEAR = f"(SELECT *, sum(n_left) OVER w AS sl, sum(n_right) OVER w AS sr, sum(n_mate) OVER w AS sm FROM {_COUNTS} WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_partkey RANGE BETWEEN 50 PRECEDING AND 49 FOLLOWING))"


@query(f"SELECT l_suppkey, l_partkey, n_left, n_right, n_mate, 'both' AS rule FROM {_NEAR} WHERE sl >= 14 AND sr >= 14 UNION ALL SELECT l_suppkey, l_partkey, n_left, n_right, n_mate, 'one' FROM {_NEAR} WHERE (sl >= 20 OR sr >= 20) AND sm >= 8")
def site_support(t):
    is_ = lambda c: F.count_if(c)
    counts = t("lineitem").groupBy("l_suppkey", "l_partkey").agg(is_(F.col("l_linenumber") % 2 == 1).alias("n_left"), is_(F.col("l_linenumber") % 2 == 0).alias("n_right"), is_(F.col("l_returnflag") == "R").alias("n_mate"))
    both = ordered.supported_sites(counts, ["l_suppkey"], "l_partkey", "n_left", "n_right", 14, 14)
    one = ordered.supported_sites(counts, ["l_suppkey"], "l_partkey", "n_left", "n_right", 20, 20, ["n_mate"], 8)
    return both.withColumn("rule", F.lit("both")).union(one.withColumn("rule", F.lit("one")))


@query("SELECT user_id FROM events GROUP BY 1 HAVING bool_or(event_type = 'click' AND value / 100 <= 0.02) AND bool_or(event_type = 'view' AND value / 100 <= 0.02)")
def rare_sites(t):
    af = lambda kind: F.collect_list(F.when(F.col("event_type") == kind, F.col("value") / 100))
    return relational.rare_in_a_sample(t("events").groupBy("user_id").agg(af("click").alias("clip_af"), af("view").alias("disc_af")), "clip_af", "disc_af", 0.02).select("user_id")


_IN = f"coalesce({{at}} <= (SELECT max(p.sec) FROM {_EV} p WHERE p.user_id = {{user}} AND p.event_type = 'purchase' AND p.sec <= {{at}}) + 3600, false)"


@query(f"SELECT event_id, a OR b AS either_in, a AND b AS both_in FROM (SELECT event_id, {_IN.format(at='c.sec', user='c.user_id')} AS a, {_IN.format(at='c.sec + 900', user='c.mate_user')} AS b FROM (SELECT *, (user_id + 1) AS mate_user FROM {_EV} WHERE event_type = 'click') c)")
def repeat_pairs(t):
    e = _events(t)
    pairs = e.where("event_type = 'click'").select("event_id", "user_id", "sec", (F.col("user_id") + 1).alias("mate_user"), (F.col("sec") + 900).alias("mate_sec"))
    annotation = e.where("event_type = 'purchase'").select("user_id", F.col("sec").alias("start"), (F.col("sec") + 3600).alias("end"))
    return intervals.caused_by_repeats(pairs, annotation, "user_id", "sec", "mate_user", "mate_sec").select("event_id", "either_in", "both_in")


@query("SELECT l_suppkey, min(l_partkey) FILTER (l_linenumber = 1) AS l_low, max(l_partkey) FILTER (l_linenumber = 7) AS r_high FROM lineitem WHERE l_quantity > 30 GROUP BY 1 HAVING count(*) FILTER (l_linenumber = 1) > 0 AND count(*) FILTER (l_linenumber = 7) > 0")
def two_sided(t):
    side = lambda n, f, name: t("lineitem").where((F.col("l_linenumber") == n) & (F.col("l_quantity") > 30)).groupBy("l_suppkey").agg(f("l_partkey").alias(name))
    return relational.both_clip_sides(side(1, F.min, "low"), side(7, F.max, "high"), ["l_suppkey"]).select("l_suppkey", F.col("l.low").alias("l_low"), F.col("r.high").alias("r_high"))


@query("""
SELECT l_suppkey, count(*) FILTER (near) AS n_near, count(*) AS n_all FROM (SELECT l_suppkey, (a - 10 > 0 AND l_partkey BETWEEN a - 10 AND a + 50) OR (a + 90 > 0 AND l_partkey BETWEEN a + 90 AND a + 150) AS near FROM lineitem JOIN (SELECT s_suppkey, s_nationkey AS a FROM supplier) ON s_suppkey = l_suppkey)
GROUP BY 1 HAVING count(*) FILTER (near) / count(*) >= 0.05""")
def mate_windows(t):
    a = F.col("s_nationkey").cast("long")
    sites = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), a.alias("l_start"), (a + 40).alias("l_end"), (a + 100).alias("r_start"), (a + 140).alias("r_end"))
    return relational.consistent_mates(sites, t("lineitem").select("l_suppkey", "l_partkey"), ["l_suppkey"], "l_partkey", 10, 0.05)


@query("""
WITH m AS (SELECT l_suppkey, l_partkey % 400 AS pos, l_linenumber * 30 + 1 AS length, l_quantity AS mapq, l_returnflag = 'R' AS a, concat('k', l_linenumber) AS copy, l_linenumber % 2 = 0 AS rc FROM lineitem),
f AS (SELECT *, ((mapq >= 30 AND pos < 85) OR pos > 235) AND NOT a AS moved, pos + CAST(floor(length / 2) AS BIGINT) AS mid FROM m),
c AS (SELECT l_suppkey, copy, count(*) AS n FROM f WHERE moved GROUP BY 1, 2),
d AS (SELECT l_suppkey, array_to_string(list_sort(list(concat(copy, '~', n))), ',') AS transductions FROM c GROUP BY 1)
SELECT f.l_suppkey, array_to_string(list_sort(list(CASE WHEN rc THEN 160 - mid + 100 ELSE 10 + mid - 100 END) FILTER (NOT moved)), ',') AS positions, count(*) FILTER (a) AS n_polya, any_value(coalesce(transductions, '')) AS transductions FROM f LEFT JOIN d ON f.l_suppkey = d.l_suppkey GROUP BY 1""")
def collected_mates(t):
    n = F.col("l_linenumber")
    mates = t("lineitem").select("l_suppkey", (F.col("l_partkey") % 400).alias("pos"), (n * 30 + 1).alias("length"), F.col("l_quantity").alias("mapq"), (F.col("l_returnflag") == "R").alias("is_polya"), F.concat(F.lit("k"), n.cast("string")).alias("copy"), F.lit(150).alias("copy_length"), (n % 2 == 0).alias("is_rc"), F.lit(10).alias("cns_start"), F.lit(160).alias("cns_end"))
    got = relational.collected_mates(mates, ["l_suppkey"], 100)
    return got.select("l_suppkey", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"), "n_polya", F.array_join("transductions", ",").alias("transductions"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN p_partkey IS NULL THEN -1 WHEN p_size % 2 = 0 THEN p_size + 100 - l_suppkey + 7 ELSE p_size + l_suppkey - 7 END AS cns_pos, p_type AS sub_type, CAST(p_size * 3 AS BIGINT) AS copy_length FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON p_partkey = l_partkey")
def copy_lookup(t):
    size = F.col("p_size").cast("long")
    copies = t("part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 2 == 0).alias("is_rc"), size.alias("cns_start"), (size + 100).alias("cns_end"), F.col("p_type").alias("sub_type"), F.col("p_retailprice").alias("divergence"), size.alias("start"), (size * 4).alias("end"))
    points = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("pos"))
    return relational.subfamilies(relational.lifted(points, copies, ["l_partkey"], "pos", 7), copies, ["l_partkey"]).select("l_orderkey", "l_linenumber", "cns_pos", "sub_type", "copy_length")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_partkey - l_suppkey) <= 20 THEN concat_ws('~', l_returnflag, l_suppkey, l_partkey) ELSE '' END AS call FROM lineitem")
def tsd_calls(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", ordered.tsd_call("l_returnflag", "l_suppkey", "l_partkey", 20).alias("call"))


# --- clusters and calls ------------------------------------------------------------------


@query("""
WITH c AS (SELECT l_suppkey, l_partkey % 300 AS p, count(*) AS n FROM lineitem GROUP BY 1, 2),
i AS (SELECT *, sum(b) OVER (PARTITION BY l_suppkey ORDER BY p) AS island FROM (SELECT *, CASE WHEN p - lag(p) OVER w > 5 AND lag(p) OVER w <> 0 THEN 1 ELSE 0 END AS b FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY p))),
g AS (SELECT l_suppkey, island, sum(n) AS w, count(*) AS d, min(p) AS low, max(p) AS high FROM i GROUP BY 1, 2),
r AS (SELECT *, sum(d) OVER (PARTITION BY l_suppkey) AS every, row_number() OVER (PARTITION BY l_suppkey ORDER BY w DESC, island) AS r FROM g)
SELECT l_suppkey, d / every >= 0.1 AS passed, low, high FROM r WHERE r = 1""")
def consensus_check(t):
    return ordered.cluster_check(t("lineitem").select("l_suppkey", (F.col("l_partkey") % 300).alias("p")), ["l_suppkey"], "p", 5, 0.1)


@query("""
WITH c AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2),
a AS (SELECT l_suppkey, l_partkey, sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_partkey RANGE BETWEEN 8 PRECEDING AND 6 FOLLOWING) AS acm FROM c)
SELECT l_suppkey, l_partkey AS peak1, CAST(acm AS BIGINT) AS acm1 FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY acm DESC, l_partkey) AS r FROM a WHERE l_partkey > 0) WHERE r = 1""")
def peak_window(t):
    return ordered.top_peaks(t("lineitem").select("l_suppkey", "l_partkey", F.lit(1).cast("long").alias("n")), ["l_suppkey"], "l_partkey", "n", 8, 6, 1)


_RAM = "(SELECT *, sum(b) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_partkey RANGE UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN l_partkey - lag(l_partkey) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_partkey) > 3 THEN 1 ELSE 0 END AS b FROM lineitem))"


@query(f"SELECT l_suppkey AS chrom, l_returnflag AS strand, min(l_partkey) AS s, max(l_partkey) AS e, count(*) AS ram, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS families FROM {_RAM} GROUP BY l_suppkey, l_returnflag, island HAVING count(*) >= 3")
def read_clusters(t):
    ram = t("lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_returnflag").alias("strand"), F.col("l_partkey").alias("pos"), F.col("l_linestatus").alias("repeat_family"))
    return filter_sites.cluster_reads(ram, Params(gap_cutoff=3)).select("chrom", "strand", "s", "e", "ram", F.array_join("families", ",").alias("families"))


@query(f"""
WITH i AS (SELECT user_id, sec, w, v, CAST(sum(b) OVER (PARTITION BY user_id ORDER BY sec RANGE UNBOUNDED PRECEDING) AS BIGINT) AS island FROM (SELECT user_id, sec, w, v, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) > 7200 THEN 1 ELSE 0 END AS b FROM (SELECT user_id, sec, count(*) FILTER (event_type = 'click') AS w, count(*) AS v FROM {_EV} GROUP BY 1, 2)))
SELECT user_id, island, sec AS peak FROM (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY w DESC, v DESC, sec) AS r FROM i) WHERE r = 1""")
def island_peak_of_two(t):
    weighed = _events(t).groupBy("user_id", "sec").agg(F.count_if(F.col("event_type") == "click").alias("w"), F.count("*").alias("v"))
    return ordered.island_peaks(weighed, ["user_id"], "sec", 7200, [F.col("w"), F.col("v")])


_CALLS = f"(SELECT o_orderkey AS id, o_custkey, o_orderstatus, s AS a, CASE WHEN o_orderkey % 5 = 0 THEN s ELSE e END AS b FROM (SELECT s.*, o.o_orderstatus FROM {_SPAN} s JOIN orders o ON s.o_orderkey = o.o_orderkey) WHERE o_orderkey % 3 <> 0)"


@query(f"""
WITH c AS {_CALLS}, d AS (SELECT * FROM c WHERE id % 2 = 0), f AS (SELECT * FROM c WHERE id % 2 = 1),
x AS (SELECT 1 AS direction, l.id AS left_id, r.id AS right_id, abs(l.a - r.a) + abs(l.b - r.b) AS delta, r.a AS s FROM d l JOIN f r ON l.o_custkey = r.o_custkey AND l.o_orderstatus = r.o_orderstatus AND l.a <= r.b + 100 AND r.a - 100 <= l.b
  UNION ALL SELECT 2, l.id, r.id, abs(l.a - r.a) + abs(l.b - r.b), r.a FROM f l JOIN d r ON l.o_custkey = r.o_custkey AND l.o_orderstatus = r.o_orderstatus AND l.a <= r.b + 100 AND r.a - 100 <= l.b),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY direction, left_id ORDER BY delta, s, right_id) AS n FROM x) WHERE n = 1),
e AS (SELECT 1 AS direction, id FROM d UNION ALL SELECT 2, id FROM f)
SELECT CAST(e.direction AS INT) AS direction, id AS left_id, right_id, delta, CASE WHEN right_id IS NULL THEN 'D' ELSE 'S' END AS status FROM e LEFT JOIN b ON e.direction = b.direction AND id = left_id""")
def compare_two_ways(t):
    o = _orders(t).join(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    k = F.col("o_orderkey")
    calls = o.select(k.alias("id"), F.col("o_custkey").alias("chr"), F.col("o_orderstatus").alias("repeat_family"), F.col("s").alias("pbp"), F.when(k % 5 != 0, F.col("e")).alias("nbp"), F.when(k % 3 != 0, 5).otherwise(1).alias("conf"))
    one, two = filter_sites.compare_calls(calls.where("id % 2 = 0"), calls.where("id % 2 = 1"))
    return one.withColumn("direction", F.lit(1)).unionByName(two.withColumn("direction", F.lit(2)))


@query("SELECT doc_id, CASE WHEN length(text) = 0 THEN '' ELSE substr(text, 11, 40) END AS bases FROM documents")
def region_fetch(t):
    d = t("documents").where("doc_id IS NOT NULL")
    fasta = d.select(F.col("doc_id").cast("string").alias("name"), F.coalesce("text", F.lit("")).alias("seq"))
    regions = d.select("doc_id", F.col("doc_id").cast("string").alias("chrom"), F.lit(10).cast("long").alias("start"), F.lit(49).cast("long").alias("end"))
    return tables.fetch(fasta, regions).select("doc_id", "bases")

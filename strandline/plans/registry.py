"""Queries over the driver's tables, with the DuckDB SQL that gives the same rows.

The tables stand for coordinate data: any (group, position) pair will do. Days
are days since 1970 and seconds are seconds since then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import cigar, kmers, sequence, text
from strandline.operators import intervals, ordered, relational
from strandline.params import Params
from strandline.plans import filter_sites
from strandline.sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table reader under its name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, d: f(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from strandline.plans import read_queries  # noqa: F401  (registers its own)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from strandline.plans import read_queries  # noqa: F401

    return dict(_SQL)


def _day(c: str) -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("long")


def _orders(t) -> DataFrame:
    return t("orders").select("o_orderkey", "o_custkey", _day("o_orderdate").alias("s"), (_day("o_orderdate") + 30).alias("e"))


def _events(t) -> DataFrame:
    return t("events").select("event_id", "user_id", "event_type", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")).alias("sec"), "value")


_SPAN = "(SELECT o_orderkey, o_custkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS s, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 30 AS BIGINT) AS e FROM orders)"
_EV = "(SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec, value FROM events)"

# --- joins by position ---------------------------------------------------------


@query(f"SELECT a.o_orderkey AS left_key, b.o_orderkey AS right_key FROM {_SPAN} a JOIN {_SPAN} b ON a.o_custkey = b.o_custkey AND a.s <= b.e AND b.s <= a.e AND a.o_orderkey < b.o_orderkey")
def overlap_join(t):
    o = _orders(t)
    return intervals.overlap_join(o, o, ["o_custkey"], ("s", "e"), ("s", "e"), 32).where("l.o_orderkey < r.o_orderkey").select(F.col("l.o_orderkey").alias("left_key"), F.col("r.o_orderkey").alias("right_key"))


@query(
    f"SELECT l.l_orderkey, l.l_linenumber, o.o_orderkey AS span_key FROM (SELECT l_orderkey, l_linenumber, o_custkey, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l JOIN {_SPAN} o ON l.o_custkey = o.o_custkey AND o.s <= l.p AND l.p < o.e"
)
def stab_join(t):
    points = t("lineitem").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_custkey", _day("l_shipdate").alias("p"))
    return intervals.stab_join(points, _orders(t), ["o_custkey"], "p", ("s", "e"), 32).select("l.l_orderkey", "l.l_linenumber", F.col("r.o_orderkey").alias("span_key"))


@query(
    f"SELECT event_id, user_id, sec, start, coalesce(sec <= start + 3600, false) AS in_annotation FROM (SELECT c.event_id, c.user_id, c.sec, (SELECT max(p.sec) FROM {_EV} p WHERE p.user_id = c.user_id AND p.event_type = 'purchase' AND p.sec <= c.sec) AS start FROM {_EV} c WHERE c.event_type = 'click')"
)
def asof_repeat_lookup(t):
    e = _events(t)
    found = intervals.asof_join(e.where("event_type = 'click'").select("event_id", "user_id", "sec"), e.where("event_type = 'purchase'").select("user_id", F.col("sec").alias("start"), (F.col("sec") + 3600).alias("stop")), ["user_id"], "sec", "start", ["stop"])
    return found.select("event_id", "user_id", "sec", "start", F.coalesce(F.col("sec") <= F.col("stop"), F.lit(False)).alias("in_annotation"))


@query(f"""
WITH l AS (SELECT * FROM {_SPAN} WHERE o_orderkey % 2 = 0), r AS (SELECT * FROM {_SPAN} WHERE o_orderkey % 2 = 1),
m AS (SELECT l.o_orderkey AS left_id, r.o_orderkey AS right_id, abs(l.s - r.s) + abs(l.e - r.e) AS delta,
  row_number() OVER (PARTITION BY l.o_orderkey ORDER BY abs(l.s - r.s) + abs(l.e - r.e), r.s, r.o_orderkey) AS n
  FROM l JOIN r ON l.o_custkey = r.o_custkey AND l.s <= r.e + 100 AND r.s - 100 <= l.e)
SELECT l.o_orderkey AS left_id, right_id, delta, CASE WHEN right_id IS NULL THEN 'D' ELSE 'S' END AS status FROM l LEFT JOIN (SELECT * FROM m WHERE n = 1) b ON l.o_orderkey = b.left_id""")
def nearest_match(t):
    o = _orders(t)
    return intervals.nearest_match(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey"], "o_orderkey", ("s", "e"), "o_orderkey", ("s", "e"), 100, 256)


@query("SELECT c_custkey, b AS bin_start, least(b + 90, n) AS bin_end FROM (SELECT c_custkey, n, unnest(range(0, n, 90)) AS b FROM (SELECT c_custkey, CAST(c_custkey % 700 + 1 AS BIGINT) AS n FROM customer))")
def bins(t):
    return intervals.bins(t("customer").select("c_custkey", (F.col("c_custkey") % 700 + 1).cast("long").alias("n")), "c_custkey", "n", 90)


@query(f"""
WITH p AS (SELECT o_orderkey, o_custkey, s, e FROM {_SPAN} WHERE o_orderkey % 2 = 0), m AS (SELECT o_orderkey, o_custkey, s, e FROM {_SPAN} WHERE o_orderkey % 2 = 1),
x AS (SELECT p.o_orderkey AS plus_id, m.o_orderkey AS minus_id FROM p JOIN m ON p.o_custkey = m.o_custkey AND p.s <= m.e + 50 AND m.s - 50 <= p.e)
SELECT plus_id, minus_id, 'pair' AS kind FROM x UNION ALL SELECT o_orderkey, NULL, 'plus' FROM p WHERE o_orderkey NOT IN (SELECT plus_id FROM x) UNION ALL SELECT NULL, o_orderkey, 'minus' FROM m WHERE o_orderkey NOT IN (SELECT minus_id FROM x)""")
def cluster_pairs(t):
    o = _orders(t)
    pairs, plus, minus = intervals.pair_clusters(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey"], "o_orderkey", ("s", "e"), 50, 128)
    none = F.lit(None).cast("long")
    return pairs.withColumn("kind", F.lit("pair")).union(plus.select("o_orderkey", none, F.lit("plus"))).union(minus.select(none, "o_orderkey", F.lit("minus")))


# --- keyed joins -----------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS n FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2)) ON l_orderkey = o_orderkey AND n = 1""")
def merge_last_wins(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    return relational.merge_evidence(t("orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], "l_linenumber", ["l_linenumber", "l_quantity"])


@query(f"""
WITH i AS (SELECT user_id, sec, w, sum(n) OVER (PARTITION BY user_id ORDER BY sec RANGE UNBOUNDED PRECEDING) AS island FROM (SELECT user_id, sec, w, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) > 7200 THEN 1 ELSE 0 END AS n FROM (SELECT user_id, sec, count(*) AS w FROM {_EV} GROUP BY 1, 2))),
p AS (SELECT user_id, island, sec, row_number() OVER (PARTITION BY user_id, island ORDER BY w DESC, sec) AS r FROM i)
SELECT event_id, e.user_id, e.sec FROM {_EV} e WHERE EXISTS (SELECT 1 FROM p WHERE r = 1 AND p.user_id = e.user_id AND p.sec = e.sec)""")
def semi_peaks(t):
    e = _events(t)
    weighed = e.groupBy("user_id", "sec").agg(F.count("*").alias("w"))
    peaks = ordered.island_peaks(weighed, ["user_id"], "sec", 7200, [F.col("w")]).select("user_id", F.col("peak").alias("sec"))
    return e.join(peaks, ["user_id", "sec"], "left_semi").select("event_id", "user_id", "sec")


@query(f"SELECT a.event_id, b.sec AS site FROM {_EV} a JOIN (SELECT DISTINCT user_id, sec FROM {_EV} WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.sec BETWEEN b.sec - 3600 AND b.sec + 3600")
def mate_lookup(t):
    e = _events(t)
    wanted = e.where("event_type = 'purchase'").select("user_id", F.col("sec").alias("site"), (F.col("sec") - 3600).alias("low"), (F.col("sec") + 3600).alias("high"))
    return relational.mates_of(e, wanted, ["user_id"], "sec", "low", "high").select("event_id", "site")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_size IS NULL THEN -1 WHEN p_size % 2 = 0 THEN CAST(p_size + 50 - l_quantity + 10 AS BIGINT) ELSE CAST(p_size + l_quantity - 10 AS BIGINT) END AS lifted FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size < 40")
def consensus_lift(t):
    size = F.col("p_size").cast("long")
    copies = t("part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 2 == 0).alias("is_rc"), size.alias("cns_start"), (size + 50).alias("cns_end"))
    points = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("pos"))
    return relational.lifted(points, copies, ["l_partkey"], "pos", 10, "lifted").drop("pos")


@query("""
WITH l AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' AND value > 50 GROUP BY 1), r AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' AND value > 50 GROUP BY 1)
SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.n, 0) AS left_n, coalesce(r.n, 0) AS right_n FROM l FULL JOIN r ON l.user_id = r.user_id WHERE coalesce(l.n, 0) + coalesce(r.n, 0) >= 3""")
def evidence_full_outer(t):
    side = lambda kind: t("events").where((F.col("event_type") == kind) & (F.col("value") > 50)).groupBy("user_id").agg(F.count("*").alias("n"))
    return relational.both_sides(side("click"), side("view"), ["user_id"], "n", 3)


@query("SELECT user_id, count(*) AS n_samples FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1 HAVING bool_and(n >= 8) AND count(*) >= 5")
def sample_gate(t):
    return relational.sample_gate(t("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ["user_id"], "n", 8, 5)


@query("SELECT l_suppkey, count(*) FILTER (l_quantity BETWEEN 10 AND 30) AS hits, count(*) AS n, round(count(*) FILTER (l_quantity BETWEEN 10 AND 30) / count(*), 6) AS ratio FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_quantity BETWEEN 10 AND 30) / count(*) >= 0.4")
def window_ratio(t):
    per = t("lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_quantity").between(10, 30)).alias("hits"), F.count("*").alias("n"))
    return per.where(F.col("hits") / F.col("n") >= 0.4).withColumn("ratio", F.round(F.col("hits") / F.col("n"), 6))


@query("""
WITH p AS (SELECT l_suppkey, l_partkey, CAST(sum(l_linenumber) AS BIGINT) AS support, count(*) FILTER (l_quantity < 25) AS five, count(*) FILTER (NOT l_quantity < 25) AS three FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY support DESC, l_partkey) AS r FROM p)
SELECT l_suppkey, l_partkey, support, five, three, CASE WHEN five >= three THEN '5' ELSE '3' END AS "end" FROM b WHERE r = 1 AND greatest(five, three) > 1""")
def best_copy(t):
    return relational.best_copy(t("lineitem"), ["l_suppkey"], "l_partkey", F.col("l_linenumber"), F.col("l_quantity") < 25, 1)


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> o_orderstatus OR abs(l_suppkey - o_custkey) > 500")
def discordant_pairs(t):
    both = t("lineitem").join(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.where(text.is_discordant("l_returnflag", "l_suppkey", "o_orderstatus", "o_custkey", 500)).select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 8000)")
def anti_blacklist(t):
    black = t("supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("c_nationkey"))
    return relational.not_listed(t("customer"), black).select("c_custkey", "c_nationkey")


# --- aggregations ------------------------------------------------------------------


@query("SELECT l_suppkey, l_linenumber, count(*) AS n, array_to_string(list_sort(list(l_partkey)), ',') AS positions FROM lineitem GROUP BY 1, 2")
def collect_positions(t):
    return relational.positions_of(t("lineitem"), ["l_suppkey", "l_linenumber"], "l_partkey").withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@query(f"""
WITH c AS (SELECT user_id, count(*) AS n_all, count(*) FILTER (event_type = 'click') AS n_clip, count(*) FILTER (event_type = 'purchase') AS n_disc, count(*) FILTER (value < 60) AS n_near, max(sec) FILTER (value < 60) - min(sec) FILTER (value < 60) AS span FROM {_EV} GROUP BY 1)
SELECT user_id, n_all, n_clip, n_disc, n_near, span, round(least(1.0, n_clip * span / (n_all * 2 * 1000000)), 6) AS clip_af, round(least(1.0, CASE WHEN n_near > 0 THEN n_disc / n_near END), 6) AS disc_af FROM c""")
def allele_fraction(t):
    got = relational.allele_fraction(_events(t), ["user_id"], F.col("event_type") == "click", F.col("event_type") == "purchase", F.col("value") < 60, "sec", 1000000)
    return got.withColumn("clip_af", F.round("clip_af", 6)).withColumn("disc_af", F.round("disc_af", 6))


@query("SELECT l_suppkey, round(sum(l_quantity) * 150 / 100000, 6) AS coverage, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS sd FROM lineitem GROUP BY 1")
def coverage_stat(t):
    got = relational.coverage(t("lineitem"), ["l_suppkey"], "l_quantity", 150, 100000)
    return got.select("l_suppkey", *[F.round(c, 6).alias(c) for c in ("coverage", "mean", "sd")])


@query("""
SELECT o_orderpriority, count(*) AS n, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS kinds, array_to_string(list(o_orderkey ORDER BY o_orderkey) FILTER (r <= 5), ',') AS first_keys
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders) GROUP BY 1""")
def read_group_stats(t):
    o = t("orders")
    first = relational.first_per_key(o.select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], ["o_orderkey"], 5).groupBy("o_orderpriority").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("first_keys"))
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("kinds")).join(first, "o_orderpriority")


@query("SELECT doc_id, list_min(c) AS low, list_max(c) AS high, CASE WHEN regexp_matches(text, '[!-:]') THEN 'SANGER' WHEN regexp_matches(text, '[J-h]') THEN 'ILLUMINA' ELSE 'UNKNOWN' END AS encoding FROM (SELECT doc_id, text, [unicode(x) FOR x IN string_split(text, '')] AS c FROM documents)")
def qual_minmax(t):
    codes = F.transform(F.split("text", ""), lambda x: F.ascii(x))
    return t("documents").select("doc_id", F.array_min(codes).alias("low"), F.array_max(codes).alias("high"), text.quality_encoding("text").alias("encoding"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r FROM lineitem) WHERE r = 1")
def dedup_first(t):
    return relational.first_per_key(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber", "l_partkey"])


@query("SELECT lang, r, doc_id, n FROM (SELECT lang, doc_id, length(text) AS n, row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id) AS r FROM documents WHERE length(text) > 0) WHERE r <= 2")
def longest_per_group(t):
    d = t("documents").withColumn("n", F.char_length("text").cast("long"))
    return relational.longest(d, ["lang"], "text", "doc_id", 2).select("lang", F.col("r").cast("long").alias("r"), "doc_id", "n")


@query("SELECT lang, doc_id, n FROM (SELECT lang, doc_id, length(text) AS n, row_number() OVER (PARTITION BY lang ORDER BY length(text) DESC, doc_id) AS r FROM documents WHERE length(text) > 0) WHERE r = 1")
def longest_of_group(t):
    return relational.longest(t("documents").withColumn("n", F.char_length("text").cast("long")), ["lang"], "text", "doc_id").select("lang", "doc_id", "n")


@query("SELECT vec_id, label, CAST(bit_count(label) AS INT) AS bits, CAST(xor(label, CAST(5 AS INTEGER)) AS INT) AS delta, concat(CASE WHEN label & 1 > 0 THEN 'N' ELSE '' END, CASE WHEN label & 2 > 0 THEN 'A' ELSE '' END, CASE WHEN label & 4 > 0 THEN 'C' ELSE '' END, CASE WHEN label & 8 > 0 THEN 'G' ELSE '' END, CASE WHEN label & 16 > 0 THEN 'T' ELSE '' END) AS bases FROM embeddings")
def bitvector_ops(t):
    return t("embeddings").select("vec_id", "label", F.bit_count("label").alias("bits"), F.col("label").bitwiseXOR(5).alias("delta"), kmers.base_set("label").alias("bases"))


# --- ordered sequences ------------------------------------------------------------------


@query("SELECT event_id, user_id, sum(n) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 50 PRECEDING AND 49 FOLLOWING) AS sum_n FROM (SELECT event_id, user_id, length(event_type) AS n FROM events)")
def neighbour_sum(t):
    e = t("events").select("event_id", "user_id", F.char_length("event_type").cast("long").alias("n"))
    return ordered.neighbour_sums(e, ["user_id"], "event_id", ["n"]).select("event_id", "user_id", "sum_n")


@query("""
WITH c AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2),
a AS (SELECT l_suppkey, l_partkey, sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_partkey RANGE BETWEEN 7 PRECEDING AND 6 FOLLOWING) AS acm FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY acm DESC, l_partkey) AS r FROM a WHERE l_partkey > 0)
SELECT l_suppkey, coalesce(max(l_partkey) FILTER (r = 1), -1) AS peak1, CAST(coalesce(max(acm) FILTER (r = 1), 0) AS BIGINT) AS acm1, coalesce(max(l_partkey) FILTER (r = 2), -1) AS peak2, CAST(coalesce(max(acm) FILTER (r = 2), 0) AS BIGINT) AS acm2 FROM r GROUP BY 1""")
def top2_peaks(t):
    return ordered.top_peaks(t("lineitem").select("l_suppkey", "l_partkey", F.lit(1).cast("long").alias("n")), ["l_suppkey"], "l_partkey", "n")


_ISL = f"(SELECT user_id, sec, w, CAST(sum(b) OVER (PARTITION BY user_id ORDER BY sec RANGE UNBOUNDED PRECEDING) AS BIGINT) AS island FROM (SELECT user_id, sec, w, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) > 7200 THEN 1 ELSE 0 END AS b FROM (SELECT user_id, sec, count(*) AS w FROM {_EV} GROUP BY 1, 2)))"


@query(f"SELECT user_id, island, count(*) AS n, min(sec) AS low, max(sec) AS high FROM {_ISL} GROUP BY 1, 2")
def islands(t):
    marked = ordered.islands(_events(t).select("user_id", "sec").distinct(), ["user_id"], "sec", 7200)
    return marked.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("sec").alias("low"), F.max("sec").alias("high"))


@query(f"SELECT user_id, island, sec AS peak FROM (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY w DESC, sec) AS r FROM {_ISL}) WHERE r = 1")
def island_peak(t):
    return ordered.island_peaks(_events(t).groupBy("user_id", "sec").agg(F.count("*").alias("w")), ["user_id"], "sec", 7200, [F.col("w")])


@query(f"""
WITH a AS (SELECT user_id, sec, count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN CURRENT ROW AND 86400 FOLLOWING) AS c FROM {_EV}),
m AS (SELECT user_id, sec AS start1, c AS count1 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, sec) AS r FROM a) WHERE r = 1),
n AS (SELECT user_id, count(*) AS n FROM {_EV} GROUP BY 1),
b AS (SELECT e.user_id, sec, count(*) OVER (PARTITION BY e.user_id ORDER BY sec RANGE BETWEEN CURRENT ROW AND 86400 FOLLOWING) AS c FROM {_EV} e JOIN m ON e.user_id = m.user_id WHERE sec < start1 OR sec > start1 + 86400),
k AS (SELECT user_id, sec AS start2, c AS count2 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, sec) AS r FROM b) WHERE r = 1)
SELECT m.user_id, n, start1, count1, start2, coalesce(count2, 0) AS count2 FROM m JOIN n ON m.user_id = n.user_id LEFT JOIN k ON m.user_id = k.user_id""")
def max_cover(t):
    return ordered.max_cover(_events(t), ["user_id"], "sec", 86400)


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN abs(l1 - r1) <= 50 THEN l1 WHEN abs(l1 - r2) <= 50 AND abs(l2 - r1) <= 50 THEN (CASE WHEN 4 + q > 3 + 5 THEN l1 ELSE l2 END) WHEN abs(l1 - r2) <= 50 THEN l1 WHEN abs(l2 - r1) <= 50 THEN l2 ELSE l1 END AS l,
  CASE WHEN abs(l1 - r1) <= 50 THEN r1 WHEN abs(l1 - r2) <= 50 AND abs(l2 - r1) <= 50 THEN (CASE WHEN 4 + q > 3 + 5 THEN r2 ELSE r1 END) WHEN abs(l1 - r2) <= 50 THEN r2 WHEN abs(l2 - r1) <= 50 THEN r1 ELSE r1 END AS r,
  abs(l1 - r1) <= 50 OR abs(l1 - r2) <= 50 OR abs(l2 - r1) <= 50 AS has_tsd
FROM (SELECT l_orderkey, l_linenumber, l_suppkey + 1 AS l1, l_partkey % 150 + 1 AS r1, l_partkey % 90 + 1 AS l2, l_orderkey % 120 + 1 AS r2, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""")
def best_combo_tsd(t):
    x = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") + 1).alias("l1"), (F.col("l_partkey") % 150 + 1).alias("r1"), (F.col("l_partkey") % 90 + 1).alias("l2"), (F.col("l_orderkey") % 120 + 1).alias("r2"), F.lit(4).alias("al1"), F.lit(5).alias("ar1"), F.lit(3).alias("al2"), F.col("l_quantity").cast("long").alias("ar2"))
    return x.select("l_orderkey", "l_linenumber", ordered.best_pair("l1", "r1", "l2", "r2", "al1", "ar1", "al2", "ar2").alias("b")).select("l_orderkey", "l_linenumber", "b.*")


# --- sorts and sets ------------------------------------------------------------------------


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def value_sorted_topk(t):
    return t("customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(100)


@query("""
WITH s AS (SELECT user_id, CAST(floor(value) AS BIGINT) AS v, bool_or(event_type = 'click') AS l, bool_or(event_type <> 'click') AS r FROM events GROUP BY 1, 2)
SELECT user_id, count(*) FILTER (l <> r) AS n_differing, count(*) FILTER (l AND r) AS n_common FROM s GROUP BY 1""")
def barcode_diff(t):
    return relational.set_difference(t("events").withColumn("v", F.floor("value")), ["user_id"], F.col("event_type") == "click", "v")


@query("""
SELECT user_id, CASE WHEN a <= 12 THEN a END AS clicks, CASE WHEN b <= 12 THEN b END AS views, CASE WHEN c <= 12 THEN c END AS high
FROM (SELECT user_id, count(DISTINCT CAST(floor(value) AS BIGINT)) FILTER (event_type = 'click') AS a, count(DISTINCT CAST(floor(value) AS BIGINT)) FILTER (event_type = 'view') AS b, count(DISTINCT CAST(floor(value) AS BIGINT)) FILTER (value > 90) AS c FROM events GROUP BY 1)""")
def phased_sets(t):
    e = t("events").withColumn("v", F.floor("value"))
    return relational.capped_sets(e, ["user_id"], "v", {"clicks": F.col("event_type") == "click", "views": F.col("event_type") == "view", "high": F.col("value") > 90}, 12)


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_quantity > 45")
def union_distinct_keys(t):
    return t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k")).union(t("lineitem").where("l_quantity > 45").select("l_orderkey")).distinct()


@query("SELECT o_orderkey AS k, o_custkey AS v, 0 AS sample_id FROM orders UNION ALL SELECT l_orderkey, l_partkey, 1 FROM lineitem")
def tagged_union(t):
    return relational.tagged_union([t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")), t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v"))])


@query("(SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders) EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_pipeline(t):
    o = t("orders").select(F.col("o_custkey").alias("k"), "o_orderpriority")
    return t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")).intersect(o.select("k")).subtract(o.where("o_orderpriority = '1-URGENT'").select("k"))


# --- scalar functions ------------------------------------------------------------------------


@query("SELECT p_partkey, reverse(translate(regexp_replace(upper(p_name), '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA')) AS rc, reverse(p_name) AS rev FROM part")
def revcomp(t):
    return t("part").select("p_partkey", sequence.reverse_complement("p_name").alias("rc"), F.reverse("p_name").alias("rev"))


@query("SELECT page_id, array_to_string([x FOR x IN string_split_regex(url, '[/:.]') IF x <> ''], '|') AS tokens, len(string_split(url, '/')) AS n FROM pages")
def split_drop_empty(t):
    return t("pages").select("page_id", F.array_join(text.split_any("url", "/:."), "|").alias("tokens"), F.size(text.tokenize("url", "/")).cast("long").alias("n"))


@query("SELECT doc_id, length(regexp_replace(concat(' ', text, chr(10)), '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g')) AS n, md5(coalesce(nullif(regexp_replace(concat('N', text, 'NN'), '^N+|N+$', '', 'g'), ''), 'N')) AS body, md5(trim(text, ' ')) AS plain FROM documents")
def trim_ws(t):
    return t("documents").select("doc_id", F.char_length(text.trim(F.concat(F.lit(" "), F.col("text"), F.lit("\n")))).cast("long").alias("n"), F.md5(sequence.trim_n(F.concat(F.lit("N"), F.col("text"), F.lit("NN"))).cast("binary")).alias("body"), F.md5(F.trim("text").cast("binary")).alias("plain"))


@query("SELECT p_partkey, CAST(list_sum([CASE WHEN substr(p_brand, i, 1) <> substr(p_type, i, 1) THEN 1 ELSE 0 END FOR i IN range(1, 6)]) AS INT) AS differing FROM part")
def hamming(t):
    return t("part").select("p_partkey", sequence.hamming("p_brand", "p_type", F.lit(5)).alias("differing"))


@query("SELECT doc_id, regexp_matches(upper(text), 'A{2,}|T{2,}') AS run, regexp_matches(text, 'AAAAA|TTTTT|AATAA|TTATT') AS signal, length(regexp_extract(text, '(\\.*)$', 1)) AS tail FROM documents")
def poly_run(t):
    return t("documents").select("doc_id", sequence.has_poly_at("text", 2).alias("run"), sequence.has_poly_signal("text").alias("signal"), sequence.tail_run("text", r"\.").cast("long").alias("tail"))


@query("SELECT s_suppkey, concat('chr', s_name) AS named, replace(s_name, '#', '_') AS code FROM supplier WHERE NOT regexp_matches(s_name, '[_.]')")
def decoy_filter(t):
    s = t("supplier").where(~text.is_decoy("s_name"))
    return s.select("s_suppkey", text.with_chr("s_name", F.lit(True)).alias("named"), text.barcode(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("code"))


_ACGT = "translate(substr(md5(p_name), 1, 24), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(f"""
SELECT p_partkey, list_min([least(k, reverse(translate(k, 'ACGT', 'TGCA'))) FOR k IN ks IF NOT regexp_matches(k, 'A{{4}}|C{{4}}|G{{4}}|T{{4}}')]) AS minimizer, substr(s, 3, 5) || substr(s, 9, 4) AS anchor
FROM (SELECT p_partkey, s, [substr(s, i, 8) FOR i IN range(1, 18)] AS ks FROM (SELECT p_partkey, {_ACGT} AS s FROM part))""")
def kmer_minimizer(t):
    s = F.translate(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 24), "0123456789abcdef", "ACGTACGTACGTACGT")
    return t("part").select("p_partkey", kmers.minimizer(s, 8).alias("minimizer"), kmers.anchored(s, F.lit(2), 5, 4).alias("anchor"))


@query("""
SELECT l_orderkey, l_linenumber, 1000 + p AS breakpoint, CASE WHEN l_linenumber % 2 = 0 THEN -(1000 + p) ELSE 1000 END AS signed, p >= 0.5 * (q + p + 2 + z) AND NOT (q > 6 AND z > 6) AS qualified, CASE WHEN q > z THEN 'left' WHEN z > q THEN 'right' ELSE 'none' END AS side
FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) % 25 AS q, l_partkey % 60 + 1 AS p, l_suppkey % 13 AS z FROM lineitem)""")
def cigar_eval(t):
    parts = [(F.col("l_quantity").cast("long") % 25).cast("string"), F.lit("S"), (F.col("l_partkey") % 60 + 1).cast("string"), F.lit("M2I"), (F.col("l_suppkey") % 13).cast("string"), F.lit("S")]
    x = t("lineitem").select("l_orderkey", "l_linenumber", F.lit(1000).cast("long").alias("pos"), cigar.parse(F.concat(*parts)).alias("c"))
    return x.select("l_orderkey", "l_linenumber", cigar.right_breakpoint("pos", "c").alias("breakpoint"), cigar.signed_position("pos", "c", F.col("l_linenumber") % 2 == 0).alias("signed"), cigar.is_qualified("c").alias("qualified"), cigar.longer_clip("c").alias("side"))


@query("SELECT doc_id, kind, part FROM (SELECT doc_id, unnest([{'kind': 'uu1', 'part': CASE WHEN n >= 200 THEN substr(text, 1, 25) END}, {'kind': 'uu2', 'part': CASE WHEN n >= 400 THEN right(text, 25) END}, {'kind': 'sc', 'part': CASE WHEN n >= 100 THEN substr(text, 26, 25) END}], recursive := true) FROM (SELECT doc_id, text, length(text) AS n FROM documents)) WHERE part IS NOT NULL")
def fragments(t):
    n = F.char_length("text")
    part = lambda kind, ok, value: F.when(ok, F.struct(F.lit(kind).alias("kind"), value.alias("part")))
    every = F.array(part("uu1", n >= 200, F.substring("text", 1, 25)), part("uu2", n >= 400, F.right("text", F.lit(25))), part("sc", n >= 100, F.substring("text", 26, 25)))
    return t("documents").select("doc_id", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("f")).select("doc_id", "f.*")


@query("SELECT doc_id, unnest(['L', 'R']) AS side, unnest([substr(text, 51, 50), substr(text, 102, 49)]) AS bases FROM documents WHERE length(text) > 150")
def flank_slices(t):
    d = t("documents").where(F.char_length("text") > 150)
    fasta = d.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("seq"))
    sites = d.select(F.col("doc_id").cast("string").alias("chrom"), F.lit(100).cast("long").alias("pos"))
    return tables.flanks(fasta, sites, 50).select(F.col("chrom").cast("long").alias("doc_id"), "side", "bases")


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN concat_ws(chr(9), o_orderstatus, o_orderkey, o_custkey) WHEN o_orderstatus = 'O' THEN concat_ws(chr(9), o_orderstatus, o_custkey, o_orderkey, o_orderpriority) ELSE concat_ws(chr(9), o_orderstatus, o_orderkey) END AS line FROM orders")
def serialise_event(t):
    s, k, c = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_custkey")
    return t("orders").select(tables.as_row(s, {"F": [s, k, c], "O": [s, c, k, F.col("o_orderpriority")]}, [s, k]).alias("line"))


@query("SELECT event_id, user_id FROM events WHERE event_type <> 'view' AND value >= 20")
def filter_calls(t):
    reads = t("events").select("event_id", "user_id", F.when(F.col("event_type") == "view", 1024).otherwise(0).alias("flag"), F.col("value").alias("mapq"), F.array(F.struct(F.lit("M").alias("op"), F.lit(9).alias("len"))).alias("cigar"))
    return filter_sites.usable(reads, Params(min_mapq=20)).select("event_id", "user_id")


@query("""
WITH x AS (SELECT p_partkey, p_name AS a, p_type AS b FROM part),
i AS (SELECT p_partkey, a, b, unnest(range(1, length(a) + 1)) AS i FROM x),
s AS (SELECT p_partkey, i, substr(a, i, n) AS t, n FROM (SELECT p_partkey, a, b, i, unnest(range(1, length(a) - i + 2)) AS n FROM i) WHERE contains(b, substr(a, i, n))),
m AS (SELECT p_partkey, max(n) AS n FROM s GROUP BY 1)
SELECT x.p_partkey, coalesce(string_agg(t, '' ORDER BY i), '') AS common FROM x LEFT JOIN m ON x.p_partkey = m.p_partkey LEFT JOIN s ON s.p_partkey = m.p_partkey AND s.n = m.n GROUP BY 1""")
def longest_common(t):
    return t("part").select("p_partkey", sequence.longest_common("p_name", "p_type").alias("common"))


@query("""
WITH x AS (SELECT p_partkey, concat(p_name, p_type, p_brand) AS q FROM part),
i AS (SELECT p_partkey, q, unnest(range(6, length(q) + 1)) AS i FROM x),
s AS (SELECT p_partkey, i, sum(99 - unicode(substr(q, i, 1))) OVER (PARTITION BY p_partkey ORDER BY i DESC) AS total FROM i),
k AS (SELECT p_partkey, i, total FROM (SELECT *, min(total) OVER (PARTITION BY p_partkey ORDER BY i DESC) AS low FROM s) WHERE low >= 0 AND total > 0),
b AS (SELECT p_partkey, i - 1 AS kept FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY total DESC, i DESC) AS r FROM k) WHERE r = 1)
SELECT x.p_partkey, CAST(coalesce(kept, length(q)) AS INT) AS kept FROM x LEFT JOIN b ON x.p_partkey = b.p_partkey""")
def quality_trim(t):
    return t("part").select("p_partkey", sequence.bwa_trim_length(F.concat("p_name", "p_type", "p_brand"), 66, least=5).alias("kept"))

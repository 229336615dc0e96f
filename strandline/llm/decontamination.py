"""Benchmark decontamination over a distributed positional inverted index.

Texts are ASCII-lower-cased and split into words. A window is WINDOW consecutive
words of a benchmark item (a shorter item is one window). The index stores, for
each test term that serves as an anchor, its positional postings in all training
texts; a posting carries the words around it. For each window the terms are
ordered by how often they are in the corpus, the offset-adjusted posting lists of
its LISTS rarest places are intersected, and what is left is held against the
whole window, so exact phrase matches come out whatever the index holds. Terms
that no training text has rule their windows out. Proximity matches come from
the same index.

Everything is DataFrame operations. Windows and terms are joined by broadcast
only where they are counted to be few; else the joins shuffle by term.

Edge cases: a null or empty text or item has no words: no windows, no hits;
repeated rows are documents of their own; items of equal text are each counted;
an empty table of documents gives no rows, an empty benchmark gives no hits;
null item_ids are left out of the lists. Only doc_id, text, item_id are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import ids_hint, stored

WINDOW = 10
#: Posting lists that are intersected for each window, from the rarest on.
LISTS = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS), "")


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """window (number), terms and items (of equal windows together)."""
    items = benchmark.select("item_id", words().alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(width - 1), F.lit(1)))
    every = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, F.lit(width)))).alias("terms"))
    return every.groupBy("terms").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("window", F.monotonically_increasing_id())


def frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of the terms is in the texts; terms without a place are left out."""
    return docs.select(F.explode(words()).alias("term")).join(ids_hint(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def anchors(tests: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """For each window that can match: its rarest places (term, offset from 0), one row each."""
    places = tests.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term")).join(ids_hint(counts), "term")
    best = (
        places.groupBy("window", "size")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))), 1, lists).alias("best"), F.count("*").alias("found"))
        .where("found = size")
    )
    return best.select("window", F.size("best").alias("lists"), F.explode("best").alias("a")).select("window", "lists", "a.term", "a.offset")


def index(docs: DataFrame, terms: DataFrame, around: int = WINDOW - 1) -> DataFrame:
    """The stored postings of the terms: (row, doc_id, term, pos from 1, first, near), near: the words from place first on.

    Each document also has a posting of the empty term, whose pos is its number of words and whose mark is a hash of its text.
    """
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("mark"), words().alias("w")).withColumn("n", F.size("w"))
    places = texts.select("*", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("at", "term"))
    first = F.greatest(F.col("at") + 1 - around, F.lit(1))
    near = F.when(F.col("term") == "", F.array().cast("array<string>")).otherwise(F.slice("w", first, F.lit(2 * around + 1)))
    pos = F.when(F.col("term") == "", F.col("n")).otherwise(F.col("at") + 1)
    wanted = stored(terms.select("term").union(docs.sparkSession.sql("SELECT '' AS term")).distinct(), "decontamination-terms")
    mark = F.when(F.col("term") == "", F.col("mark"))
    return stored(places.join(ids_hint(wanted), "term").select("row", "doc_id", "term", pos.alias("pos"), first.alias("first"), near.alias("near"), mark.alias("mark")), "decontamination-index")


def phrases(postings: DataFrame, tests: DataFrame, places: DataFrame) -> DataFrame:
    """(row, doc_id, window, start from 1, size) of all exact occurrences of the windows."""
    lists = places.join(tests.select("window", "terms"), "window")
    lists = stored(lists, "decontamination-lists")
    shifted = postings.join(ids_hint(lists), "term").withColumn("start", F.col("pos") - F.col("offset")).where(F.col("start") >= F.col("first"))
    same = F.slice("near", F.col("start") - F.col("first") + 1, F.size("terms")) == F.col("terms")
    met = shifted.groupBy("row", "doc_id", "window", "start", "lists").agg(F.count_distinct("offset").alias("met"), F.bool_and(same).alias("same"), F.max(F.size("terms")).alias("size"))
    return met.where((F.col("met") == F.col("lists")) & F.col("same")).select("row", "doc_id", "window", "start", "size")


def proximity(postings: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """(row, doc_id, pos, other) where the index has `first` at pos and `second` at most `within` words away, on either side."""
    a = postings.where(F.col("term") == first).select("row", "doc_id", "pos")
    b = postings.where(F.col("term") == second).select("row", F.col("pos").alias("other"))
    left = a.withColumn("cell", F.floor(F.col("pos") / within))
    cell = F.floor(F.col("other") / within)
    right = b.select("row", "other", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    near = F.abs(F.col("pos") - F.col("other")) <= within
    return left.join(right, ["row", "cell"]).where(near & (F.col("pos") != F.col("other"))).select("row", "doc_id", "pos", "other")


def covered(intervals: Column) -> Column:
    """How many places the (start, size) intervals cover."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(intervals),
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(x["start"], acc["end"]))).cast("long").alias("n"),
            F.greatest(acc["end"], (x["start"] + x["size"]).cast("long")).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, mark (a hash of the text), n_words, n_hit, items (sorted), for every document."""
    tests = stored(windows(benchmark, width), "decontamination-windows")
    terms = stored(tests.select(F.explode("terms").alias("term")).distinct(), "decontamination-vocabulary")
    counts = stored(frequencies(docs, terms), "decontamination-frequencies")
    places = stored(anchors(tests, counts), "decontamination-anchors")
    postings = index(docs, places.select("term").distinct(), width - 1)
    hits = phrases(postings.where(F.col("term") != ""), tests, places)
    hits = hits.join(ids_hint(tests.select("window", "items")), "window").select("row", "doc_id", F.lit(None).cast("long").alias("words"), F.lit(None).cast("long").alias("mark"), F.struct("start", "size").alias("at"), "items")
    every = postings.where(F.col("term") == "").select("row", "doc_id", F.col("pos").cast("long").alias("words"), "mark", F.lit(None).cast("struct<start:int,size:int>").alias("at"), F.lit(None).cast("array<string>").alias("items"))
    return (
        every.unionByName(hits)
        .groupBy("row", "doc_id")
        .agg(F.max("words").alias("n_words"), F.max("mark").alias("mark"), F.collect_set("at").alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .select("doc_id", "mark", "n_words", covered(F.col("at")).alias("n_hit"), "items")
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = contamination(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any benchmark passage, with its columns; each row by its own text, whatever its doc_id."""
    hit = stored(contamination(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("_id"), "mark").distinct(), "decontamination-hits")
    hit = ids_hint(hit)
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["mark"]), "left_anti").select(*docs.columns)


ORACLE = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + 9), ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM dw, sizes)),
hits AS (SELECT doc_id, s, r.size, item_id FROM runs r JOIN windows USING (win) WHERE r.size = windows.size),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

"""Joins by position: overlap, stabbing, as-of and nearest. None plans a nested loop: all are equi-joins on keys and bins or windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_of(pos: Column, width: int) -> Column:
    return F.floor(pos / width).cast("long")


def _on(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], l_span: tuple[str, str], r_span: tuple[str, str], width: int, closed: bool = True) -> DataFrame:
    """Pairs of rows whose spans overlap, as columns of `l` and `r` structs.

    Both sides are put into bins of `width` (about the usual length of a span) and
    joined by keys and bin; a pair counts in the first bin that both have, so it
    comes out once. closed: spans have both their ends, else not the right one.
    """
    side = lambda df, span, name: df.select(*keys, F.struct(*df.columns).alias(name), bin_of(F.col(span[0]), width).alias(f"_{name}"), F.explode(F.sequence(bin_of(F.col(span[0]), width), F.greatest(bin_of(F.col(span[1]), width), bin_of(F.col(span[0]), width)))).alias("_bin"))
    a, b = side(left, l_span, "l"), side(right, r_span, "r")
    ls, le, rs, re = (F.col(f"{n}.{c}") for n, c in (("l", l_span[0]), ("l", l_span[1]), ("r", r_span[0]), ("r", r_span[1])))
    meets = (le >= rs) & (ls <= re) if closed else (le > rs) & (ls < re)
    return a.join(b, [*keys, "_bin"]).where(meets & (F.col("_bin") == F.greatest("_l", "_r"))).select("l", "r")


def stab_join(points: DataFrame, spans: DataFrame, keys: list[str], point: str, span: tuple[str, str], width: int) -> DataFrame:
    """Pairs (l: point, r: span) with start <= point < stop."""
    a = points.select(*keys, F.struct(*points.columns).alias("l"), bin_of(F.col(point), width).alias("_bin"))
    b = spans.where(F.col(span[1]) > F.col(span[0])).select(*keys, F.struct(*spans.columns).alias("r"), F.explode(F.sequence(bin_of(F.col(span[0]), width), bin_of(F.col(span[1]) - 1, width))).alias("_bin"))
    return a.join(b, [*keys, "_bin"]).where((F.col(f"r.{span[0]}") <= F.col(f"l.{point}")) & (F.col(f"l.{point}") < F.col(f"r.{span[1]}"))).select("l", "r")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], l_at: str, r_at: str, values: list[str], prefix: str = "", width: int = 1 << 20) -> DataFrame:
    """Each left row with the values of the last right row at or before it (null without one).

    Ties among right rows go to the greatest values. A window pass over the union
    by keys and bins of `width`, instead of a join; where a bin has nothing before
    a row, the last right row of the earlier bins counts, from a table with a row
    per key and bin. So a key of many rows is spread over its bins.
    """
    own = F.struct(*left.columns)
    none = lambda df, s: F.lit(None).cast(df.select(s).schema[0].dataType)
    theirs = F.struct(F.col(r_at).cast("long").alias("_at"), F.struct(r_at, *values).alias("_v"))
    a = left.select(*keys, F.col(l_at).cast("long").alias("_at"), F.lit(1).alias("_side"), own.alias("_l"), none(right, theirs).alias("_r"))
    b = right.select(*keys, F.col(r_at).cast("long").alias("_at"), F.lit(0).alias("_side"), none(left, own).alias("_l"), theirs.alias("_r"))
    both = a.unionByName(b).withColumn("_bin", bin_of(F.col("_at"), width))
    w = Window.partitionBy(*keys, "_bin").orderBy("_at", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    earlier = F.last("_m", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    carried = both.groupBy(*keys, "_bin").agg(F.max("_r").alias("_m")).select(*keys, "_bin", earlier.alias("_e")).where("_e IS NOT NULL")
    found = found.join(carried, [*keys, "_bin"], "left").withColumn("_r", F.coalesce("_r", "_e"))
    return found.select("_l.*", *[F.col(f"_r._v.{v}").alias(f"{prefix}{v}") for v in [r_at, *values]])


def within_annotation(points: DataFrame, annotation: DataFrame, keys: list[str], at: str, start: str = "start", end: str = "end") -> DataFrame:
    """`points` with `in_annotation`: the annotation that begins last before a point has it (both ends included)."""
    found = asof_join(points, annotation, keys, at, start, [end], "_a_")
    return found.withColumn("in_annotation", F.coalesce(F.col(at) <= F.col(f"_a_{end}"), F.lit(False))).drop(f"_a_{start}", f"_a_{end}")


def caused_by_repeats(pairs: DataFrame, annotation: DataFrame, key: str, at: str, mate_key: str, mate_at: str) -> DataFrame:
    """`pairs` with `either_in` and `both_in`: whether the read's and the mate's positions are in an annotation (key, start, end)."""
    names = dict(zip(pairs.columns, pairs.columns, strict=True))
    one = within_annotation(pairs, annotation, [key], at).withColumnRenamed("in_annotation", "_one")
    mates = annotation.withColumnRenamed(key, mate_key)
    two = within_annotation(one, mates, [mate_key], mate_at)
    return two.withColumn("either_in", F.col("_one") | F.col("in_annotation")).withColumn("both_in", F.col("_one") & F.col("in_annotation")).select(*names, "either_in", "both_in")


def nearest_match(left: DataFrame, right: DataFrame, keys: list[str], l_id: str, l_span: tuple[str, str], r_id: str, r_span: tuple[str, str], margin: int, width: int) -> DataFrame:
    """Each left row with the nearest right row whose widened span overlaps, as (l_id, r_id, delta, status S or D).

    Nearest is the least sum of both ends' distances; ties go to the least start, then id.
    """
    swap = lambda df, i, span: df.select(*keys, F.col(i).alias("_id"), F.least(*span).alias("_s"), F.greatest(*span).alias("_e"))
    a, b = swap(left, l_id, l_span), swap(right, r_id, r_span)
    wide = b.withColumn("_ws", F.col("_s") - margin).withColumn("_we", F.col("_e") + margin)
    pairs = overlap_join(a, wide, keys, ("_s", "_e"), ("_ws", "_we"), width)
    delta = F.abs(F.col("l._s") - F.col("r._s")) + F.abs(F.col("l._e") - F.col("r._e"))
    best = pairs.select(F.col("l._id").alias("_id"), F.struct(delta.alias("delta"), F.col("r._s").alias("s"), F.col("r._id").alias("id")).alias("m")).groupBy("_id").agg(F.min("m").alias("m"))
    out = left.select(F.col(l_id).alias("_id")).join(best, "_id", "left")
    return out.select(F.col("_id").alias("left_id"), F.col("m.id").alias("right_id"), F.col("m.delta").alias("delta"), F.when(F.col("m").isNull(), "D").otherwise("S").alias("status"))


def bins(contigs: DataFrame, name: str, length: str, size: int) -> DataFrame:
    """(name, bin_start, bin_end) of half-open bins over each contig."""
    return contigs.where(F.col(length) > 0).select(name, F.col(length).alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), F.col(length) - 1, F.lit(size).cast("long"))).alias("bin_start")).select(name, "bin_start", F.least(F.col("bin_start") + size, F.col("_n")).alias("bin_end"))


def pair_clusters(plus: DataFrame, minus: DataFrame, keys: list[str], cid: str, span: tuple[str, str], gap: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs of + and - clusters at most `gap` apart, + ones alone, - ones alone). Own definition."""
    near = minus.withColumn("_s", F.col(span[0]) - gap).withColumn("_e", F.col(span[1]) + gap)
    pairs = overlap_join(plus, near, keys, span, ("_s", "_e"), width).select(F.col(f"l.{cid}").alias("plus_id"), F.col(f"r.{cid}").alias("minus_id"))
    alone = lambda df, side: df.join(pairs.select(F.col(side).alias(cid)).distinct(), cid, "left_anti")
    return pairs, alone(plus, "plus_id"), alone(minus, "minus_id")

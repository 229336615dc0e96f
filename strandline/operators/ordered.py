"""Ordered-sequence operators: neighbourhood sums, peaks, islands and greatest cover.

Windows run by key and bin of positions, not by key alone, so that one key of a
third of all rows is spread over many tasks: rows near a bin's ends are copied to
the bins whose windows they reach, and what goes on from bin to bin (an island's
number) is carried by a table with a row per key and bin. Rows without a position
aren't returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.intervals import bin_of

#: A bin is so many times as wide as what a window reaches.
SPREAD = 256


def _reached(df: DataFrame, pos: str, before: int, after: int) -> DataFrame:
    """`df` with `_bin` for each bin that has a position whose window [p - before, p + after] holds the row's, and `_home`, its own bin."""
    width = SPREAD * (before + after + 1)
    bins = F.sequence(bin_of(F.col(pos) - after, width), bin_of(F.col(pos) + before, width))
    return df.select("*", bin_of(F.col(pos), width).alias("_home"), F.explode(bins).alias("_bin"))


def neighbour_sums(df: DataFrame, keys: list[str], pos: str, values: list[str], before: int = 50, after: int = 49) -> DataFrame:
    """`df` with sum_<value> over the positions from pos - before to pos + after."""
    w = Window.partitionBy(*keys, "_bin").orderBy(pos).rangeBetween(-before, after)
    sums = _reached(df, pos, before, after).select("*", *[F.sum(v).over(w).alias(f"sum_{v}") for v in values])
    return sums.where("_home = _bin").drop("_home", "_bin")


def top_peaks(df: DataFrame, keys: list[str], pos: str, n: str, before: int = 7, after: int = 6, top: int = 2) -> DataFrame:
    """keys, peak1, acm1, peak2, acm2 ...: the positions > 0 with the greatest neighbourhood sums (ties: the least position); -1 and 0 where there is none."""
    counts = df.groupBy(*keys, pos).agg(F.sum(n).alias("_n"))
    near = neighbour_sums(counts, keys, pos, ["_n"], before, after).withColumnRenamed("sum__n", "_acm")
    ranked = near.where(F.col(pos) > 0).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_acm"), pos))).where(F.col("_r") <= top)
    per = ranked.groupBy(*keys).agg(*[x for i in range(1, top + 1) for x in (F.coalesce(F.max(F.when(F.col("_r") == i, F.col(pos))), F.lit(-1)).alias(f"peak{i}"), F.coalesce(F.max(F.when(F.col("_r") == i, F.col("_acm"))), F.lit(0)).alias(f"acm{i}"))])
    return per


def islands(df: DataFrame, keys: list[str], pos: str, gap: int, out: str = "island", keep_zero: bool = False) -> DataFrame:
    """`df` with the number of its island: a new one begins where the distance to the one before is over `gap`.

    keep_zero: a position 0 doesn't end its island, as in the consensus check.
    """
    binned = df.withColumn("_bin", bin_of(F.col(pos), SPREAD * (gap + 1))).where("_bin IS NOT NULL")
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    last = binned.groupBy(*keys, "_bin").agg(F.max(pos).alias("_last")).withColumn("_before", F.lag("_last").over(by_bin)).drop("_last")
    w = Window.partitionBy(*keys, "_bin").orderBy(pos)
    before = F.coalesce(F.lag(pos).over(w), F.col("_before"))
    new = before.isNotNull() & (F.col(pos) - before > gap)
    if keep_zero:
        new = new & (before != 0)
    marked = binned.join(last, [*keys, "_bin"]).withColumn("_new", F.coalesce(new, F.lit(False)).cast("int")).drop("_before")
    marked = marked.withColumn("_in", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    total = marked.groupBy(*keys, "_bin").agg(F.sum("_new").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return marked.join(total, [*keys, "_bin"]).withColumn(out, F.col("_in") + F.col("_base")).select(*df.columns, out)


def island_peaks(df: DataFrame, keys: list[str], pos: str, gap: int, weight: list[Column]) -> DataFrame:
    """keys, island, peak: each island's position of the greatest weight (lexicographic; ties: the least position), 0 if all weigh nothing."""
    marked = islands(df, keys, pos, gap).withColumn("_w", F.struct(*[w.alias(f"w{i}") for i, w in enumerate(weight)]))
    best = marked.groupBy(*keys, "island").agg(F.max_by(F.col(pos), F.struct("_w", -F.col(pos))).alias("peak"), F.max("_w").alias("_w"))
    nothing = F.coalesce(sum((F.col(f"_w.w{i}") for i in range(len(weight))), F.lit(0)) == 0, F.lit(True))
    return best.select(*keys, "island", F.when(nothing, 0).otherwise(F.col("peak")).alias("peak"))


def max_cover(df: DataFrame, keys: list[str], pos: str, win: int) -> DataFrame:
    """keys, n, start1, count1, start2, count2: the leftmost window [p, p + win] with the most points, and again without its points."""
    rows = df.select(*keys, F.col(pos).alias("_p"))

    def first(points: DataFrame, i: int) -> DataFrame:
        counts = neighbour_sums(points.groupBy(*keys, "_p").agg(F.count("*").alias("_n")), keys, "_p", ["_n"], 0, win)
        return counts.withColumnRenamed("sum__n", "_c").groupBy(*keys).agg(F.max(F.struct("_c", -F.col("_p"))).alias("_m"), F.sum("_n").alias("n")).select(*keys, "n", (-F.col("_m.col2")).alias(f"start{i}"), F.col("_m._c").alias(f"count{i}"))

    one = first(rows, 1)
    rest = rows.join(one, keys).where((F.col("_p") < F.col("start1")) | (F.col("_p") > F.col("start1") + win)).select(*keys, "_p")
    return one.join(first(rest, 2).drop("n"), keys, "left").select(*keys, "n", "start1", "count1", "start2", F.coalesce("count2", F.lit(0)).alias("count2"))


def cluster_check(df: DataFrame, keys: list[str], pos: str, gap: int, ratio: float) -> DataFrame:
    """keys, passed, low, high: the heaviest island of positions, and whether it has `ratio` of the distinct ones."""
    counts = df.groupBy(*keys, pos).agg(F.count("*").alias("_n"))
    marked = islands(counts, keys, pos, gap, keep_zero=True)
    per = marked.groupBy(*keys, "island").agg(F.sum("_n").alias("_w"), F.count("*").alias("_d"), F.min(pos).alias("low"), F.max(pos).alias("high"))
    all_ = per.groupBy(*keys).agg(F.max(F.struct("_w", (-F.col("island")).alias("i"), "_d", "low", "high")).alias("m"), F.sum("_d").alias("d"))
    return all_.select(*keys, (F.col("m._d") / F.col("d") >= ratio).alias("passed"), "m.low", "m.high")


def best_pair(l1, r1, l2, r2, al1, ar1, al2, ar2, tsd: int = 50) -> Column:
    """(l, r, has_tsd) of the peaks that are at most `tsd` apart: the first ones, else the crossed pair of the greater sums (ties: l2, r1)."""
    c = F.col
    near = lambda a, b: (F.abs(c(a) - c(b)) <= tsd) & (c(a) > 0) & (c(b) > 0)
    pick = lambda a, b, ok: F.struct(c(a).alias("l"), c(b).alias("r"), F.lit(ok).alias("has_tsd"))
    both = near(l1, r2) & near(l2, r1)
    return (
        F.when(near(l1, r1), pick(l1, r1, True))
        .when(both, F.when(c(al1) + c(ar2) > c(al2) + c(ar1), pick(l1, r2, True)).otherwise(pick(l2, r1, True)))
        .when(near(l1, r2), pick(l1, r2, True))
        .when(near(l2, r1), pick(l2, r1, True))
        .otherwise(pick(l1, r1, False))
    )


def supported_sites(counts: DataFrame, keys: list[str], pos: str, left: str, right: str, least_left: int, least_right: int, mates: list[str] | None = None, least_mates: int = 0) -> DataFrame:
    """The rows of clip counts by position whose neighbourhood has enough clips: on both sides, or, where mate counts are named, on one side and enough mates."""
    mates = mates or []
    near = neighbour_sums(counts, keys, pos, [left, right, *mates])
    l, r = F.col(f"sum_{left}") >= least_left, F.col(f"sum_{right}") >= least_right
    enough = (l | r) & (sum((F.col(f"sum_{m}") for m in mates), F.lit(0)) >= least_mates) if mates else l & r
    return near.where(enough).select(*counts.columns)


def tsd_call(chrom, left, right, most: int) -> Column:
    """chrom~left~right where the sides' positions are at most so far apart; else an empty text."""
    return F.when(F.abs(F.col(right) - F.col(left)) <= most, F.concat_ws("~", F.col(chrom), F.col(left).cast("string"), F.col(right).cast("string"))).otherwise("")

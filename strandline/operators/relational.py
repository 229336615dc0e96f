"""Keyed joins, aggregations and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each key; for one row a partial aggregate does the work, so a hot key isn't gathered."""
    if n == 1 and all(isinstance(o, str) for o in order):
        return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(ordinal)).alias("_row")).select("_row.*")


def merge_evidence(a: DataFrame, b: DataFrame, keys: list[str], ordinal: str, columns: list[str]) -> DataFrame:
    """Rows of `a` with columns of the last row of `b` of the same keys."""
    return a.join(last_wins(b, keys, ordinal).select(*keys, *columns), keys)


def both_sides(left: DataFrame, right: DataFrame, keys: list[str], count: str, least: int) -> DataFrame:
    """keys, left_<count>, right_<count> (0 where a side has none), where both together reach `least`."""
    a, b = left.select(*keys, F.col(count).alias(f"left_{count}")), right.select(*keys, F.col(count).alias(f"right_{count}"))
    both = a.join(b, keys, "full").select(*keys, *[F.coalesce(f"{s}_{count}", F.lit(0)).alias(f"{s}_{count}") for s in ("left", "right")])
    return both.where(F.col(f"left_{count}") + F.col(f"right_{count}") >= least)


def sample_gate(counts: DataFrame, keys: list[str], n: str, least: int, samples: int) -> DataFrame:
    """The keys of which every sample reaches `least` and at least `samples` samples are there."""
    return counts.groupBy(*keys).agg(F.count("*").alias("n_samples"), F.bool_and(F.col(n) >= least).alias("_all")).where(F.col("_all") & (F.col("n_samples") >= samples)).drop("_all")


def best_copy(df: DataFrame, keys: list[str], copy: str, support: Column, vote: Column, least: int) -> DataFrame:
    """Each key's copy of the greatest support (ties: the least copy), with the greater of its votes, where that is over `least`."""
    per = df.groupBy(*keys, copy).agg(F.sum(support).alias("support"), F.sum(vote.cast("long")).alias("five"), F.sum((~vote).cast("long")).alias("three"))
    best = first_per_key(per.withColumn("_minus", -F.col("support")), keys, ["_minus", copy]).drop("_minus")
    return best.withColumn("end", F.when(F.col("five") >= F.col("three"), "5").otherwise("3")).where(F.greatest("five", "three") > least).select(*keys, copy, "support", "five", "three", "end")


def allele_fraction(reads: DataFrame, keys: list[str], is_clip: Column, is_disc: Column, is_near: Column, pos: str, extend: int) -> DataFrame:
    """Per key: counts, span of the near reads, and the clip and discordant fractions (at most 1; null without near reads)."""
    per = reads.groupBy(*keys).agg(
        F.count("*").alias("n_all"),
        F.count_if(is_clip).alias("n_clip"),
        F.count_if(is_disc).alias("n_disc"),
        F.count_if(is_near).alias("n_near"),
        (F.max(F.when(is_near, F.col(pos))) - F.min(F.when(is_near, F.col(pos)))).alias("span"),
    )
    clip = F.least(F.lit(1.0), F.try_divide(F.col("n_clip") * F.col("span"), F.col("n_all") * 2 * extend))
    return per.withColumn("clip_af", clip).withColumn("disc_af", F.least(F.lit(1.0), F.try_divide(F.col("n_disc"), F.col("n_near"))))


def set_difference(df: DataFrame, keys: list[str], side: Column, item: str) -> DataFrame:
    """keys, n_differing (in one side only) and n_common (in both)."""
    per = df.groupBy(*keys, item).agg(F.bool_or(side).alias("_l"), F.bool_or(~side).alias("_r"))
    return per.groupBy(*keys).agg(F.count_if(F.col("_l") != F.col("_r")).alias("n_differing"), F.count_if(F.col("_l") & F.col("_r")).alias("n_common"))


def capped_sets(df: DataFrame, keys: list[str], item: str, kinds: dict[str, Column], cap: int) -> DataFrame:
    """Numbers of distinct items of each kind; null beyond the cap, which is the feature."""
    flags = [F.bool_or(F.coalesce(c, F.lit(False))).alias(k) for k, c in kinds.items()]
    per = df.groupBy(*keys, item).agg(*flags).groupBy(*keys).agg(*[F.count_if(F.col(k)).alias(k) for k in kinds])
    return per.select(*keys, *[F.when(F.col(k) <= cap, F.col(k)).alias(k) for k in kinds])


def tagged_union(parts: list[DataFrame], tag: str = "sample_id") -> DataFrame:
    return reduce(DataFrame.unionByName, [p.withColumn(tag, F.lit(i)) for i, p in enumerate(parts)])


def pair_reads(reads: DataFrame, name: str, is_first: Column, is_secondary: Column, ordinal: str, columns: list[str]) -> DataFrame:
    """One row per read name with the last record of each of its four slots (mate x primary or secondary)."""
    slot = lambda cond: F.max_by(F.when(cond, F.struct(*columns)), F.when(cond, F.col(ordinal)))
    return reads.groupBy(name).agg(slot(is_first & ~is_secondary).alias("first"), slot(is_first & is_secondary).alias("first_secondary"), slot(~is_first & ~is_secondary).alias("second"), slot(~is_first & is_secondary).alias("second_secondary"))


def mates_of(reads: DataFrame, wanted: DataFrame, keys: list[str], pos: str, low: str, high: str, distinct: bool = True) -> DataFrame:
    """Reads with each wanted row of equal keys whose range has their position; repeated wanted rows count once if distinct."""
    return reads.join(wanted.distinct() if distinct else wanted, keys).where(F.col(pos).between(F.col(low), F.col(high)))


def any_at_most(values, limit) -> Column:
    """Whether one of an array's values is at most the limit."""
    return F.coalesce(F.exists(values, lambda x: x <= limit), F.lit(False))


def rare_in_a_sample(sites: DataFrame, clip_af: str, disc_af: str, limit: float) -> DataFrame:
    """Sites of which one sample's clip fraction and one sample's discordant fraction (arrays) are at most the limit."""
    return sites.where(any_at_most(F.col(clip_af), limit) & any_at_most(F.col(disc_af), limit))


def both_clip_sides(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Sites with evidence on both sides, as structs `l` and `r`; others are left out."""
    pack = lambda df, name: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    return pack(left, "l").join(pack(right, "r"), keys)


def consistent_mates(sites: DataFrame, mates: DataFrame, keys: list[str], pos: str, near: int, ratio: float) -> DataFrame:
    """Sites (keys, l_start, l_end, r_start, r_end) of whose mates' positions `ratio` are within `near` of the left or the right window.

    A window that would begin at 0 or before, widened, doesn't count. The result has n_near and n_all.
    """
    def within(side: str) -> Column:
        low, high = F.col(f"{side}_start") - near, F.col(f"{side}_end") + near
        return (low > 0) & F.col(pos).between(low, high)

    met = sites.join(mates, keys).groupBy(*keys).agg(F.count_if(within("l") | within("r")).alias("n_near"), F.count("*").alias("n_all"))
    return met.where(F.col("n_near") / F.col("n_all") >= ratio)


def lifted(points: DataFrame, copies: DataFrame, keys: list[str], pos: str, flank: int, out: str = "cns_pos") -> DataFrame:
    """`points` with the place in the consensus of a position in a repeat's copy with flanks; -1 without that copy.

    `copies` has the keys, is_rc, cns_start and cns_end, one row of each copy.
    """
    both = points.join(copies.select(*keys, "is_rc", "cns_start", "cns_end"), keys, "left")
    there = F.when(F.col("is_rc"), F.col("cns_end") - F.col(pos) + flank).otherwise(F.col("cns_start") + F.col(pos) - flank)
    return both.withColumn(out, F.coalesce(there, F.lit(-1))).drop("is_rc", "cns_start", "cns_end")


def subfamilies(points: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """`points` with sub_type, divergence and copy_length (end - start) of the copy with exactly these keys; null without one."""
    return points.join(copies.select(*keys, "sub_type", "divergence", (F.col("end") - F.col("start")).alias("copy_length")), keys, "left")


def collected_mates(mates: DataFrame, keys: list[str], flank: int, margin: int = 15, least_mapq: int = 30) -> DataFrame:
    """Per key: consensus positions (sorted), n_polya, and transductions as copy~count texts (sorted).

    `mates` has pos (in the copy with its flanks), length, mapq, is_polya, copy,
    copy_length, is_rc, cns_start, cns_end. A mate in a copy's flank (left of it
    only if well mapped) and not of poly-A is a transduction; others are placed on
    the consensus by their middle, as far as their copy is known.
    """
    flanking = (((F.col("mapq") >= least_mapq) & (F.col("pos") < flank - margin)) | (F.col("pos") > F.col("copy_length") + flank - margin)) & ~F.col("is_polya")
    middle = F.col("pos") + F.floor(F.col("length") / 2)
    place = F.when(F.col("is_rc"), F.col("cns_end") - middle + flank).otherwise(F.col("cns_start") + middle - flank)
    rows = mates.withColumn("_t", F.coalesce(flanking, F.lit(False))).withColumn("_p", F.when(~F.col("_t"), place).cast("long"))
    per = rows.groupBy(*keys, F.when(F.col("_t"), F.col("copy")).alias("_copy")).agg(F.collect_list("_p").alias("_p"), F.count_if("is_polya").alias("_a"), F.count("*").alias("_n"))
    moved = F.when(F.col("_copy").isNotNull(), F.concat_ws("~", "_copy", F.col("_n").cast("string")))
    return per.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_p"))).alias("positions"), F.sum("_a").alias("n_polya"), F.array_sort(F.collect_list(moved)).alias("transductions"))


def barcodes_of(reads: DataFrame, keys: list[str], tags: str = "tags") -> DataFrame:
    """keys and barcode: the distinct barcodes (- as _) of each key's reads; reads without one don't count."""
    code = F.replace(F.try_element_at(F.col(tags), F.lit("BX")), F.lit("-"), F.lit("_"))
    return reads.select(*keys, code.alias("barcode")).where("barcode IS NOT NULL").distinct()


def reads_with(reads: DataFrame, barcodes: DataFrame, flag: str = "flag", tags: str = "tags", unmapped: bool = False) -> DataFrame:
    """Usable reads that have one of the barcodes; unmapped ones too if asked for."""
    bad = 1024 | 256 | 2048 | (0 if unmapped else 4)
    code = F.replace(F.try_element_at(F.col(tags), F.lit("BX")), F.lit("-"), F.lit("_"))
    return reads.where(F.col(flag).bitwiseAND(F.lit(bad)) == 0).withColumn("barcode", code).join(barcodes.select("barcode").distinct(), "barcode")


def longest(df: DataFrame, keys: list[str], seq: str, order: str, n: int = 1) -> DataFrame:
    """The n longest non-empty sequences of each key with their rank `r`; of equal ones the first by `order`."""
    rows = df.where(F.char_length(seq) > 0).withColumn("_minus", -F.char_length(seq))
    best = first_per_key(rows, keys, ["_minus", order], n) if n == 1 else rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_minus", order))).where(F.col("_r") <= n)
    best = best if n > 1 else best.withColumn("_r", F.lit(1))
    return best.withColumnRenamed("_r", "r").drop("_minus")


def coverage(reads: DataFrame, keys: list[str], value: str, read_length: int, genome: int) -> DataFrame:
    """Per key: coverage (reads' summed value times their length over the genome), mean and sd of the value."""
    return reads.groupBy(*keys).agg((F.sum(value) * read_length / genome).alias("coverage"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))


def positions_of(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Per key: n and the sorted positions."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(pos)).alias("positions"))


def not_listed(df: DataFrame, *lists: DataFrame) -> DataFrame:
    """Rows of `df` that no list has; each list is joined by the columns it has in common with `df`."""
    for one in lists:
        shared = [c for c in one.columns if c in df.columns]
        df = df.join(one.select(*shared).distinct(), shared, "left_anti")
    return df


def fastq_shards(first: DataFrame, second: DataFrame, ordinal: str, size: int = 262_144) -> DataFrame:
    """Both mates' records as structs `a` and `b` with their shard of `size` records; files of different lengths are an error."""
    pack = lambda df, name: df.select(ordinal, F.struct(*[c for c in df.columns if c != ordinal]).alias(name))
    both = pack(first, "a").join(pack(second, "b"), ordinal, "full")
    alone = F.col("a").isNull() | F.col("b").isNull()
    checked = F.when(alone, F.raise_error(F.lit("the mates' files have different numbers of records")).cast("long")).otherwise(F.floor(F.col(ordinal) / size))
    return both.select(checked.alias("shard"), ordinal, "a", "b")

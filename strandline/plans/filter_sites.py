"""The site filter: from calls and alignments of several samples to confirmed insertion sites.

sites x reads (position join) -> clips and discordant mates -> clips and mates as
aligned to the repeat consensus -> per-site gates -> (chrom, pos, tsd). Realigned
reads are inputs, since aligning is an external program's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline import schemas
from strandline.functions import cigar, text
from strandline.operators import intervals, ordered, relational
from strandline.params import Params
from strandline.sources import tables


def _flag(bit: int):
    return F.col("flag").bitwiseAND(bit) != 0


def usable(reads: DataFrame, p: Params) -> DataFrame:
    return reads.where(~_flag(schemas.DUPLICATE) & ~_flag(schemas.UNMAPPED) & (F.size("cigar") > 0) & (F.col("mapq") >= p.min_mapq))


def reads_at_sites(sites: DataFrame, reads: DataFrame, p: Params) -> DataFrame:
    """site_pos and the columns of each usable read that overlaps [pos - extend, pos + extend)."""
    spans = sites.select("chrom", F.col("pos").alias("site_pos"), F.greatest(F.col("pos") - p.extend, F.lit(1)).alias("_s"), (F.col("pos") + p.extend).alias("_e")).distinct()
    rows = usable(reads, p).withColumn("_rs", F.col("pos")).withColumn("_re", F.col("pos") + cigar.total("cigar", "M", "D", "N", "=", "X"))
    return intervals.overlap_join(spans, rows, ["chrom"], ("_s", "_e"), ("_rs", "_re"), 2 * p.extend, closed=False).select("l.site_pos", "r.*").drop("_rs", "_re")


def clips(at: DataFrame, p: Params) -> DataFrame:
    """chrom, site_pos, name, side, clip_pos and bases of the clips of primary reads, of `min_clip_length` or more."""
    c = F.col("cigar")
    first, last, n = F.element_at(c, 1), F.element_at(c, -1), F.char_length("seq")
    left = F.when((first["op"] == "S") & (first["len"] >= p.min_clip_length), F.struct(F.lit("L").alias("side"), F.col("pos").alias("clip_pos"), F.substring("seq", F.lit(1), first["len"]).alias("bases")))
    right = F.when((F.size(c) > 1) & (last["op"] == "S") & (last["len"] >= p.min_clip_length), F.struct(F.lit("R").alias("side"), cigar.right_breakpoint("pos", "cigar").alias("clip_pos"), F.substring("seq", n - last["len"] + 1, last["len"]).alias("bases")))
    primary = at.where(~_flag(schemas.SECONDARY) & ~_flag(schemas.SUPPLEMENTARY))
    return primary.select("chrom", "site_pos", "name", F.explode(F.filter(F.array(left, right), lambda x: x.isNotNull())).alias("c")).select("chrom", "site_pos", "name", "c.*")


def discordants(at: DataFrame, p: Params) -> DataFrame:
    """Sites' reads with a mapped mate, off decoys, elsewhere; reads whose clip is short, or that aren't primary, are left out as in the clip step."""
    c = F.col("cigar")
    first, last = F.element_at(c, 1), F.element_at(c, -1)
    short = lambda x: (x["op"] == "S") & (x["len"] < p.min_clip_length)
    clipped = (first["op"] == "S") | (last["op"] == "S")
    secondary = _flag(schemas.SECONDARY) | _flag(schemas.SUPPLEMENTARY)
    held_back = short(first) | ((F.size(c) > 1) & short(last)) | (clipped & secondary)
    pos = F.when((F.size(c) > 1) & (last["op"] == "S"), cigar.right_breakpoint("pos", "cigar")).otherwise(F.col("pos"))
    rows = at.where(~held_back & ~_flag(schemas.MATE_UNMAPPED) & F.col("next_chrom").isNotNull()).withColumn("map_pos", pos)
    rows = rows.where(~text.is_decoy("next_chrom") & text.is_discordant("chrom", "map_pos", "next_chrom", "next_pos", p.discordant_distance))
    return rows.select("chrom", "site_pos", "map_pos", F.col("next_chrom").alias("mate_chrom"), F.col("next_pos").alias("mate_pos"), "name", _flag(schemas.READ1).cast("int").alias("is_first"))


def clip_evidence(clips: DataFrame, p: Params, enforce_cluster: bool = False) -> DataFrame:
    """chrom, site_pos, left and right peak, by the realigned clips (chrom, site_pos, side, clip_pos, cns_pos).

    A site stays if both sides' first peak windows have `min_clips` clips together;
    with enforce_cluster each side's consensus positions must also cluster.
    """
    keys = ["chrom", "site_pos"]
    near = clips.where(F.abs(F.col("clip_pos") - F.col("site_pos")) <= p.near_site)

    def side(name: str) -> DataFrame:
        own = near.where(F.col("side") == name)
        peaks = ordered.top_peaks(own.withColumn("_one", F.lit(1).cast("long")), keys, "clip_pos", "_one")
        if enforce_cluster:
            peaks = peaks.join(ordered.cluster_check(own, keys, "cns_pos", p.near_site, p.concord_ratio).where("passed").select(*keys), keys, "left_semi")
        return peaks.select(*keys, F.col("peak1").alias("peak"), F.col("acm1").alias("n"))

    both = relational.both_sides(side("L"), side("R"), keys, "n", p.min_clips)
    at = lambda s, out: side(s).select(*keys, F.col("peak").alias(out))
    return both.join(at("L", "left_peak"), keys, "left").join(at("R", "right_peak"), keys, "left")


def discordant_evidence(mates: DataFrame, p: Params, samples: int) -> DataFrame:
    """Sites whose mates (chrom, site_pos, sample_id, cns_pos) are enough in each sample and gather in two windows of the consensus."""
    keys = ["chrom", "site_pos"]
    per = mates.groupBy(*keys, "sample_id").agg(F.count("*").alias("n"))
    enough = relational.sample_gate(per, keys, "n", p.min_discordant, samples).select(*keys)
    cover = ordered.max_cover(mates, keys, "cns_pos", p.concord_window)
    share = (F.col("count1") - 1 + F.greatest(F.col("count2") - 1, F.lit(0))) / F.col("n")
    return cover.where(share > p.concord_ratio).join(enough, keys, "left_semi").select(*keys)


def confirmed_sites(clips: DataFrame, mates: DataFrame, samples: int, p: Params | None = None, enforce_cluster: bool = False) -> DataFrame:
    """chrom, pos (the left peak, else the right one) and tsd (distance of the peaks; 0 with one side)."""
    p = p or Params()
    sites = clip_evidence(clips, p, enforce_cluster).join(discordant_evidence(mates, p, samples), ["chrom", "site_pos"], "left_semi")
    two = F.col("left_peak").isNotNull() & F.col("right_peak").isNotNull()
    return sites.select("chrom", F.coalesce("left_peak", "right_peak").alias("pos"), F.when(two, F.abs(F.col("right_peak") - F.col("left_peak"))).otherwise(0).alias("tsd"))


def mates_at(found: DataFrame, reads: DataFrame) -> DataFrame:
    """Discordant reads' sites with the bases of their mates: the record of that name, place and other number."""
    mates = reads.where(~_flag(schemas.SECONDARY) & ~_flag(schemas.SUPPLEMENTARY))
    mates = mates.select("name", F.col("chrom").alias("mate_chrom"), F.col("pos").alias("mate_pos"), (F.lit(1) - _flag(schemas.READ1).cast("int")).alias("is_first"), F.col("seq").alias("bases"))
    return found.join(mates, ["name", "mate_chrom", "mate_pos", "is_first"]).select("chrom", "site_pos", "name", "bases")


def call_sites(calls: DataFrame, samples: list[DataFrame], realign: Callable[[DataFrame], DataFrame], p: Params | None = None, enforce_cluster: bool = False) -> DataFrame:
    """chrom, pos and tsd of the insertion sites that every sample's reads confirm, from a table of calls.

    `realign` stands for the external aligner: it returns those of the given rows
    whose column `bases` aligns to a repeat's consensus, with the place as cns_pos.
    """
    p = p or Params()
    sites = tables.breakpoints(calls).where("pos IS NOT NULL").distinct()
    at = [reads_at_sites(sites, reads, p) for reads in samples]
    clipped = realign(relational.tagged_union([clips(rows, p) for rows in at]))
    mates = realign(relational.tagged_union([mates_at(discordants(rows, p), reads) for rows, reads in zip(at, samples, strict=True)]))
    found = confirmed_sites(clipped, mates, len(samples), p, enforce_cluster)
    return found.where(~text.is_decoy("chrom"))


def compare_calls(a: DataFrame, b: DataFrame, p: Params | None = None) -> tuple[DataFrame, DataFrame]:
    """Both directions' nearest matches of confident calls with the same chrom and family; each needs a column `id`."""
    p = p or Params()
    sure = lambda df: df.where(F.col("conf") == p.min_out_conf).select("id", "chr", "repeat_family", F.coalesce("pbp", "nbp").alias("_a"), F.coalesce("nbp", "pbp").alias("_b"))
    one = lambda x, y: intervals.nearest_match(sure(x), sure(y), ["chr", "repeat_family"], "id", ("_a", "_b"), "id", ("_a", "_b"), p.match_margin, 512)
    return one(a, b), one(b, a)


def cluster_reads(ram: DataFrame, p: Params | None = None) -> DataFrame:
    """Clusters of repeat-anchored mates by chrom and strand: own definition, gap based, of `min_ram` reads or more."""
    p = p or Params()
    marked = ordered.islands(ram, ["chrom", "strand"], "pos", p.gap_cutoff)
    per = marked.groupBy("chrom", "strand", "island").agg(F.min("pos").alias("s"), F.max("pos").alias("e"), F.count("*").alias("ram"), F.array_sort(F.collect_set("repeat_family")).alias("families"))
    return per.where(F.col("ram") >= p.min_ram)

"""Column functions on CIGAR arrays: array<struct<op:string,len:int>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import col


def parse(text) -> Column:
    """From text; `*`, null and anything that is no CIGAR give an empty array."""
    t = col(text)
    ops = F.split(F.translate(t, "0123456789", ""), "")
    sizes = F.split(F.rtrim(t, F.lit("MIDNSHP=X")), "[MIDNSHP=X]").cast("array<int>")
    return F.when(t.rlike("^([0-9]+[MIDNSHP=X])+$"), F.arrays_zip(ops, sizes).cast("array<struct<op:string,len:int>>")).otherwise(F.array().cast("array<struct<op:string,len:int>>"))


def total(cigar, *ops: str, but: bool = False) -> Column:
    """Summed length of the ops given, or of all but these."""
    wanted = lambda x: ~x["op"].isin(*ops) if but else x["op"].isin(*ops)
    return F.aggregate(col(cigar), F.lit(0), lambda acc, x: acc + F.when(wanted(x), x["len"]).otherwise(0))


def right_breakpoint(pos, cigar) -> Column:
    """Position plus all ops but the last, without S, H and I."""
    c = col(cigar)
    last = F.try_element_at(c, F.lit(-1))
    return col(pos) + total(c, "S", "H", "I", but=True) - F.when((F.size(c) > 0) & ~last["op"].isin("S", "H", "I"), last["len"]).otherwise(0)


def signed_position(pos, cigar, reverse) -> Column:
    """The position on the forward strand or without CIGAR; else the negative end, over all ops but I and S."""
    return F.when(~reverse | (F.size(col(cigar)) == 0), col(pos)).otherwise(-(col(pos) + total(cigar, "I", "S", but=True)))


def is_qualified(cigar, ratio: float = 0.5, both: int = 6) -> Column:
    """Mapped well enough: not clipped by more than `both` on both ends, and M makes up `ratio` of all but D."""
    c = col(cigar)
    first, last = F.element_at(c, 1), F.element_at(c, -1)
    ends = (F.size(c) > 2) & first["op"].isin("S", "H") & last["op"].isin("S", "H") & (first["len"] > both) & (last["len"] > both)
    return F.when(F.size(c) == 0, F.lit(False)).otherwise(~ends & (total(c, "M") >= ratio * total(c, "D", but=True)))


def longer_clip(cigar) -> Column:
    """`left` or `right`: the end with the longer S or H clip (`none` for equal ones and without clips)."""
    c = col(cigar)
    size = lambda at: F.when((F.size(c) > 0) & F.element_at(c, at)["op"].isin("S", "H"), F.element_at(c, at)["len"]).otherwise(0)
    left, right = size(1), F.when(F.size(c) > 1, size(-1)).otherwise(0)
    return F.when(left > right, "left").when(right > left, "right").otherwise("none")


def has_op(cigar, op: str, least: int = 1) -> Column:
    return F.exists(col(cigar), lambda x: (x["op"] == op) & (x["len"] >= least))


def clip_parts(seq, cigar, reverse) -> Column:
    """(head, tail) by the read's own direction: what the longer clip cuts the bases into; a hard clip has none."""
    c, s = col(cigar), col(seq)
    side = longer_clip(c)
    first, last = F.element_at(c, 1), F.element_at(c, -1)
    cut = F.when(side == "left", F.when(first["op"] == "S", first["len"]).otherwise(0)).when(side == "right", F.char_length(s) - F.when(last["op"] == "S", last["len"]).otherwise(0))
    left, right = F.substring(s, F.lit(1), cut), F.substring(s, cut + 1, F.char_length(s))
    return F.when(side != "none", F.struct(F.when(reverse, left).otherwise(right).alias("head"), F.when(reverse, right).otherwise(left).alias("tail")))


def is_big_clip(seq, op, size: int) -> Column:
    """Whether a CIGAR entry is a soft clip of `size` bases or more, of a read that has as many."""
    return (op["op"] == "S") & (F.least(F.char_length(col(seq)), op["len"]) >= size)


def clip_alignment(seq, qual, cigar) -> Column:
    """(seq, qual) of the end with the longer soft clip; the back one for equal ones and without soft clips."""
    c, s, q = col(cigar), col(seq), col(qual)
    soft = lambda x: F.when(x["op"] == "S", x["len"]).otherwise(-1)
    first, last, n = F.element_at(c, 1), F.element_at(c, -1), F.char_length(s)
    front = soft(first) > soft(last)
    size = F.least(n, F.when(front, first["len"]).otherwise(last["len"]))
    at = F.when(front, F.lit(1)).otherwise(n - size + 1)
    return F.when(F.size(c) > 0, F.struct(F.substring(s, at, size).alias("seq"), F.substring(q, at, size).alias("qual")))

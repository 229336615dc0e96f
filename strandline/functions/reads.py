"""Column functions on reads and read pairs: fragments, clips of mates, and filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import col

#: Fixed value: mapping quality from which a mapping is trusted.
TRUSTED = 10


def n_count(seq) -> Column:
    return F.char_length(col(seq)) - F.char_length(F.replace(col(seq), F.lit("N")))


def few_n(a, b, most: int) -> Column:
    """Whether both reads of a pair have at most so many N together."""
    return n_count(a) + n_count(b) <= most


def mate_number(flag) -> Column:
    """1 or 2 by the flag's bits of a first and a second read; null for both or none."""
    first, second = F.getbit(col(flag), F.lit(6)) == 1, F.getbit(col(flag), F.lit(7)) == 1
    return F.when(first & ~second, 1).when(second & ~first, 2)


def is_mate_pair(flag_a, flag_b) -> Column:
    return F.coalesce(mate_number(flag_a) + mate_number(flag_b) == 3, F.lit(False))


def usable(flag, secondary: bool = False) -> Column:
    """Neither duplicate, unmapped nor supplementary, and not secondary unless these are wanted too."""
    bad = 1024 | 4 | 2048 | (0 if secondary else 256)
    return col(flag).bitwiseAND(F.lit(bad)) == 0


def _front(s: Column, k: int) -> Column:
    return F.substring(s, 1, k)


def _back(s: Column, k: int) -> Column:
    return F.substring(s, F.char_length(s) - k + 1, F.lit(k))


def _kept(pairs: list[tuple[str, Column, Column, Column]], most_n: int) -> Column:
    """Those (kind, a, b) whose condition holds and which have few N."""
    every = [F.when(ok & few_n(a, b, most_n), F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))) for kind, ok, a, b in pairs]
    return F.filter(F.array(*every), lambda x: x.isNotNull())


def unmapped_fragments(a, b, k: int, most_n: int) -> Column:
    """Fragments of k bases of two unmapped mates: the fronts, and each end with a back where that mate has 2 k bases."""
    x, y = col(a), col(b)
    n, m = F.char_length(x), F.char_length(y)
    both, long_a, long_b = (n >= k) & (m >= k), n >= 2 * k, m >= 2 * k
    return _kept([("uu1", both, _front(x, k), _front(y, k)), ("uu2", both & long_a, _back(x, k), _front(y, k)), ("uu3", both & long_b, _front(x, k), _back(y, k)), ("uu4", both & long_a & long_b, _back(x, k), _back(y, k))], most_n)


def half_mapped_fragments(mapped, unmapped, k: int, most_n: int) -> Column:
    """The mapped mate (of 2 k bases at least) with the front of the unmapped one, and with its back where it has 2 k bases."""
    x, y = col(mapped), col(unmapped)
    ok = (F.char_length(y) >= k) & (F.char_length(x) >= 2 * k)
    return _kept([("mu1", ok, x, _front(y, k)), ("mu2", ok & (F.char_length(y) >= 2 * k), x, _back(y, k))], most_n)


def split_read(seq, k: int, most_n: int) -> Column:
    """Front and back of a read of 2 k bases at least, named by its length; null for others and for many N."""
    s = col(seq)
    name = F.concat(F.lit("_"), F.char_length(s).cast("string"))
    return F.when((F.char_length(s) >= 2 * k) & few_n(_front(s, k), _back(s, k), most_n), F.struct(name.alias("suffix"), _front(s, k).alias("left"), _back(s, k).alias("right")))


def mate_clip(fullmap_mapq, head, tail) -> Column:
    """What stands for a partly mapped mate of a wholly mapped read: clips are structs with `op`.

    Of an untrusted read's mate that is the tail; of a trusted one's the head, if
    the tail and not the head is a mapped part; else there is none.
    """
    h, t = col(head), col(tail)
    return F.when(col(fullmap_mapq) < TRUSTED, t).when((h["op"] != "M") & (t["op"] == "M"), h)


def mate_clip_of_two(fullmap_mapq, first, second) -> Column:
    """What stands for a mate in two records (structs head and tail, with op and mapq) of a wholly mapped read.

    Head and tail are the mapped ones of different records. The read's own quality
    decides: 0 takes the tail if it is the better one, an untrusted read the better
    one, a trusted read the worse one; of equals the tail, unless the quality is 0.
    """
    a, b, q = col(first), col(second), col(fullmap_mapq)
    ab = (a["head"]["op"] == "M") & (b["tail"]["op"] == "M")
    ba = (b["head"]["op"] == "M") & (a["tail"]["op"] == "M")
    head, tail = F.when(ab, a["head"]).when(ba, b["head"]), F.when(ab, b["tail"]).when(ba, a["tail"])
    better, worse = F.when(head["mapq"] > tail["mapq"], head).otherwise(tail), F.when(head["mapq"] < tail["mapq"], head).otherwise(tail)
    chosen = F.when(q == 0, F.when(head["mapq"] < tail["mapq"], tail)).when(q < TRUSTED, better).otherwise(worse)
    return F.when(ab | ba, chosen)


def anchor_n(s, offset, k: int, after: int) -> Column:
    """0-based place of the last N among the `after` bases behind the gap base, else among the k bases from `offset` on; -1 if there is none."""
    text, at = col(s), col(offset)
    last = lambda start, n: F.when(F.contains(F.substring(text, start + 1, F.lit(n)), F.lit("N")), start + n - F.locate("N", F.reverse(F.substring(text, start + 1, F.lit(n)))))
    return F.coalesce(last(at + k + 1, after), last(at, k), F.lit(-1))

"""Column functions on base and quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import col


def acgt_or_n(s) -> Column:
    """Upper case, with every character other than A, C, G, T as N."""
    return F.regexp_replace(F.upper(col(s)), "[^ACGT]", "N")


def complement(s) -> Column:
    return F.translate(acgt_or_n(s), "ACGT", "TGCA")


def reverse_complement(s) -> Column:
    return F.reverse(complement(s))


def is_poly_at(s, share: float = 0.75) -> Column:
    """More than `share` of the bases are A, or T."""
    up = F.upper(col(s))
    count = lambda b: F.char_length(F.regexp_replace(up, f"[^{b}]", ""))
    return (count("A") > share * F.char_length(up)) | (count("T") > share * F.char_length(up))


def has_poly_at(s, run: int) -> Column:
    """A run of at least `run` A or T, in either case."""
    return F.upper(col(s)).rlike(f"A{{{run},}}|T{{{run},}}")


def has_poly_signal(s) -> Column:
    return col(s).rlike("AAAAA|TTTTT|AATAA|TTATT")


def tail_run(s, base: str) -> Column:
    """Length of the run of one character at the end."""
    return F.char_length(F.regexp_extract(col(s), f"({base}*)$", 1))


def trim_n(s) -> Column:
    """Without N at both ends; one N if nothing else is there."""
    return F.coalesce(F.nullif(F.regexp_replace(col(s), "^N+|N+$", ""), F.lit("")), F.lit("N"))


def no_ambiguous(s, start: int | None = None, length: int | None = None) -> Column:
    part = col(s) if start is None else F.substring(col(s), start + 1, length)
    return ~F.contains(part, F.lit("N"))


def low_complexity(s) -> Column:
    """0-based place of the first N or run of four equal bases, -1 if there is none."""
    found = F.regexp_instr(col(s), F.lit("N|A{4}|C{4}|G{4}|T{4}"))
    return F.coalesce(found - 1, F.lit(-1))


def hamming(a, b, n) -> Column:
    """Differing characters among the first n of both."""
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + (F.substring(col(a), i, F.lit(1)) != F.substring(col(b), i, F.lit(1))).cast("int"))


def snip(s, start, length, reverse) -> Column:
    """Bases from `start` on in the read's own direction; unchanged for a negative start or length."""
    at = F.when(reverse, F.char_length(col(s)) - start - length).otherwise(start)
    return F.when((start < 0) | (length < 0), col(s)).otherwise(F.substring(col(s), at + 1, length))


def leading_run(q, char: str) -> Column:
    return F.char_length(F.regexp_extract(col(q), f"^({char}*)", 1))


def longest_good_run(q, least: int) -> Column:
    """Longest run of characters above the code `least`."""
    runs = F.split(F.regexp_replace(col(q), f"[^\\x{{{least + 1:x}}}-\\x{{10ffff}}]", " "), " ")
    return F.array_max(F.transform(runs, lambda r: F.char_length(r)))


def phred_text(values) -> Column:
    return F.array_join(F.transform(col(values), lambda x: F.char(x + 33)), "")


def bwa_trim_length(qual, threshold: int, least: int = 35, offset: int = 33) -> Column:
    """Bases kept by 3' quality trimming: up to the place where the running sum of threshold - quality from the end is greatest."""
    q = col(qual)
    n = F.char_length(q)
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most"), n.alias("keep"), F.lit(False).alias("done"))

    def step(acc, i):
        total = acc["sum"] + F.lit(threshold + offset) - F.ascii(F.substring(q, i, F.lit(1)))
        done = acc["done"] | (total < 0)
        better = ~done & (total > acc["most"])
        return F.struct(total.alias("sum"), F.when(better, total).otherwise(acc["most"]).alias("most"), F.when(better, i - 1).otherwise(acc["keep"]).alias("keep"), done.alias("done"))

    places = F.when(n > least, F.sequence(n, F.lit(least + 1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.when(n < least, n).otherwise(F.aggregate(places, start, step, lambda acc: acc["keep"]))


def longest_common(a, b) -> Column:
    """The longest common substring of two texts; of several, all places in the first text, joined. Null for a null."""
    x, y = col(a), col(b)
    longest = lambda i: F.aggregate(F.sequence(F.lit(1), F.char_length(x) - i + 1), F.lit(0), lambda n, _: F.when(F.contains(y, F.substring(x, i, n + 1)), n + 1).otherwise(n))
    places = F.when(F.char_length(x) > 0, F.sequence(F.lit(1), F.char_length(x))).otherwise(F.array().cast("array<int>"))
    from_each = F.transform(places, lambda i: F.struct(i.alias("i"), longest(i).alias("n")))
    best = F.aggregate(from_each, F.struct(F.lit(0).alias("n"), F.lit("").alias("t")), lambda acc, p: F.when((p["n"] > 0) & (p["n"] >= acc["n"]), F.struct(p["n"].alias("n"), F.concat(F.when(p["n"] > acc["n"], "").otherwise(acc["t"]), F.substring(x, p["i"], p["n"])).alias("t"))).otherwise(acc), lambda acc: acc["t"])
    return F.when(x.isNotNull() & y.isNotNull(), best)

"""Column functions on k-mers, which stay strings: A < C < G < T is their numeric order too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import col
from strandline.functions.sequence import reverse_complement


def kmers(s, k: int) -> Column:
    """All k-mers; null for a shorter text."""
    text = col(s)
    return F.when(F.char_length(text) >= k, F.transform(F.sequence(F.lit(1), F.char_length(text) - (k - 1)), lambda i: F.substring(text, i, F.lit(k))))


def _plain(kmer: Column) -> Column:
    """No ambiguous base and no four equal ones."""
    runs = [~F.contains(kmer, F.lit(4 * base)) for base in "ACGT"]
    return reduce(Column.__and__, runs) & (F.translate(kmer, "ACGT", "") == "")


def minimizer(s, k: int) -> Column:
    """The least of all k-mers without ambiguous or low-complexity bases, each as the lesser of both strands; null if there is none."""
    text = col(s)

    def least(x):
        """Of a struct of both strands, which is there once and not anew for each k-mer."""
        n = F.char_length(x["a"])
        both = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.struct(F.substring(x["a"], i, F.lit(k)).alias("a"), F.substring(x["b"], n - i - (k - 2), F.lit(k)).alias("b")))
        return F.array_min(F.transform(F.filter(both, lambda y: _plain(y["a"])), lambda y: F.least(y["a"], y["b"])))

    strands = F.array(F.struct(text.alias("a"), reverse_complement(text).alias("b")))
    return F.when(F.char_length(text) >= k, F.transform(strands, least)[0])


def anchored_minimizer(s, k: int, base: str) -> Column:
    """The least code of the usable k-mers that begin with `base`, either strand's; 0 if there is none.

    Codes are two bits a base from the top of 64, and only those below 2^63 can
    win, which begin with A or C.
    """
    text = col(s)
    usable = F.filter(kmers(text, k), lambda x: x.startswith(base) & ~x.rlike("[^ACGT]|A{4}|C{4}|G{4}|T{4}"))
    codes = F.filter(F.flatten(F.transform(usable, lambda x: F.array(x, reverse_complement(x)))), lambda x: x.rlike("^[AC]"))
    return F.coalesce(two_bit(F.rpad(F.array_min(codes), 32, "A")), F.lit(0).cast("decimal(20,0)"))


def premer(s, k: int) -> Column:
    """(kmer, is_forward) of the least k-mer on either strand; the forward one on ties."""
    usable = F.filter(kmers(s, k), lambda x: ~x.rlike("[^ACGT]|A{4}|C{4}|G{4}|T{4}"))
    both = F.flatten(F.transform(usable, lambda x: F.array(F.struct(x.alias("kmer"), F.lit(0).alias("strand")), F.struct(reverse_complement(x).alias("kmer"), F.lit(1).alias("strand")))))
    best = F.array_min(both)
    return F.struct(best["kmer"].alias("kmer"), (best["strand"] == 0).alias("is_forward"))


def anchored(s, start, k: int, after: int) -> Column:
    """k bases from `start` (0-based), then `after` bases behind one that is skipped."""
    return F.concat(F.substring(col(s), start + 1, F.lit(k)), F.substring(col(s), start + k + 2, F.lit(after)))


def two_bit(kmer) -> Column:
    """The k-mer's number, two bits a base."""
    return F.conv(F.translate(col(kmer), "ACGT", "0123"), 4, 10).cast("decimal(20,0)")


def from_two_bit(code, k: int) -> Column:
    """The k-mer of a number of two bits a base."""
    return F.translate(F.lpad(F.conv(col(code).cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def base_set(mask) -> Column:
    """Bases of the bits 0 to 4: N, A, C, G, T."""
    bit = lambda i, b: F.when(F.getbit(col(mask), F.lit(i)) == 1, b).otherwise("")
    return F.concat(*[bit(i, b) for i, b in enumerate("NACGT")])


def encoded_length(n, unit: int) -> Column:
    """Units that hold n bases: 42, 21 or 10 bases each."""
    return F.ceil(col(n) / unit).cast("long")

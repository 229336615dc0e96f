"""Vectorised text work on Arrow batches: bytes, words, lines and 64-bit segment hashes.

A batch's texts are one byte buffer with offsets. Words and lines are found by
byte class tables (all separators are ASCII, so UTF-8 bytes suffice), and the
hash of any segment comes from prefix sums of a polynomial, so no per-word
Python work is needed. Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are worked on at once; a longer text makes a piece of its own.
PIECE_BYTES = 256 << 10

_BASE = 0x9E3779B97F4A7C15
#: The prime of the segment hashes, and two bases below it, drawn once.
_P = np.uint64((1 << 31) - 1)
_BASES = tuple(int(b) for b in np.random.default_rng(1602).integers(1 << 20, (1 << 31) - 2, 2))
_powers: list[tuple[np.ndarray, np.ndarray]] = []

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def given_back() -> None:
    """Give freed memory back to the system: a worker outlives its task, and the allocators would keep the task's peak until then."""
    if _powers and len(_powers[0][0]) > 2 * PIECE_BYTES:  # grown for a long text
        _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()
    given_back()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of string or binary values."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    large = pa.large_binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.large_string()
    texts = pc.fill_null(texts.cast(large), b"" if large == pa.large_binary() else "")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below its square."""
    x = (x & _P) + (x >> np.uint64(31))
    x = (x & _P) + (x >> np.uint64(31))
    return np.where(x >= _P, x - _P, x)


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers and those of its inverse, n at least."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, PIECE_BYTES + 4096, 2 * len(_powers[0][0]) if _powers else 0)
        _powers.clear()
        for base in _BASES:
            both = []
            for b in (base, pow(base, -1, int(_P))):
                out = np.ones(size, np.uint64)
                done = 1
                while done < size:
                    out[done : 2 * done] = _mod(out[: min(done, size - done)] * np.uint64(pow(b, done, int(_P))))
                    done *= 2
                both.append(out)
            _powers.append(tuple(both))
    return _powers


def prefix(data: np.ndarray) -> list[np.ndarray]:
    """Prefix sums, for each base, from which segment_hash takes the hash of any segment."""
    sums, values = [], data.astype(np.uint64)
    values += np.uint64(1)
    for up, _ in _power_tables(len(data) + 1):
        terms = values * up[: len(data)]  # below 2^40, so that 2^23 of them can be added up as they are
        if len(data) >> 23:
            terms = (terms & _P) + (terms >> np.uint64(31))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=out[1:])
        sums.append(out)
    return sums


def segment_hash(sums: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each segment's bytes; it doesn't depend on where the segment stands.

    Two polynomials modulo a prime, with bases that no text was made for: two given
    segments of n bytes get one hash with a chance of at most (n / 2^31)^2.
    """
    a, b = (_mod(_mod((s[ends] - s[starts]) % _P) * down[starts]) for s, (_, down) in zip(sums, _power_tables(len(sums[0])), strict=True))
    return mix(mix(a << np.uint64(31) | b) + (ends - starts).astype(np.uint64))


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, doc) of the maximal runs of True, which never cross a text's end."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offs[:-1][np.diff(offs) > 0]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut[1:] - 1] = inside[cut[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, doc) of the maximal runs of characters other than ASCII white space."""
    return runs(~SPACE[data], offs)


def per_doc(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of a value per byte (or per item) for each text, by prefix sums."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def spread(offs_of: np.ndarray, n_docs: int) -> np.ndarray:
    """Offsets of each doc's items, given the sorted doc of each item."""
    return np.searchsorted(offs_of, np.arange(n_docs + 1), "left")


def window_hash(item_hash: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of every run of `width` consecutive items within a doc, in order of its first item."""
    n = len(item_hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + item_hash[k : n + k]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ok = doc[:n] == doc[width - 1 :]
    return mix(out[ok]), doc[:n][ok]

"""Exact substring deduplication by a distributed merge sort of sparse suffix runs.

Every string of LENGTH bytes has an anchor, the least hashed GRAM-byte gram in
it, whose place depends on the string alone. So equal strings have equal anchors
at equal places, and only suffixes at anchors have to be sorted. The strings of an
anchor are told apart by where it is in them: in those that have it in their first
REACH bytes the KEY bytes from the anchor on are their key, in the others the KEY
bytes from REACH bytes before it. So an anchor makes one place or two; a key lies
in each string of its place as a whole, and is far rarer than a gram. A suffix
(from the place) comes with its context: all bytes of the strings of the place.

0. Of exact copies only that of the least doc_id takes part; the others are
   removed as a whole (all their strings are in it).
1. Texts and their anchors are packed into segments (about SEGMENT_BYTES each), a
   bucketed table, and each segment sends the hashes of its keys to buckets, which
   answer for each hash whether other segments have it too. Keys that only one
   document has are done with.
2. A segment sorts the contexts of its remaining places, keeps one of equal ones
   (that of the least doc_id) and sends the sorted run, front-coded, to buckets.
3. A bucket merges its runs with a loser tree. Each loser keeps the length of the
   prefix that it shares with the winner it lost to; a longer one wins without a
   look at the bytes, and equal ones are compared from there on, so no known
   prefix is compared again. Contexts with the same key come out next to
   each other; of equal strings all but those of the least doc_id are removed,
   and the segments are told which.
4. Segments mark what is removed and cut it out.

Keys in more than HOT_SEGMENTS segments are sent as single strings instead of
contexts, one of equal ones a segment: these are spread by their own content, so
a very common key lands in no single task.

Edge cases: a null text is an empty one, of 0 bytes; texts shorter than LENGTH
are kept whole; rows that share a doc_id don't remove each other's strings, nor
a document its own repetitions; a null doc_id counts as larger than all; an
empty table gives no rows. Cutting may split a character: kept is binary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cached_property
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textbuf
from strandline.llm.store import frugal, ids_hint, parts, shared_dir, stored

LENGTH = 50
GRAM = 8
#: Windows that an anchor can stand for: it is within one string of each.
WIDTH = LENGTH - GRAM + 1
#: Bytes of a key, and the strings that a place can stand for: twice as many are WIDTH at least.
KEY = (LENGTH + GRAM) // 2
REACH = LENGTH - KEY + 1
SEGMENT_BYTES = 2 << 20
HOT_SEGMENTS = 4096
#: A context as a row of bytes: kind, suffix from the place, bytes before it (backwards), both lengths.
ROW = 1 + LENGTH + REACH - 1 + 2
CONTEXT, STRING = 1, 2
#: Positions that are hashed at once, so that the work stays in the CPU's cache.
BLOCK = 1 << 16
#: Rows of runs that are decoded at once.
DECODED = 1 << 13
_PLACE_BITS = 31
_BASE = 0x9E3779B97F4A7C15
_NO_ID = (1 << 63) - 1


class Segment:
    """The texts of a segment, their anchors, and the places of the keys."""

    def __init__(self, ids: np.ndarray, offs: np.ndarray, data: np.ndarray, anchors: np.ndarray | None = None):
        """Places: at, first and last start (lo, hi) of the strings they stand for, doc (number), hash of the key.

        anchors: for each anchor in order, how many strings it stands for and its distance from the first one's start.
        """
        self.ids, self.offs, self.data = ids, offs, data
        strings = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offs) - LENGTH + 1, 0))])
        self.anchors = _anchors_of(offs, data) if anchors is None else anchors
        ends = np.cumsum(self.anchors[:, 0], dtype=np.int64)
        first = ends - self.anchors[:, 0]
        doc = np.searchsorted(strings, first, "right") - 1
        lo = first - strings[doc] + offs[doc]
        hi, at = lo + self.anchors[:, 0] - 1, lo + self.anchors[:, 1]
        near, far = np.flatnonzero(at - hi < REACH), np.flatnonzero(at - lo >= REACH)
        self.at = np.concatenate([at[near], at[far] - REACH])
        self.lo = np.concatenate([np.maximum(lo[near], at[near] - REACH + 1), lo[far]])
        self.hi = np.concatenate([hi[near], np.minimum(hi[far], at[far] - REACH)])
        self.doc = np.concatenate([doc[near], doc[far]])
        self.hash = _key_hash(data, self.at)
        self.doc_anchors = np.bincount(doc, minlength=len(ids))

    def pack(self) -> bytes:
        sink = pa.BufferOutputStream()
        offs = 2 * np.concatenate([[0], np.cumsum(self.doc_anchors)])
        out = pa.table({"doc_id": pa.array(self.ids), "text": _binary(self.offs, self.data), "anchors": _binary(offs, np.ascontiguousarray(self.anchors))})
        with pa.ipc.new_stream(sink, out.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(out)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpack(cls, packed: bytes) -> Segment:
        table = pa.ipc.open_stream(packed).read_all().combine_chunks()
        data, offs = textbuf.buffers(table.column("text").combine_chunks())
        return cls(table.column("doc_id").to_numpy(), offs, data, textbuf.buffers(table.column("anchors").combine_chunks())[0].reshape(-1, 2))

    @cached_property
    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes; number of each place's; whether two documents of the segment have it)."""
        hashes, number = np.unique(self.hash, return_inverse=True)
        low, high = np.full(len(hashes), 1 << 62), np.full(len(hashes), -1)
        np.minimum.at(low, number, self.doc)
        np.maximum.at(high, number, self.doc)
        return hashes, number, low != high

    def entries(self, repeated: np.ndarray, hot: np.ndarray) -> Entries:
        """The contexts of the places whose hash is repeated; of hot ones their single strings."""
        _, number, local = self.grams
        pick = (repeated | local)[number]
        own = np.flatnonzero(pick & ~hot[number])
        at, lo, hi, doc, of = (x[own] for x in (self.at, self.lo, self.hi, self.doc, self.hash))
        single = np.flatnonzero(pick & hot[number])
        if len(single):
            n = self.hi[single] - self.lo[single] + 1
            s = np.repeat(self.lo[single] - np.cumsum(n) + n, n) + np.arange(n.sum())
            at, lo, hi, doc = (np.concatenate(x) for x in ((at, s), (lo, s), (hi, s), (doc, np.repeat(self.doc[single], n))))
        rows = np.zeros((len(at), ROW), np.uint8)
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        for s in range(0, len(at), 4096):
            a, size, before = at[s : s + 4096, None] + REACH, (hi - at)[s : s + 4096, None] + LENGTH, (at - lo)[s : s + 4096, None]
            part = rows[s : s + 4096]
            part[:, 0] = CONTEXT
            part[:, 1 : 1 + LENGTH] = padded[a + np.arange(LENGTH)] * (np.arange(LENGTH) < size)
            part[:, 1 + LENGTH : -2] = padded[a - 1 - np.arange(REACH - 1)] * (np.arange(REACH - 1) < before)
            part[:, -2:] = np.concatenate([size, before + 1], axis=1)
        if len(single):
            rows[len(own) :, 0] = STRING
            power = np.array([pow(_BASE, k, 1 << 64) for k in range(LENGTH)], np.uint64)
            of = np.concatenate([of, textbuf.mix((rows[len(own) :, 1 : 1 + LENGTH] * power).sum(axis=1, dtype=np.uint64))])
        keys, where, entry = np.unique(rows.view(f"S{ROW}").ravel(), return_index=True, return_inverse=True)
        return Entries(rows[where], entry, doc, lo, (hi - lo + 1)[where], of[where], _least(self.ids[doc], entry, len(keys)))


class Entries(NamedTuple):
    """Distinct contexts in order (rows, strings: how many each has, hash, least: doc_id), and their places (entry, doc, lo)."""

    rows: np.ndarray
    entry: np.ndarray
    doc: np.ndarray
    lo: np.ndarray
    strings: np.ndarray
    hash: np.ndarray
    least: np.ndarray


def _least(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, _NO_ID)
    np.minimum.at(out, group, values)
    return out


def _binary(offs: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(data)])


def _key_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the KEY bytes from each place on, eight bytes at a time."""
    words = np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,)) if len(data) >= 8 else np.zeros(0, np.uint64)
    h = np.full(len(at), _BASE, np.uint64)
    for k in [*range(0, KEY - 7, 8), KEY - 8]:
        h = textbuf.mix(h * np.uint64(_BASE) ^ words[at + k])
    return h


def _anchors_of(offs: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each anchor of the texts in order: how many strings it stands for, and its distance from the first one's start."""
    n = len(data)
    blocks = [_anchors(data[s : s + BLOCK + LENGTH - 1], s) for s in range(0, max(0, n - LENGTH + 1), BLOCK)]
    anchor = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
    ends = np.repeat(offs[1:], np.diff(offs))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends)
    at = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return np.stack([np.diff(first, append=len(start)), at[first] - start[first]], axis=1).astype(np.uint8)


def _anchors(data: np.ndarray, first: int) -> np.ndarray:
    """For each string of LENGTH bytes: the place of its anchor, counted from `first`."""
    n = len(data)
    # grams of 1, 2, 4 ... bytes are joined to grams of GRAM bytes
    part, size, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    h, done = None, 0
    while True:
        if GRAM & size:
            h = part if h is None else part[: len(part) - done] * np.uint64(pow(_BASE, done, 1 << 64)) + h[size:]
            done += size
            h = h[: n - done + 1]
        if done == GRAM:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        power, size = power * power % (1 << 64), 2 * size
    h = textbuf.mix(h)
    least = h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while 2 * step <= WIDTH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < WIDTH:
        least = np.minimum(least[: len(least) - (WIDTH - step)], least[WIDTH - step :])
    return (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + first


def lcp(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return known + (8 * (n - known) - differ.bit_length()) // 8 if differ else n


def front_coded(rows: np.ndarray, first: np.ndarray | int = 0) -> tuple[bytes, bytes]:
    """(lengths of the prefixes that sorted rows share with the one before, the rests); first: rows with which a run begins."""
    differ = rows[1:] != rows[:-1]
    shared = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), ROW)]).astype(np.uint8)
    shared[first] = 0
    return shared.tobytes(), rows[np.arange(ROW) >= shared[:, None]].tobytes()


def decoded(shared: bytes, rests: bytes) -> list[bytes]:
    known = np.frombuffer(shared, np.uint8)
    rows = np.zeros((len(known), ROW), np.uint8)
    own = np.arange(ROW) >= known[:, None]
    rows[own] = np.frombuffer(rests, np.uint8)
    last = np.maximum.accumulate(np.where(own, np.arange(len(known))[:, None], 0), axis=0)
    raw = np.take_along_axis(rows, last, axis=0).tobytes()
    return [raw[i : i + ROW] for i in range(0, len(raw), ROW)]


def all_decoded(coded: list[tuple[bytes, bytes]]) -> list[list[bytes]]:
    """Runs, decoded many at a time: each begins with a whole row, so they can follow one another."""
    out, at = [], 0
    while at < len(coded):
        to, n = at, 0
        while to < len(coded) and (to == at or n + len(coded[to][0]) <= DECODED):
            n += len(coded[to][0])
            to += 1
        rows = iter(decoded(*(b"".join(x) for x in zip(*coded[at:to], strict=True))))
        out += [list(islice(rows, len(shared))) for shared, _ in coded[at:to]]
        at = to
    return out


def merged(runs: list[tuple[list[bytes], bytes]]) -> Iterator[tuple[int, int, int]]:
    """(run, place, prefix shared with the one before) of all keys in order, by a loser tree; runs: (sorted keys, shared prefixes)."""
    n = 1
    while n < len(runs):
        n *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (n - len(runs))
    places, shared, losers = [0] * n, [0] * n, [0] * n

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        both = lcp(x, y, shared[a])
        if x[both:] <= y[both:]:
            shared[b] = both
            return a, b
        shared[a] = both
        return b, a

    winners = [0] * (2 * n)
    for i in range(n):
        winners[n + i] = i
    for node in range(n - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    w = winners[1]
    while heads[w] is not None:
        yield w, places[w], shared[w]
        keys, own = runs[w]
        place = places[w] = places[w] + 1
        if place < len(keys):
            heads[w], shared[w] = keys[place], own[place]
        else:
            heads[w] = None
        node = (n + w) >> 1
        while node:
            other = losers[node]
            x = heads[w]
            if x is None or (heads[other] is not None and shared[other] > shared[w]):
                losers[node], w = w, other
            elif heads[other] is not None and shared[other] == shared[w]:
                w, losers[node] = play(w, other) if w < other else play(other, w)
            node >>= 1


def _context(key: bytes) -> bytes:
    return key[1 + LENGTH : LENGTH + key[-1]][::-1] + key[1 : 1 + key[-2]]


def covered(keys: list[bytes], least: list[int]) -> list[int]:
    """For each of the contexts of one key: a mask of its strings that a context of a smaller doc_id has."""
    contexts = [_context(k) for k in keys]
    seen: dict[bytes, int] = {}
    for context, doc in zip(contexts, least, strict=True):
        for j in range(len(context) - LENGTH + 1):
            s = context[j : j + LENGTH]
            if seen.get(s, _NO_ID) > doc:
                seen[s] = doc
    return [sum(1 << j for j in range(len(c) - LENGTH + 1) if seen.get(c[j : j + LENGTH], doc) < doc) for c, doc in zip(contexts, least, strict=True)]


# --- the four steps as DataFrames --------------------------------------------

_TABLE = "segment string, bucket int, hashes binary, docs binary"


def _bounds(buckets: int, sorted_hashes: np.ndarray) -> np.ndarray:
    return np.searchsorted(sorted_hashes >> np.uint64(32), (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets), "left")


_KINDS = {"segment": pa.string(), "bucket": pa.int32()}


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], _KINDS.get(n, pa.binary())) for i, n in enumerate(names)], list(names))


def _pack(buckets: int):
    def give(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        ids = np.asarray(table.column("doc_id").cast(pa.int64()).fill_null(_NO_ID))
        data, offs = textbuf.buffers(table.column("text"))
        segment = Segment(ids, offs, data)
        hashes = segment.grams[0]
        to, name = _bounds(buckets, hashes), uuid.uuid4().hex
        # the low half of a hash is enough within a bucket, which the high half chose: one that is wrongly taken for repeated does no harm
        short = hashes.astype("<u4")
        rows = [(name, -1, None, segment.pack())]
        rows += [(name, b, short[to[b] : to[b + 1]].tobytes(), None) for b in range(buckets) if to[b] < to[b + 1]]
        yield _batch(rows, ("segment", "bucket", "hashes", "docs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in textbuf.pieces(batches, "text"):
            held.append(piece)
            size += piece.nbytes
            if size >= SEGMENT_BYTES:
                yield from give(held)
                held, size = [], 0
        if held:
            yield from give(held)

    return run


def _repeated(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each segment of a bucket: a bit for each of its hashes that another segment has, and one for hot ones."""
    names, raws = [], []
    for batch in batches:
        names += batch.column("segment").to_pylist()
        raws += batch.column("hashes").to_pylist()
    _, number, counts = np.unique(np.frombuffer(b"".join(raws), "<u4"), return_inverse=True, return_counts=True)
    count = counts[number]
    at, bucket, rows = 0, key[0].as_py(), []
    for name, raw in zip(names, raws, strict=True):
        own = count[at : at + len(raw) // 4]
        at += len(own)
        hot = own > HOT_SEGMENTS
        rows.append((name, bucket, np.packbits(own > 1).tobytes(), np.packbits(hot).tobytes() if hot.any() else None))
    yield _batch(rows, ("segment", "bucket", "repeated", "hot"))


def _flags(segment: Segment, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = segment.grams[0]
    to = _bounds(buckets, hashes)
    repeated, hot = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    for b, r, o in zip(*(answers.column(c).to_pylist() for c in ("bucket", "repeated", "hot")), strict=True):
        if r is not None:
            n = to[b + 1] - to[b]
            repeated[to[b] : to[b + 1]] = np.unpackbits(np.frombuffer(r, np.uint8), count=n)
            if o is not None:
                hot[to[b] : to[b + 1]] = np.unpackbits(np.frombuffer(o, np.uint8), count=n)
    return repeated, hot


_RUN = "segment string, bucket int, shared binary, rests binary, docs binary, places binary"


def _runs(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for name, packed in zip(left.column("segment").to_pylist(), left.column("docs").to_pylist(), strict=True):
            segment = Segment.unpack(packed)
            found = segment.entries(*_flags(segment, right, buckets))
            if not len(found.rows):
                continue
            bucket = ((found.hash >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            to = np.searchsorted(bucket[order], np.arange(buckets + 1))
            shared, rests = front_coded(found.rows[order], to[:-1][np.diff(to) > 0])
            ends = np.concatenate([[0], np.cumsum(ROW - np.frombuffer(shared, np.uint8).astype(np.int64))])[to]
            docs, places = found.least[order].astype("<i8"), order.astype("<u4")
            for b in np.flatnonzero(np.diff(to)).tolist():
                own = slice(to[b], to[b + 1])
                rows.append((name, b, shared[own], rests[ends[b] : ends[b + 1]], docs[own].tobytes(), places[own].tobytes()))
        return pa.Table.from_batches([_batch(rows, ("segment", "bucket", "shared", "rests", "docs", "places"))])

    return run


def _merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each segment of a bucket: places of its entries and masks of their strings to remove."""
    names, coded, docs, places = [], [], [], []
    for batch in batches:
        for name, shared, rests, d, p in zip(*(batch.column(c).to_pylist() for c in ("segment", "shared", "rests", "docs", "places")), strict=True):
            names.append(name)
            coded.append((shared, rests))
            docs.append(np.frombuffer(d, "<i8"))
            places.append(np.frombuffer(p, "<u4"))
    runs = [(keys, shared) for keys, (shared, _) in zip(all_decoded(coded), coded, strict=True)]
    del coded
    n = sum(map(len, docs))
    order = np.fromiter((x for found in merged(runs) for x in found), np.int64, 3 * n).reshape(n, 3)
    run, place, shared = order[:, 0], order[:, 1], order[:, 2]
    base = np.cumsum([0] + [len(d) for d in docs])
    doc = np.concatenate(docs)[base[run] + place]
    new_key = shared < ROW
    new_group = shared < 1 + KEY
    new_key[:1] = new_group[:1] = True
    first = np.flatnonzero(new_key)
    least = np.minimum.reduceat(doc, first)
    strings = np.array([runs[r][0][p][-2] + runs[r][0][p][-1] - LENGTH for r, p in zip(run[first].tolist(), place[first].tolist(), strict=True)], np.uint64)
    full = (np.uint64(1) << strings) - np.uint64(1)
    own = np.zeros(len(first), np.uint64)
    group = np.cumsum(new_group[first]) - 1
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.append(starts[1:], len(group))
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        keys = [runs[run[i]][0][place[i]] for i in first[s:e]]
        if keys[0][0] == CONTEXT:
            own[s:e] = covered(keys, least[s:e].tolist())
    of = np.cumsum(new_key) - 1
    mask = np.where(doc > least[of], full[of], own[of])
    on = np.flatnonzero(mask != 0)
    on = on[np.argsort(run[on], kind="stable")]
    to = np.searchsorted(run[on], np.arange(len(names) + 1))
    where, masks = np.concatenate(places)[base[run[on]] + place[on]], mask[on].astype("<u4")
    rows = [(names[r], where[to[r] : to[r + 1]].tobytes(), masks[to[r] : to[r + 1]].tobytes()) for r in np.flatnonzero(np.diff(to)).tolist()]
    yield _batch(rows, ("segment", "where", "masks"))


def _cut(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        done = []
        for packed in left.column("docs").to_pylist():
            segment = Segment.unpack(packed)
            found = segment.entries(*_flags(segment, right, buckets))
            ids, offs = segment.ids, segment.offs
            masks = np.zeros(len(found.rows), np.uint64)
            for where, m in zip(right.column("where").to_pylist(), right.column("masks").to_pylist(), strict=True):
                if where is not None:
                    masks[np.frombuffer(where, "<u4")] = np.frombuffer(m, "<u4")
            full = (np.uint64(1) << found.strings.astype(np.uint64)) - np.uint64(1)
            own = np.where(ids[found.doc] > found.least[found.entry], full[found.entry], masks[found.entry])
            starts = np.zeros(len(segment.data) + 1, bool)
            for j in range(REACH):
                starts[found.lo[(own >> np.uint64(j) & np.uint64(1)).astype(bool)] + j] = True
            sums = np.zeros(len(starts) + 1, np.int32)
            np.cumsum(starts, out=sums[1:])
            i = np.arange(len(segment.data), dtype=np.int32)
            gone = sums[i + 1] > sums[np.maximum(i + 1 - LENGTH, 0)]
            spans = np.bincount(textbuf.runs(gone, offs)[2], minlength=len(ids))
            removed = textbuf.per_doc(gone, offs)
            to = offs - np.concatenate([[0], np.cumsum(removed)])
            columns = {
                "doc_id": pa.array(ids, mask=ids == _NO_ID),
                "n_bytes": pa.array(np.diff(offs)),
                "n_removed": pa.array(removed),
                "n_spans": pa.array(spans.astype(np.int64)),
                "kept": _binary(to, segment.data[~gone]).cast(pa.binary()),
            }
            done.append(pa.table(columns))
        return pa.concat_tables(done)

    return run


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of the texts of LENGTH bytes or more that a smaller doc_id has as a whole."""
    ids = stored(docs.where(F.octet_length("text") >= LENGTH).select("doc_id", F.sha2("text", 256).alias("digest")), "suffix-digests")
    least = ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").select("digest", "least")
    found = ids.join(ids_hint(stored(least, "suffix-least")), "digest").where("doc_id > least OR (doc_id IS NULL AND least IS NOT NULL)")
    return stored(found.select("doc_id", "digest").distinct(), "suffix-copies")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row."""
    spark = docs.sparkSession
    buckets = parts(frugal(docs))
    name = f"suffix_segments_{uuid.uuid4().hex}"
    whole = ids_hint(copies(docs))
    rows = docs.select("doc_id", "text")
    same = F.sha2(rows["text"], 256).eqNullSafe(whole["digest"]) & rows["doc_id"].eqNullSafe(whole["doc_id"])
    gone = rows.join(whole, same, "left_semi").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    rows.join(whole, same, "left_anti").mapInArrow(_pack(buckets), _TABLE).write.bucketBy(buckets, "segment").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    packed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows their buckets
    owners = packed.where("bucket = -1").select("segment", "docs")
    asked = packed.where("bucket >= 0").select("segment", "bucket", "hashes")
    answers = stored(asked.groupBy("bucket").applyInArrow(_repeated, "segment string, bucket int, repeated binary, hot binary"), "suffix-answers")
    runs = owners.groupBy("segment").cogroup(answers.groupBy("segment")).applyInArrow(_runs(buckets), _RUN)
    masks = stored(runs.groupBy("bucket").applyInArrow(_merge, "segment string, where binary, masks binary"), "suffix-masks")
    told = answers.unionByName(masks, allowMissingColumns=True)
    left = owners.groupBy("segment").cogroup(told.groupBy("segment")).applyInArrow(_cut(buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return left.union(gone.select("doc_id", "n_bytes", "n_bytes", F.lit(1).cast("long"), F.lit(b"")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, n, c, substr(h, 2 * c + 1, {2000 + 2 * LENGTH}) AS h FROM (SELECT doc_id, n, h, unnest(range(0, n, 1000)) AS c FROM d)),
s AS (SELECT doc_id, c + i AS i, substr(h, 2 * i - 1, {2 * LENGTH}) AS x FROM (SELECT doc_id, c, h, unnest(range(1, least(1000, n - c - {LENGTH - 1}) + 1)) AS i FROM c)),
f AS (SELECT x, min(doc_id) AS first FROM s GROUP BY 1),
g AS (SELECT s.doc_id, i FROM s JOIN f ON s.x = f.x WHERE first < s.doc_id),
b AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM g),
r AS (SELECT doc_id, min(i) AS low, max(i) + {LENGTH - 1} AS high FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b) GROUP BY doc_id, run),
p AS (SELECT doc_id, low, high, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS before FROM r),
k AS (SELECT d.doc_id, sum(high - low + 1) AS removed, count(*) AS spans, concat(string_agg(substr(h, 2 * before + 1, 2 * (low - before - 1)), '' ORDER BY low), substr(any_value(h), 2 * max(high) + 1)) AS kept FROM p JOIN d ON p.doc_id = d.doc_id GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

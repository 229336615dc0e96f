"""Language-model scoring with a weighted backoff automaton, and a unigram base score.

The model is a byte n-gram model of order ORDER with Witten-Bell smoothing,
counted over all training texts (each ends with an end symbol). Every counted
context is a state; each state has arcs for the symbols seen after it and a
failure arc, weighted with its backoff, to its longest proper suffix. The states
and arcs are tables that grow with the corpus and never come to one place: the
failure arcs are resolved by joins, shorter contexts first, for each n-gram that
occurs in any text, so that also those which no training text has get their
weight. The last ORDER symbols fix state and arc, so a segment (below) asks the
buckets of arcs for its distinct ones, reads its texts again with the answers
and adds up log10 probabilities.

The base score takes each token's count from the whole training corpus. A task
packs the tokens of about SEGMENT_BYTES of text as hashes with counts and sends
them to buckets of hashes; a bucket adds up the counts of all segments and
answers each of them; the answers meet their segment again. So each distinct
token of a segment is sent once, however often it is there, and no bucket or
segment grows with a frequent token. Tokens are told apart by 64-bit hashes.

Edge cases: a null text is an empty one: it has the end token alone; without
training rows all counts are 0 and the model knows the end and all bytes as
equally likely; repeated rows each count and are each scored; null doc_ids are
training rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textbuf
from strandline.llm.store import frugal, parts, stored

ORDER = 5
END = 256
SEGMENT_BYTES = 4 << 20
#: Distinct n-grams that a task gathers before it hands them on.
TASK_GRAMS = 1 << 19
CHUNK = 1024
_BITS = 9


def end_windows(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Codes of the ORDER symbols from each position on, the end symbol included and repeated at the end."""
    n = len(offs) - 1
    gap = np.arange(n) * ORDER
    symbols = np.full(len(data) + n * ORDER, END, np.int64)
    doc = np.repeat(np.arange(n), np.diff(offs))
    symbols[np.arange(len(data)) + doc * ORDER] = data
    code = np.zeros(len(symbols) - ORDER + 1, np.int64)
    for k in range(ORDER):
        code = code << _BITS | symbols[k : k + len(code)]
    keep = np.zeros(len(code), bool)
    keep[np.arange(len(data)) + doc * ORDER] = True
    keep[offs[1:] + gap] = True
    return code[keep]


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


# --- the model ---------------------------------------------------------------


def count_grams(docs: DataFrame) -> DataFrame:
    """(code, n): the windows of ORDER symbols of all texts, with their counts over those that aren't held out (0 for others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        give = lambda: pa.record_batch([pa.array(keys), pa.array(counts)], ["code", "n"])
        for piece in textbuf.pieces(batches, "text"):
            data, offs = textbuf.buffers(piece.column("text"))
            windows, held = end_windows(data, offs), np.repeat(np.asarray(piece.column("held")), np.diff(offs) + 1)
            k, c = np.unique(windows[~held], return_counts=True)
            other = np.unique(windows[held])
            keys, counts = _sums(np.concatenate([keys, k, other]), np.concatenate([counts, c, np.zeros(len(other), np.int64)]))
            if len(keys) > TASK_GRAMS:
                yield give()
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield give()

    got = frugal(docs).select("text", "held").mapInArrow(run, "code long, n long")
    return got.groupBy("code").agg(F.sum("n").alias("n"))


class Automaton:
    """The model as one table of states (contexts) and resolved arcs, for a model that fits into memory; tests use it."""

    def __init__(self, contexts: list[tuple[int, int]], arcs: dict[tuple[int, int], list[tuple[int, int]]], total: int):
        """contexts: (length, code); arcs: by context the (symbol, count) seen after it. total: symbols counted."""
        self.number = {c: i for i, c in enumerate(sorted(contexts))}
        n = len(self.number)
        self.table = np.zeros((n, END + 1), np.float32)
        self.next = np.zeros((n, END + 1), np.int16 if n < 1 << 15 else np.int32)
        mask = {k: (1 << _BITS * k) - 1 for k in range(ORDER)}
        for (size, code), i in self.number.items():  # shorter contexts come first
            seen = arcs.get((size, code), [])
            symbols, counts = np.array([s for s, _ in seen], int), np.array([c for _, c in seen], float)
            if size == 0:
                p = np.ones(END + 1)
                p[symbols] += counts
                self.table[i] = np.log10(p / (total + END + 1))
            else:
                below = self.number[(size - 1, code & mask[size - 1])]
                back = len(symbols) / (counts.sum() + len(symbols)) if len(symbols) else 1.0
                self.table[i] = self.table[below] + np.log10(back)
                if len(symbols):
                    self.table[i, symbols] = np.log10(counts / (counts.sum() + len(symbols)) + back * 10.0 ** self.table[below, symbols])
                self.next[i] = self.next[below]
            if size < ORDER - 1:
                for s in range(END):
                    j = self.number.get((size + 1, code << _BITS | s))
                    if j is not None:
                        self.next[i, s] = j
            else:
                self.next[i, :END] = self.next[below, :END]
        self.root = self.number[(0, 0)]

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each text with its end."""
        n = len(offs) - 1
        lengths = np.diff(offs) + 1  # with the end symbol
        n_chunks = -(-lengths // CHUNK)
        doc = np.repeat(np.arange(n), n_chunks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        start = offs[doc] + nth * CHUNK
        stop = np.minimum(start + CHUNK, offs[doc + 1] + 1)
        warm = np.minimum(ORDER - 1, start - offs[doc])
        order = np.argsort(-(stop - start), kind="stable")
        doc, start, stop, warm = doc[order], start[order], stop[order], warm[order]
        state, total = np.full(len(doc), self.root, np.int64), np.zeros(len(doc))
        padded = np.append(data, 0)
        width = END + 1
        table, nxt = self.table.ravel(), self.next.ravel()
        for k in range(ORDER - 1, 0, -1):
            on = warm >= k
            state[on] = nxt[state[on] * width + padded[start[on] - k]]
        last = offs[doc + 1]
        size = stop - start
        for t in range(int(size.max(initial=0))):
            m = int(np.searchsorted(-size, -t, "left"))  # chunks longer than t
            at = start[:m] + t
            symbol = padded[at].astype(np.int64)
            symbol[at == last[:m]] = END
            key = state[:m] * width + symbol
            total[:m] += table[key]
            state[:m] = nxt[key]
        return np.bincount(doc, total, n)


def arc_keys(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The arc by which each symbol, the ends included, is read: the last ORDER symbols, or all since the text's start, after a 1."""
    n = len(offs) - 1
    starts = offs[:-1] + np.arange(n)
    nth = np.arange(len(data) + n) - np.repeat(starts, np.diff(offs) + 1)
    symbols = np.full(len(data) + n, END, np.int64)
    symbols[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offs))] = data
    keys = symbols | np.int64(1) << _BITS * np.minimum(nth + 1, ORDER)
    for k in range(1, ORDER):
        keys[k:] |= np.where(nth[k:] >= k, symbols[: len(symbols) - k] << _BITS * k, 0)
    return keys


def arcs(grams: DataFrame) -> DataFrame:
    """(key, weight): log10 of the probability of each n-gram's last symbol after the others, from the counted windows."""
    prefix = [grams.select(F.lit(k).alias("size"), F.shiftright("code", _BITS * (ORDER - k)).alias("code"), "n") for k in range(1, ORDER + 1)]
    every = prefix[0]
    for p in prefix[1:]:
        every = every.union(p)
    # windows that run past an end repeat it; those n-grams were counted once, at their first end
    ended = (F.col("size") > 1) & (F.shiftright("code", _BITS) % (1 << _BITS) == END)
    counts = stored(every.where(~ended).groupBy("size", "code").agg(F.sum("n").alias("n")), "lm-grams")
    total = counts.where("size = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    level = stored(counts.where("size = 1").select("code", ((F.col("n") + 1) / F.lit(float(total + END + 1))).alias("p")), "lm-arcs")
    done = level.select((F.col("code") + (1 << _BITS)).alias("key"), F.log10("p").alias("weight"))
    for size in range(2, ORDER + 1):
        own = counts.where(F.col("size") == size).select("code", "n", F.shiftright("code", _BITS).alias("context"), (F.col("code") % (1 << _BITS * (size - 1))).alias("suffix"))
        states = own.where("n > 0").groupBy("context").agg(F.sum("n").alias("seen"), F.count("*").alias("kinds"))
        below = level.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
        resolved = (F.col("n") + F.col("kinds") * F.col("below")) / (F.col("seen") + F.col("kinds"))
        level = stored(own.join(states, "context", "left").join(below, "suffix").select("code", F.coalesce(resolved, "below").alias("p")), "lm-arcs")
        done = done.union(level.select((F.col("code") + (1 << _BITS * size)).alias("key"), F.log10("p").alias("weight")))
    return done


# --- the base score ----------------------------------------------------------

_SEGMENT = "segment string, bucket int, hashes binary, counts binary, docs binary"


#: Arcs are dealt out to buckets by the remainder of their keys by this prime.
_PRIME = 1_000_003


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences."""
    return zlib.compress(np.diff(keys, prepend=0).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.int64))


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): the order of ascending keys by bucket, and where each bucket starts and ends in it."""
    bucket = keys % _PRIME % buckets
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1), "left")


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of each token."""
    data = textbuf.LOWER[data]
    starts, ends, doc = textbuf.words(data, offs)
    return textbuf.segment_hash(textbuf.prefix(data), starts, ends), doc


def _segments(buckets: int):
    """Rows of the packed tokens of each segment (bucket >= 0) and of its arcs (from bucket `buckets` on), and one of its documents (bucket -1)."""

    def give(held: list) -> Iterator[pa.RecordBatch]:
        name = uuid.uuid4().hex
        hashes, inverse = np.unique(np.concatenate([h["hash"] for h in held]), return_inverse=True)
        train = np.concatenate([h["train"] for h in held])
        counts = np.bincount(inverse[train], minlength=len(hashes)).astype(np.int32)
        docs = {"doc_id": pa.concat_arrays([h["doc_id"] for h in held]), "held": pa.array(np.concatenate([h["held"] for h in held])), "text": pa.concat_arrays([h["text"] for h in held])}
        sink = pa.BufferOutputStream()
        table = pa.table(docs)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
            w.write_table(table)
        to = np.searchsorted(hashes >> np.uint64(32), (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets), "left")
        keys = np.unique(np.concatenate([h["arcs"] for h in held]))
        order, bounds = _dealt(keys, buckets)
        rows = [(name, -1, _pack(keys), None, sink.getvalue().to_pybytes())]
        rows += [(name, b, hashes[to[b] : to[b + 1]].tobytes(), counts[to[b] : to[b + 1]].tobytes(), None) for b in range(buckets) if to[b] < to[b + 1]]
        rows += [(name, buckets + b, _pack(keys[order[bounds[b] : bounds[b + 1]]]), None, None) for b in range(buckets) if bounds[b] < bounds[b + 1]]
        for at in range(0, len(rows), 64):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 64], strict=True), (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["segment", "bucket", "hashes", "counts", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in textbuf.pieces(batches, "text"):
            data, offs = textbuf.buffers(piece.column("text"))
            read = np.unique(arc_keys(data, offs))
            hashes, doc = _tokens(data, offs)
            out = np.asarray(piece.column("held"))
            held.append({"hash": hashes, "train": ~out[doc], "doc_id": piece.column("doc_id"), "held": out, "text": piece.column("text"), "arcs": read})
            size += len(data) + 64 * len(offs)
            if size >= SEGMENT_BYTES:
                yield from give(held)
                held, size = [], 0
        if held:
            yield from give(held)

    return run


def _answer(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's counts over all segments, given back to each segment, with the bucket's totals in its first row."""
    names, hashes, counts = [], [], []
    for batch in batches:
        names += batch.column("segment").to_pylist()
        hashes += [np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist()]
        counts += [np.frombuffer(x, np.int32) for x in batch.column("counts").to_pylist()]
    keys, totals = _sums(np.concatenate(hashes), np.concatenate(counts).astype(np.int64))
    bucket = key[0].as_py()
    for i, (name, h) in enumerate(zip(names, hashes, strict=True)):
        own = totals[np.searchsorted(keys, h)]
        yield pa.record_batch([[name], pa.array([bucket], pa.int32()), pa.array([own.astype("<i8").tobytes()], pa.binary()), pa.array([int(totals.sum()) if i == 0 else 0]), pa.array([int((totals > 0).sum()) if i == 0 else 0])], ["segment", "bucket", "counts", "tokens", "distinct"])


def _weigh(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    """The weights of a bucket's arcs, given to each segment that asks for some of them."""
    order = np.argsort(keys := known.column("key").to_numpy(), kind="stable")
    keys, weights = keys[order], known.column("weight").to_numpy()[order].astype(np.float32)
    own = [weights[np.searchsorted(keys, _unpack(h))].tobytes() for h in asked.column("hashes").to_pylist()]
    return pa.table({"segment": asked.column("segment"), "bucket": asked.column("bucket"), "counts": pa.array(own, pa.binary())})


def _finish(tokens: int, distinct: int, ends: int, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = sorted(zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist(), strict=True))
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, "<i8") for b, c in answers if b < buckets)])
        weights = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(c, np.float32) for b, c in answers if b >= buckets)])
        value = np.log10((counts + 1.0) / (tokens + distinct + 1))
        done = []
        for packed, arcs in zip(left.column("docs").to_pylist(), left.column("hashes").to_pylist(), strict=True):
            keys = _unpack(arcs)
            weight = np.zeros(len(keys))
            weight[_dealt(keys, buckets)[0]] = weights
            table = pa.ipc.open_stream(packed).read_all().combine_chunks()
            scores, hashes, lengths = [], [np.zeros(0, np.uint64)], []
            for piece in textbuf.pieces(table.to_batches(), "text"):
                data, offs = textbuf.buffers(piece.column("text"))
                scores.append(np.bincount(np.repeat(np.arange(piece.num_rows), np.diff(offs) + 1), weight[np.searchsorted(keys, arc_keys(data, offs))], piece.num_rows))
                token, doc = _tokens(data, offs)
                hashes.append(token)
                lengths.append(np.bincount(doc, minlength=piece.num_rows).astype(np.int64))
            flat = np.unique(np.concatenate(hashes), return_inverse=True)[1]
            n = np.concatenate(lengths)
            at = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0.0], np.cumsum(value[flat])])
            known = np.concatenate([[0], np.cumsum(counts[flat] > 0)])
            end = np.log10((ends + 1.0) / (tokens + distinct + 1))
            out = {
                "doc_id": table.column("doc_id"), "held_out": table.column("held"), "n_tokens": pa.array(n + 1), "n_known": pa.array(known[at[1:]] - known[at[:-1]] + int(ends > 0)),
                "train_tokens": pa.array(np.full(len(n), tokens)), "base_score": pa.array(sums[at[1:]] - sums[at[:-1]] + end), "score": pa.array(np.concatenate(scores)),
            }
            done.append(pa.table(out))
        return pa.concat_tables(done)

    return run


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select("doc_id", "text", held.alias("held"))
    grams = arcs(stored(count_grams(rows), "lm-windows"))
    buckets = parts(docs)
    packed = stored(rows.mapInArrow(_segments(buckets), _SEGMENT), "lm-segments")
    asked = packed.where(F.col("bucket").between(0, buckets - 1)).select("segment", "bucket", "hashes", "counts")
    answers = stored(asked.groupBy("bucket").applyInArrow(_answer, "segment string, bucket int, counts binary, tokens long, distinct long"), "lm-answers")
    dealt = grams.withColumn("bucket", (F.col("key") % _PRIME % buckets + buckets).cast("int")).groupBy("bucket")
    wanted = packed.where(F.col("bucket") >= buckets).select("segment", "bucket", "hashes").groupBy("bucket")
    weights = wanted.cogroup(dealt).applyInArrow(_weigh, "segment string, bucket int, counts binary")
    total = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).first()
    ends = rows.where(~F.col("held")).count()
    owners = packed.where("bucket = -1").select("segment", "hashes", "docs")
    run = _finish(total.tokens + ends, total.distinct + int(ends > 0), ends, buckets)
    return owners.groupBy("segment").cogroup(answers.select("segment", "bucket", "counts").union(weights).groupBy("segment")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

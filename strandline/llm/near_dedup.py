"""Near-duplicate documents: MinHash signatures joined by Hamming distance over multiple indexes.

Each document's set of SHINGLE-word shingles gets a signature of SYMBOLS b-bit
minima. Two sets of a given similarity differ in a symbol with a probability of
one less it. The signature is split into chunks: by the pigeonhole principle, two
signatures that differ in at most `distance` = 2 * chunks - 1 symbols have a chunk
with at most one error, so the index of each chunk holds it once for every place
of that error, left out. All pairs within the distance meet under a key, and so do
nearly all others: there are as many chunks as it takes for a pair at the limit of
similarity to meet under none with a chance of less than MISSED. Links are
confirmed on the full sets of words, not on hashes.

Equal sets (by a 128-bit sum of hashes) are one class from the start. The classes
that meet under a key, are of compatible sizes and can be within the distance, by
two bits of each symbol, are near; from each group with a common key only a spanning forest of nearness goes
on, so a group of n classes gives fewer than n rows. Keys travel packed and
sorted into buckets. Before they do, the many classes of a piece that share a
key and a band of sizes are hung on one of them, which alone is sent on; it is
near to all under that key whose sizes can be compatible. So a key of a third of
all classes sends a few rows a piece to its bucket, and what is near is only
widened. No list of pairs is ever written.

Near classes are families, and links are confirmed on full sets within them.
Members are dealt to blocks; each block is held against itself and the first
one, one pair of blocks a task. What this connects is known; then only blocks of
different components (or of small ones) are held against each other. A family of
copies of one text so costs in proportion to its members, not to their square.

Edge cases: a text of fewer than SHINGLE words is one shingle; null, empty and
blank texts have none and are linked with nothing; rows that share a doc_id are
one node; rows with a null doc_id are linked with nothing and kept; an empty
table gives no rows; texts are read whole, whatever their length; a group's least
doc_id stays, and of rows that share it that with the least text, then the least
of its other columns as JSON; columns of any name stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textbuf
from strandline.llm.components import components
from strandline.llm.store import frugal, ids_hint, parts, stored

SHINGLE = 5
SIMILARITY = 85
SYMBOLS = 64
#: Chance with which a pair just at the limit of similarity may meet under no key.
MISSED = 1e-8
#: Classes of a piece, and the number of them with a common key beyond which they are hung on one.
PIECE_ROWS = 8192
HOT_ROWS = 32
#: Keys in a bucket, and members of a family in a block, about.
BUCKET_KEYS = 1 << 20
BLOCK_MEMBERS = 512

_rng = np.random.default_rng(20240229)
_SCALE = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64)
_ODD = np.uint64(0x5555555555555555)
#: Cells by which an upper bound of what two sets have in common is counted.
_CELLS = 256


class Limit:
    """A similarity in percent, and the chunks and the signature distance that go with it."""

    def __init__(self, similarity: int = SIMILARITY):
        self.similarity, differ = similarity, 1 - similarity / 100
        for chunks in range(1, SYMBOLS // 2 + 1):
            sizes = [len(c) for c in np.array_split(np.arange(SYMBOLS), chunks)]
            met = [(1 - differ) ** n + n * differ * (1 - differ) ** (n - 1) for n in sizes]
            if math.prod(1 - m for m in met) < MISSED:
                break
        else:
            raise ValueError(f"{SYMBOLS} symbols are too few for a similarity of {similarity}")
        self.chunks, self.distance, self.edges = chunks, 2 * chunks - 1, np.cumsum([0, *sizes])

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes can be similar enough."""
        return 100 * np.minimum(a, b) >= self.similarity * np.maximum(a, b)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit shingle hashes, sorted and distinct within each text; offsets)."""
    n = len(offs) - 1
    data = textbuf.LOWER[data]
    starts, ends, doc = textbuf.words(data, offs)
    to = textbuf.spread(doc, n)
    hashes = textbuf.segment_hash(textbuf.prefix(data), starts, ends)
    h, h_doc = textbuf.window_hash(hashes, to, width)
    few = np.flatnonzero((np.diff(to) > 0) & (np.diff(to) < width))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            on = np.diff(to)[few] > k
            whole[on] = textbuf.mix(whole[on] * np.uint64(3) + hashes[to[few[on]] + k])
        h, h_doc = np.concatenate([h, whole]), np.concatenate([h_doc, few])
    key = np.sort(h_doc.astype(np.uint64) << np.uint64(48) | h >> np.uint64(16))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key & np.uint64((1 << 48) - 1), np.searchsorted(key >> np.uint64(48), np.arange(n + 1, dtype=np.uint64), "left")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in textbuf.pieces(batches, "text"):
        for at in range(0, piece.num_rows, 1 << 15):
            yield piece.slice(at, 1 << 15)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), s1 and s2 (the set's identity) and sig (SYMBOLS 16-bit symbols)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            values, offs = shingle_sets(*textbuf.buffers(piece.column("text")))
            n = np.diff(offs)
            full = np.flatnonzero(n)
            sig = np.zeros((len(n), SYMBOLS), "<u2")
            if len(full):
                at = offs[:-1][full]
                for k in range(SYMBOLS):
                    sig[full, k] = textbuf.mix(np.minimum.reduceat(values * _SCALE[k] + _SHIFT[k], at)).astype(np.uint16)
            ids = [np.zeros(len(n), np.uint64) for _ in range(2)]
            if len(full):
                for k, out in enumerate(ids):
                    out[full] = np.add.reduceat(textbuf.mix(values + np.uint64(k) * np.uint64(0xD1B54A32D192ED03)), at)
            yield pa.record_batch(
                [piece.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), *[pa.array(x.view(np.int64)) for x in ids], pa.array([r.tobytes() for r in sig], pa.binary())],
                ["doc_id", "n", "s1", "s2", "sig"],
            )

    return frugal(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sig binary")


def _keys(sig: np.ndarray, limit: Limit) -> Iterator[np.ndarray]:
    """For each chunk and place of an error: the keys of all signatures."""
    wide = sig.astype(np.uint64)
    for first, last in zip(limit.edges, limit.edges[1:], strict=False):
        for out in range(first, last):
            key = np.full(len(sig), out + 1, np.uint64)
            for k in range(first, last):
                if k != out:
                    key = textbuf.mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, k] + np.uint64(1))
            yield key


_PACKED = "bucket int, keys binary, reps binary, lows binary, highs binary, bits0 binary, bits1 binary, hot binary, edges binary"
_FIELDS = {"keys": "<u8", "reps": "<i8", "lows": "<i8", "highs": "<i8", "bits0": "<u8", "bits1": "<u8", "hot": "u1"}


def _bulk(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches as tables of `rows` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            whole = pa.Table.from_batches(held)
            while whole.num_rows >= rows:
                yield whole.slice(0, rows)
                whole = whole.slice(rows)
            held = whole.to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _contracted(keys: np.ndarray, row: np.ndarray, sizes: np.ndarray, reps: np.ndarray, limit: Limit) -> tuple[np.ndarray, ...]:
    """(places that stay, low and high size, hot, edges): of more than HOT_ROWS entries with one key and band of sizes only the first stays.

    keys are sorted and row has their places in sizes and reps. A band's sizes are
    compatible with each other; the edges are pairs of reps, each once.
    """
    band = (np.log(sizes[row]) / -np.log(limit.similarity / 100)).astype(np.int64)
    order = np.lexsort((band, keys))
    k, v = keys[order], band[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])]))
    count = np.diff(np.append(first, len(k)))
    size = sizes[row[order]]
    many = np.repeat(count > HOT_ROWS, count)
    leads = np.repeat(first, count)
    stays = np.flatnonzero(~many | (leads == np.arange(len(k))))
    hung = np.flatnonzero(many & (leads != np.arange(len(k))))
    low, high = (np.repeat(f.reduceat(size, first), count) for f in (np.minimum, np.maximum))
    low, high = np.where(many, low, size), np.where(many, high, size)
    edges = np.unique(np.stack([reps[row[order[leads[hung]]]], reps[row[order[hung]]]], axis=1), axis=0) if len(hung) else np.zeros((0, 2), np.int64)
    # back in the order of keys, in which buckets are cut
    return order[stays], low[stays], high[stays], many[stays].astype(np.uint8), edges


def _packed(classes: DataFrame, buckets: int, limit: Limit) -> DataFrame:
    """Keys of all classes (rep, n, sig), sorted into buckets and packed; edges of hot keys go to any bucket, by their own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _bulk(batches, PIECE_ROWS):
            sig = np.frombuffer(b"".join(piece.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            bits = np.packbits(np.stack([sig & 1, sig >> 1 & 1], axis=2).astype(np.uint8).reshape(len(sig), -1), axis=1).view(np.uint64)
            reps, sizes = np.asarray(piece.column("rep")).astype("<i8"), np.asarray(piece.column("n")).astype("<i8")
            keys = np.concatenate(list(_keys(sig, limit)))
            order = np.argsort(keys, kind="stable")
            stays, low, high, hot, edges = _contracted(keys[order], order % len(sig), sizes, reps, limit)
            keys, row = keys[order][stays], order[stays] % len(sig)
            columns = [keys, reps[row], low, high, bits[row, 0], bits[row, 1], hot]
            to = np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64), "left")
            dealt = (textbuf.mix(edges[:, 1].astype(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            edges = edges[np.argsort(dealt, kind="stable")]
            at = np.searchsorted(np.sort(dealt), np.arange(buckets + 1, dtype=np.uint64), "left")
            rows = [(b, *(c[to[b] : to[b + 1]].tobytes() for c in columns), edges[at[b] : at[b + 1]].tobytes()) for b in range(buckets) if to[b] < to[b + 1] or at[b] < at[b + 1]]
            for first in range(0, len(rows), 128):
                yield pa.record_batch([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows[first : first + 128], strict=True))], ["bucket", *_FIELDS, "edges"])
            del keys, row, order, stays, low, high, hot, columns, rows
            textbuf.given_back()

    return classes.select("rep", "n", "sig").mapInArrow(run, _PACKED)


def _forests(limit: Limit, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): a spanning forest of the near classes of each group of a bucket, and the edges that were sent along."""
    parts: dict[str, list[bytes]] = {name: [] for name in [*_FIELDS, "edges"]}
    for batch in batches:
        for name, held in parts.items():
            held += batch.column(name).to_pylist()
    sent = np.frombuffer(b"".join(parts.pop("edges")), "<i8").reshape(-1, 2)
    keys, reps, lows, highs, bits, more, hot = (np.frombuffer(b"".join(parts.pop(name)), t) for name, t in _FIELDS.items())
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
    if not len(shared) and not len(sent):
        return
    keys, reps, lows, highs, bits, more, hot = (c[shared] for c in (keys, reps, lows, highs, bits, more, hot))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    ends = np.append(first[1:], len(keys))[: len(first)]
    meet = lambda i, j: (100 * highs[i] >= limit.similarity * lows[j]) & (100 * highs[j] >= limit.similarity * lows[i])
    differ = lambda x: np.bitwise_count((x | x >> np.uint64(1)) & _ODD)
    within = lambda i, j: differ(bits[i] ^ bits[j]) + differ(more[i] ^ more[j]) <= limit.distance
    near = lambda i, j: meet(i, j) & (hot[i].astype(bool) | hot[j].astype(bool) | within(i, j))
    twos = first[ends - first == 2]
    twos = twos[near(twos, twos + 1)]
    left, right = [sent[:, 0], reps[twos]], [sent[:, 1], reps[twos + 1]]
    for s, e in zip(first[ends - first > 2], ends[ends - first > 2], strict=True):
        apart = np.arange(s, e)
        while len(apart) > 1:
            reached, apart = [apart[0]], apart[1:]
            while reached and len(apart):
                i = reached.pop()
                on = near(i, apart)
                met, apart = apart[on], apart[~on]
                reached += met.tolist()
                left.append(np.full(len(met), reps[i]))
                right.append(reps[met])
    a, b = np.concatenate(left), np.concatenate(right)
    names, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    low, high = np.minimum(number[: len(a)], number[len(a) :]), np.maximum(number[: len(a)], number[len(a) :])
    pairs = np.unique(low.astype(np.int64) * max(1, len(names)) + high)
    if len(pairs):
        yield pa.record_batch([pa.array(names[pairs // len(names)]), pa.array(names[pairs % len(names)])], ["a", "b"])


class _Linked:
    """Union-find of a task's members, which begin with the labels of what is known to be connected."""

    def __init__(self, labels: list[int]):
        self.of = np.unique(np.array(labels, np.int64), return_inverse=True)[1]

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.of[others], self.of[i]))
        self.of[np.isin(self.of, roots)] = roots[0]


def _exact_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(shingle numbers, sorted and distinct within each text; offsets): equal numbers are equal shingles, word by word."""
    number: dict[bytes, int] = {}
    words = [t.split() for t in texts]  # at the same characters as textbuf.SPACE
    ids = np.array([number.setdefault(w, len(number)) for own in words for w in own], np.int64)
    n = np.array([len(own) for own in words])
    offs = np.concatenate([[0], np.cumsum(n)])

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a << 32 | b, return_inverse=True)[1] if len(a) else a

    two = joined(ids[:-1], ids[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], ids[SHINGLE - 1 :])
    doc = np.repeat(np.arange(len(texts)), n)
    inside = doc[: len(five)] == doc[SHINGLE - 1 :] if len(five) else np.zeros(0, bool)
    short: dict[tuple, int] = {}
    few = [(i, short.setdefault(tuple(own), len(short))) for i, own in enumerate(words) if 0 < len(own) < SHINGLE]
    top = int(five.max(initial=-1)) + 1
    key = np.concatenate([doc[: len(five)][inside] << 32 | five[inside], np.array([i << 32 | top + k for i, k in few], np.int64)])
    key = np.unique(key)
    return key & 0xFFFFFFFF, np.searchsorted(key >> 32, np.arange(len(offs)), "left")


def _confirm(limit: Limit, key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(component, many, a, b): links among a family's two blocks that, with the labels, connect all members that are connected within them."""
    names, sides, labels, texts = [], [], [], []
    for batch in batches:
        names += batch.column("doc_id").to_pylist()
        sides += batch.column("side").to_pylist()
        labels += batch.column("label").to_pylist()
        texts += [t.as_buffer().to_pybytes().translate(textbuf.LOWER.tobytes()) for t in batch.column("text")]
    if len(names) < 2:
        return
    side, alone = np.array(sides), len(set(sides)) == 1
    member, offs = _exact_sets(texts)
    n = np.diff(offs)
    counts = np.zeros((len(n), _CELLS), np.int32)
    np.add.at(counts, (np.repeat(np.arange(len(n)), n), member % _CELLS), 1)
    linked, mark, found = _Linked(labels), np.zeros(int(member.max(initial=0)) + 1, bool), []
    for i in range(len(n)):
        to = np.arange(i + 1, len(n)) if alone else np.flatnonzero(side != side[i]) if side[i] == min(sides) else np.zeros(0, int)
        to = to[linked.of[to] != linked.of[i]]
        to = to[limit.compatible(n[i], n[to])]
        # no more can be in common than the cells allow
        most = np.minimum(counts[to], counts[i]).sum(axis=1)
        to = to[100 * most >= limit.similarity * (n[i] + n[to] - most)]
        if not len(to):
            continue
        mark[member[offs[i] : offs[i + 1]]] = True
        at = np.repeat(offs[to] - np.cumsum(n[to]) + n[to], n[to]) + np.arange(n[to].sum())
        both = np.add.reduceat(mark[member[at]].astype(np.int64), np.cumsum(n[to]) - n[to])
        mark[member[offs[i] : offs[i + 1]]] = False
        to = to[100 * both >= limit.similarity * (n[i] + n[to] - both)]
        if len(to):
            once = to[np.unique(linked.of[to], return_index=True)[1]]
            linked.join(i, once)
            found += [(names[i], names[j]) for j in once]
    if found:
        _, many, component = (k.as_py() for k in key)
        of = [pa.array([component] * len(found), pa.int64()), pa.array([many] * len(found), pa.bool_())]
        yield pa.record_batch([*of, *(pa.array(c, pa.int64()) for c in zip(*found, strict=True))], ["component", "many", "a", "b"])


_ROLE = ["task", "many", "component", "side", "label", "doc_id"]


def _held(docs: DataFrame, roles: DataFrame, limit: Limit) -> DataFrame:
    """Links (component, many, a, b) of the tasks whose members are the roles; a row without words has no part in them."""
    roles = stored(roles.select(*_ROLE), "near-roles")
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(worded).join(ids_hint(roles), "doc_id").select(*_ROLE, "text")

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _confirm(limit, key, batches)
        textbuf.given_back()

    return stored(members.groupBy("task", "many", "component").applyInArrow(run, "component long, many boolean, a long, b long").where("a <> b").distinct(), "near-confirmed")


def _apart(families: DataFrame, links: DataFrame) -> DataFrame:
    """Roles for what the first links leave apart, in families (node, component) of many blocks.

    A component of a block's members or more has blocks of its own, which needn't
    meet each other; smaller ones share blocks. Blocks are paired by the groups
    that they are of, so no pair within a large component is ever listed.
    """
    known = components(links)
    members = families.join(known.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = members.groupBy("component", "label").agg(F.count("*").alias("n")).withColumn("big", F.col("n") >= BLOCK_MEMBERS)
    sizes = sizes.withColumn("g", F.when(F.col("big"), F.col("label")).otherwise(0)).drop("n")
    members = stored(members.join(sizes, ["component", "label"]), "near-members")
    groups = stored(members.groupBy("component", "big", "g").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("blocks")), "near-blocks")
    dealt = members.join(groups, ["component", "big", "g"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks"))

    a, b = (groups.select("component", *[F.col(c).alias(f"{s}_{c}") for c in ("big", "g", "blocks")]) for s in "ab")
    small = ~F.col("a_big") & ~F.col("b_big")
    met = a.join(b, "component").where(small | (F.struct("a_big", "a_g") < F.struct("b_big", "b_g")))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    met = met.withColumn("i", upto("a_blocks")).withColumn("j", upto("b_blocks")).where(~small | (F.col("i") <= F.col("j")))
    met = met.withColumn("task", F.concat_ws("/", "component", "a_big", "a_g", "i", "b_big", "b_g", "j"))
    left = met.select("component", F.col("a_big").alias("big"), F.col("a_g").alias("g"), F.col("i").alias("block"), "task", F.lit(0).alias("side"))
    right = met.where(~(small & (F.col("i") == F.col("j")))).select("component", F.col("b_big").alias("big"), F.col("b_g").alias("g"), F.col("j").alias("block"), "task", F.lit(1).alias("side"))
    return dealt.join(left.union(right), ["component", "big", "g", "block"]).select("task", F.lit(True).alias("many"), "component", "side", "label", F.col("node").alias("doc_id"))


def confirmed(docs: DataFrame, families: DataFrame, limit: Limit) -> DataFrame:
    """Links (a, b) of the families (node, component), confirmed on full sets; they connect what all links connect."""
    size = families.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("blocks"))
    dealt = families.join(size, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("many", F.col("blocks") > 1)
    # each block meets itself and the first one, whose members are on side 0
    first = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.lit(0).cast("long").alias("i"), o.alias("j"), F.lit(0).alias("side")))
    other = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")), F.struct(F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side")))
    roles = dealt.select("component", "many", F.col("node").alias("doc_id"), F.col("node").alias("label"), F.explode(F.when(F.col("block") == 0, first).otherwise(other)).alias("m"))
    found = _held(docs, roles.select(F.concat_ws("/", "component", "m.i", "m.j").alias("task"), "many", "component", "m.side", "label", "doc_id"), limit)
    large = stored(size.where("blocks > 1").select("component"), "near-large")
    if not large.limit(1).count():
        return found.select("a", "b")
    apart = _apart(families.join(ids_hint(large), "component", "left_semi").select("node", "component"), found.where("many"))
    return found.select("a", "b").union(_held(docs, apart, limit).select("a", "b"))


def groups(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; linked are sets that have `similarity` percent of their union in common."""
    limit = Limit(similarity)

    def forests(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _forests(limit, batches)
        textbuf.given_back()

    marks = stored(sketch(docs), "near-sketch")
    own = marks.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(own.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "near-classes")
    buckets = max(parts(docs), math.ceil(classes.count() * SYMBOLS / BUCKET_KEYS))
    near = stored(_packed(classes, buckets, limit).groupBy("bucket").applyInArrow(forests, "a long, b long"), "near-forest")
    links = stored(confirmed(docs, stored(components(near), "near-families"), limit), "near-links")

    # a class is all rows of one set; a doc_id with several texts ties their classes together
    ties = own.select("doc_id", "s1", "s2", "n").join(classes.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"])
    repeated = stored(ties.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b"), "near-repeated").select("doc_id")
    every = ties.join(ids_hint(repeated), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = components(links.union(every)).withColumnRenamed("node", "rep")
    labelled = classes.join(final, "rep", "left").select("s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    labelled = stored(labelled, "near-labels")
    return marks.join(ids_hint(labelled), ["s1", "s2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return groups(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each group: the rows of `docs` whose doc_id is their component's; of repeated doc_ids one row."""
    marks = stored(groups(docs, similarity), "near-groups")
    out = stored(marks.where("doc_id <> component_id").select("doc_id").distinct(), "near-out")
    rows = docs.join(ids_hint(out), "doc_id", "left_anti").select(*docs.columns)
    again = stored(marks.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-again")
    if not again.limit(1).count():
        return rows
    whole = F.struct(*[F.col(c) for c in docs.columns])
    one = rows.join(ids_hint(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(whole, F.struct(F.col("text"), F.to_json(whole))).alias("_row")).select("_row.*")
    return rows.join(ids_hint(again), "doc_id", "left_anti").select(*docs.columns).unionByName(one)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM m JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS x, b AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
c AS (SELECT x, min(y) AS least FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(least, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(least, w.doc_id)) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN c ON w.doc_id = c.x
"""

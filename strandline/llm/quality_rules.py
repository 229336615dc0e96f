"""Quality rules: exact base rules, and a hashed n-gram logistic regression trained on labelled rows.

Training takes a bounded sample of the labelled rows (MAX_TRAIN of each class,
chosen by a hash of doc_id), fits word 1- and 2-grams and byte 3- and 5-grams
hashed into 2**BITS cells by batch gradient descent, and calibrates the
probability on the held-out fifth of the sample. The fit is one task of an
executor, which reads whole texts piece by piece and holds 12 bytes for each
distinct n-gram cell of a text and kind, 3 MB a text at most; the driver gets the
weights. Scoring runs over Arrow batches; a document is kept if it passes the
base rules and its probability of good quality reaches MIN_PROBABILITY (a
probability equal to it is enough).

Edge cases: a null or empty text has no words and fails the base rules; labels
that are null, or of documents without text, aren't trained on; where a class
has no labelled row, only the base rules decide; an empty table gives no rows;
repeated rows are each scored; repeated labels count once, and a document with
both labels is trained on as both; of several texts with one labelled doc_id that
with the least hash is trained on; texts are read whole, whatever their length;
columns of any name stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import hashed_linear as hl
from strandline.llm import textbuf
from strandline.llm.store import fitted, free_name, frugal

#: Labelled rows that are trained on, of each class at most.
MAX_TRAIN = 700
BITS = 16
CHAR_WIDTHS = (3, 5)
WORD_WIDTHS = (1, 2)
#: Verdict and base thresholds.
MIN_PROBABILITY = 0.2
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def base_columns(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base measures of each text, and its words' hashes and offsets."""
    n = len(offs) - 1
    starts, ends, doc = textbuf.words(data, offs)
    to = textbuf.spread(doc, n)
    sums = textbuf.prefix(data)
    hashes = textbuf.segment_hash(sums, starts, ends)
    lead = (data & 0xC0) != 0x80
    word_chars = textbuf.per_doc(lead & ~textbuf.SPACE[data], offs)
    symbols = textbuf.per_doc(_SYMBOLS[data], offs)

    # lines with a word that equal an earlier line of the text
    line_s, line_e, line_doc = textbuf.runs(data != 0x0A, offs)
    words_before = np.searchsorted(starts, line_s, "left")
    real = np.searchsorted(starts, line_e, "left") > words_before
    line_s, line_e, line_doc = line_s[real], line_e[real], line_doc[real]
    dup_lines = np.bincount(line_doc, minlength=n) - _distinct(line_doc, textbuf.segment_hash(sums, line_s, line_e), n)
    for d in np.flatnonzero(dup_lines):  # lines with one hash are compared as bytes
        own = slice(*np.searchsorted(line_doc, [d, d + 1]))
        dup_lines[d] = own.stop - own.start - len({data[a:b].tobytes() for a, b in zip(line_s[own], line_e[own], strict=True)})

    # words in windows that are there twice or more
    h, h_doc = textbuf.window_hash(hashes, to, REPEAT_WINDOW)
    repeat = np.zeros(n, np.int64)
    if len(h):
        order = np.lexsort((h, h_doc))
        same = (h[order][1:] == h[order][:-1]) & (h_doc[order][1:] == h_doc[order][:-1])
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # windows are numbered without those that cross a text's end
        first_word = to[h_doc] + np.arange(len(h)) - np.searchsorted(h_doc, h_doc, "left")
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, first_word[twice], 1)
        np.add.at(cover, first_word[twice] + REPEAT_WINDOW, -1)
        repeat = textbuf.per_doc(np.cumsum(cover[:-1]) > 0, to)
    return {"n_words": np.diff(to), "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat, "_hashes": hashes, "_to": to}


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    if not len(h):
        return np.zeros(n, np.int64)
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    return np.bincount(doc[order][new], minlength=n)


def features(data: np.ndarray, offs: np.ndarray, hashes: np.ndarray, to: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cells, offsets) of each kind of n-gram."""
    for width in CHAR_WIDTHS:
        yield hl.char_cells(data, offs, width, BITS)
    for width in WORD_WIDTHS:
        yield hl.word_cells(hashes, to, width, BITS)


class Model:
    """A table of weights for each kind of n-gram, and the calibration."""

    def __init__(self, weights: np.ndarray, bias: float, scale: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.scale, self.shift = weights.astype(np.float32), bias, scale, shift

    def raw(self, data, offs, hashes, to) -> np.ndarray:
        score = np.full(len(offs) - 1, self.bias)
        for table, (cells, at) in zip(self.weights, features(data, offs, hashes, to), strict=True):
            score += hl.means(table[cells], at)
        return score

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -35, 35)))


def _cell_sums(cells: np.ndarray, at: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, cell, share of the text's n-grams) of each distinct cell of a text; texts are numbered from `first`."""
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    key, count = np.unique(doc << BITS | cells, return_counts=True)
    d = key >> BITS
    return (d + first).astype(np.int32), (key & ((1 << BITS) - 1)).astype(np.int32), (count / np.maximum(np.diff(at), 1)[d]).astype(np.float32)


def fit(batches: Iterator[pa.RecordBatch], epochs: int = 60, rate: float = 300.0, decay: float = 1e-6) -> Model | None:
    """Train on the batches' columns text and label; None if only one class is there. Each class weighs the same."""
    labels, sums = [], [[] for _ in (*CHAR_WIDTHS, *WORD_WIDTHS)]
    for piece in textbuf.pieces(batches, "text"):
        data, offs = textbuf.buffers(piece.column("text"))
        starts, ends, doc = textbuf.words(data, offs)
        hashes, to = textbuf.segment_hash(textbuf.prefix(data), starts, ends), textbuf.spread(doc, len(offs) - 1)
        for own, (cells, at) in zip(sums, features(data, offs, hashes, to), strict=True):
            own.append(_cell_sums(cells, at, len(labels)))
        labels += piece.column("label").to_pylist()
    labels, n = np.array(labels), len(labels)
    if len(set(labels.tolist())) < 2:
        return None
    grids = [tuple(np.concatenate(column) for column in zip(*own, strict=True)) for own in sums]
    del sums
    held = np.arange(n) % 5 == 4
    share = np.where(labels == 1, 0.5 / max(1, ((labels == 1) & ~held).sum()), 0.5 / max(1, ((labels == 0) & ~held).sum())) * ~held
    weights, bias = np.zeros((len(grids), 1 << BITS)), 0.0

    def raw() -> np.ndarray:
        score = np.full(n, bias)
        for w, grid in zip(weights, grids, strict=True):
            for d, c, v in _blocks(grid):
                score += np.bincount(d, w[c] * v, n)
        return score

    for _ in range(epochs):
        err = (1 / (1 + np.exp(-np.clip(raw(), -35, 35))) - labels) * share
        for w, grid in zip(weights, grids, strict=True):
            w *= 1 - rate * decay
            for d, c, v in _blocks(grid):
                w -= rate * np.bincount(c, err[d] * v, 1 << BITS)
        bias -= err.sum()
    model, scores = Model(weights, bias), raw()
    if len(set(labels[held].tolist())) == 2:
        model.scale, model.shift = hl.platt(scores[held], labels[held])
        model.scale = max(model.scale, 1e-3)
    return model


def _blocks(grid: tuple[np.ndarray, ...], size: int = 1 << 20) -> Iterator[tuple[np.ndarray, ...]]:
    """Slices of the grid, so that what is computed of it stays small."""
    for at in range(0, len(grid[0]), size):
        yield tuple(column[at : at + size] for column in grid)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model | None:
    """Fit on at most `max_train` labelled rows of each class, those with the least hash of their doc_id."""
    some = [
        labels.where(F.col("quality") == label).select("doc_id", F.lit(label).alias("label")).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
        for label in (0, 1)
    ]
    got = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(some[0].union(some[1])), "doc_id")
    one = got.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    # the order of the sample decides what is held out for the calibration
    return fitted(one.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id", "label"), fit)


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def assess(docs: DataFrame, model: Model | None, text: str = "text", out: str = "quality_report") -> DataFrame:
    """`docs` with a struct of the base measures, the calibrated probability (null without a model) and the verdicts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{', '.join(':'.join(c.split()) for c in SCHEMA.split(', '))}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            done = []
            for piece in textbuf.pieces([pa.record_batch([texts], ["t"])], "t"):
                data, offs = textbuf.buffers(piece.column(0))
                base = base_columns(data, offs)
                hashes, to = base.pop("_hashes"), base.pop("_to")
                n, repeat = base["n_words"], base["n_repeat_words"]
                failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
                if model is None:
                    p, kept = pa.nulls(len(n), pa.float64()), ~failed
                else:
                    p = model.probability(model.raw(data, offs, hashes, to))
                    kept, p = ~failed & (p >= MIN_PROBABILITY), pa.array(p)
                columns = {k: pa.array(v, pa.int64()) for k, v in base.items()} | {"base_failed": pa.array(failed), "kept": pa.array(kept), "probability": p}
                done.append(pa.StructArray.from_arrays(list(columns.values()), list(columns)))
            yield pa.concat_arrays(done) if done else pa.array([], pa.struct([]))

    return frugal(docs).withColumn(out, run(F.col(text)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and the measures of every document."""
    got = assess(docs.select("doc_id", "text"), train(docs, labels))
    return got.select("doc_id", "quality_report.*")


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with its columns."""
    name = free_name(docs.columns, "quality_report")
    return assess(docs, train(docs, labels), out=name).where(F.col(name)["kept"]).select(*docs.columns)

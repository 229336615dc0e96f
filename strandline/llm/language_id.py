"""Language identification: averaged hashed subword embeddings with a linear softmax.

Byte n-grams of the ASCII-lower-cased text are hashed to rows of an embedding
table; a text's vector is the mean of its n-grams' rows, and a linear softmax
over it gives the languages' probabilities. Both are trained by stochastic
gradient descent in numpy, by one task of an executor, on a bounded sample
(MAX_TRAIN rows of each language there is, chosen by a hash of doc_id). The
sample's texts are read whole, cut into at most PARTS parts. Temperature and the
rejection threshold are set on a held-out part of that sample: a prediction whose
calibrated probability is below the threshold that keeps ACCEPT of the right ones
is marked rejected.

For scoring, embedding times softmax is one table of a score per n-gram and
language, so each Arrow batch needs look-ups and means only.

Edge cases: a null or empty text, or one without a letter, is `und` with score
0; rows without lang aren't trained on; with one language all texts with a
letter are given it; without any, all are `und`; an empty table gives no rows;
repeated rows are each scored, and a repeated doc_id is one of the sample's rows;
of languages with equal probabilities the first by name is predicted; texts are
scored whole, whatever their length; columns other than doc_id, text and lang
aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import hashed_linear as hl
from strandline.llm import textbuf
from strandline.llm.store import fitted, frugal, ids_hint, stored

#: Rows of each language that are trained on, at most.
MAX_TRAIN = 300
WIDTHS = (2, 3, 4)
BITS = 14
DIMENSIONS = 16
#: A training text is cut into so many equal parts at most, of so many characters at least.
PARTS, PART = 6, 200
ACCEPT = 0.99
UNDETERMINED = "und"


def cells(data: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    data = textbuf.LOWER[data]
    return [hl.char_cells(data, offs, width, BITS) for width in WIDTHS]


class Model:
    def __init__(self, languages: list[str], tables: list[np.ndarray], bias: np.ndarray, temperature: float, threshold: float):
        """tables: for each n-gram width the (cells x languages) scores."""
        self.languages, self.tables, self.bias, self.temperature, self.threshold = languages, tables, bias, temperature, threshold

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        out = np.tile(self.bias, (len(offs) - 1, 1))
        for table, (c, at) in zip(self.tables, cells(data, offs), strict=True):
            out += hl.means(table[c], at)
        return out

    def probabilities(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        return _softmax(self.scores(data, offs) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _parts(text: str) -> list[str]:
    """The whole text in equal parts."""
    n = max(1, min(PARTS, len(text) // PART))
    return [text[len(text) * i // n : len(text) * (i + 1) // n] for i in range(n)]


def _counted(cells: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, share of its text's n-grams, offsets) of the distinct cells of each text."""
    doc = np.repeat(np.arange(len(to) - 1, dtype=np.int64), np.diff(to))
    key, count = np.unique(doc << BITS | cells, return_counts=True)
    d = key >> BITS
    return (key & ((1 << BITS) - 1)).astype(np.int32), (count / np.maximum(np.diff(to), 1)[d]).astype(np.float32), np.searchsorted(d, np.arange(len(to)), "left")


def fit(batches: Iterator[pa.RecordBatch], epochs: int = 6, rate: float = 20.0, batch: int = 32, seed: int = 7) -> Model | None:
    """Train on the batches' columns text and lang; None without any row."""
    owner, names, counted = [], [], [[] for _ in WIDTHS]
    for piece in textbuf.pieces(batches, "text"):
        parts = [_parts(t) for t in piece.column("text").to_pylist()]
        owner += [len(names) + i for i, own in enumerate(parts) for _ in own]
        names += piece.column("lang").to_pylist()
        for own, (c, to) in zip(counted, cells(*textbuf.buffers(pa.array([p for some in parts for p in some], pa.large_string()))), strict=True):
            own.append(_counted(c, to))
    languages = sorted(set(names))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    owner, k = np.array(owner), len(languages)
    y = np.searchsorted(languages, names)[owner]
    grids = []
    for own in counted:
        shift = np.cumsum([0] + [len(c) for c, _, _ in own[:-1]])
        grids.append((np.concatenate([c for c, _, _ in own]), np.concatenate([v for _, v, _ in own]), np.concatenate([[0], *(to[1:] + s for (_, _, to), s in zip(own, shift, strict=True))])))
    held = owner % 5 == 4
    embedding = [rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)) for _ in WIDTHS]
    linear, bias = rng.normal(0, 0.3, (DIMENSIONS, k)), np.zeros(k)
    share = 1 / np.maximum(np.bincount(y, minlength=k), 1)
    share *= len(y) / share[y].sum()

    def gather(rows: np.ndarray, grid: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, share, place in rows) of all cells of the rows."""
        c, v, to = grid
        n = to[rows + 1] - to[rows]
        at = np.repeat(to[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return c[at], v[at].astype(float), np.repeat(np.arange(len(rows)), n)

    order = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(order)
        for first in range(0, len(order), batch):
            rows = order[first : first + batch]
            hidden, used = np.zeros((len(rows), DIMENSIONS)), []
            for table, grid in zip(embedding, grids, strict=True):
                used.append(gather(rows, grid))
                c, v, doc = used[-1]
                full = np.flatnonzero(np.bincount(doc, minlength=len(rows)))
                if len(full):
                    hidden[full] += np.add.reduceat(table[c] * v[:, None], np.searchsorted(doc, full, "left"))
            err = _softmax(hidden @ linear + bias)
            err[np.arange(len(rows)), y[rows]] -= 1
            err *= share[y[rows]][:, None] / len(rows)
            back = err @ linear.T
            linear -= step * 0.1 * hidden.T @ err
            bias -= step * 0.1 * err.sum(axis=0)
            for table, (c, v, doc) in zip(embedding, used, strict=True):
                np.add.at(table, c, -step * back[doc] * v[:, None])
    model = Model(languages, [(t @ linear).astype(np.float32) for t in embedding], bias, 1.0, 0.0)
    rows = np.flatnonzero(held)
    if len(rows) and k > 1:
        truth, scores = y[rows], np.tile(bias, (len(rows), 1))
        for table, grid in zip(model.tables, grids, strict=True):
            c, v, doc = gather(rows, grid)
            for lang in range(k):
                scores[:, lang] += np.bincount(doc, table[c, lang] * v, len(rows))
        loss = {t: -np.log(_softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.05, 20, 60)}
        model.temperature = float(min(loss, key=loss.get))
        p = _softmax(scores / model.temperature)
        right = p.argmax(axis=1) == truth
        model.threshold = float(np.quantile(p.max(axis=1)[right], 1 - ACCEPT)) if right.any() else 0.0
    return model


def train(docs: DataFrame, eligible: Column, max_train: int = MAX_TRAIN) -> Model | None:
    """Fit on at most `max_train` rows of each language, of the rows that are eligible and have text and lang.

    A language's many rows are thinned out by a hash of doc_id to a few times the
    bound before they are ranked, so no language gathers its rows anywhere.
    """
    rows = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("_n")), "language-sizes")
    place = F.xxhash64("doc_id") / F.lit(float(1 << 64)) + 0.5
    near = rows.select("doc_id", "lang").join(ids_hint(sizes), "lang").where(place * F.col("_n") <= 8.0 * max_train).select("doc_id", "lang").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    some = stored(near.withColumn("_r", rank).where(F.col("_r") <= max_train).select("doc_id", "lang"), "language-sample")
    one = rows.join(ids_hint(some), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return fitted(one.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id", "lang"), fit)


def identify(docs: DataFrame, model: Model | None, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with a struct (lang, score, rejected) in the column `out`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
        for texts in batches:
            done = [pa.array([], kind)]
            for piece in textbuf.pieces([pa.record_batch([texts], ["t"])], "t"):
                data, offs = textbuf.buffers(piece.column(0))
                lower = textbuf.LOWER[data]
                letters = textbuf.per_doc((lower >= 97) & (lower <= 122), offs) > 0
                for i in np.flatnonzero(~letters):
                    letters[i] = any(map(str.isalpha, piece.column(0)[i].as_py() or ""))
                if model is None:
                    letters[:] = False
                    best, score = np.zeros(len(letters), int), np.zeros(len(letters))
                else:
                    p = model.probabilities(data, offs)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                names = [*(model.languages if model else []), UNDETERMINED]
                lang = np.where(letters, best, len(names) - 1)
                score = np.where(letters, score, 0.0)
                rejected = ~letters | (score < (model.threshold if model else 0))
                done.append(pa.StructArray.from_arrays([pa.array(names).take(pa.array(lang)), pa.array(score), pa.array(rejected)], fields=list(kind)))
            yield pa.concat_arrays(done)

    return frugal(docs).withColumn(out, run(F.col(text)))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected; learned from the documents that aren't held out."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = identify(docs.select("doc_id", "text"), train(docs, ~F.coalesce(held, F.lit(True))))
    return got.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected")

"""SentencePiece encoding and decoding with a unigram lattice over a fixed piece table.

An Aho-Corasick automaton over the pieces is run once over the text. At each
position its output links give every piece that ends there, and each of them
relaxes the best score at that position (Viterbi in one pass). Ties go to the
longest last piece. No piece of the table has the word mark after another
character (nor a line feed), so no piece crosses the start of a word or line and
the lattice splits there exactly; a bounded table keeps the results of units
that were seen before.

The piece table is read from a model file once, by the driver, and sent to the
executors (its size is checked). Characters without a piece become byte pieces.

Edge cases: null text gives null ids and null ids give null text; an empty text
gives no ids and the other way round; texts of any length are handled whole.
Encoding follows the model's own normaliser settings (identity, a word mark in
front, no white space removed), so decoding gives the text back exactly; only a
word mark that is in the text itself comes back as a space.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textbuf
from strandline.llm.store import frugal, free_name

MARK = "▁"
_LOW = float("-inf")
#: A model file of more bytes than this isn't sent to the executors.
MAX_MODEL_BYTES = 64 << 20
#: Words whose pieces a worker keeps.
CACHE_WORDS = 100_000
#: A character without a piece scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0


class PieceTable:
    """Pieces, scores and ids of a SentencePiece model file, as plain values that can be sent to workers."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_fallback: bool, dummy_prefix: bool):
        """pieces: (piece, score, kind) by id; kind 1 is an ordinary piece, 6 a byte."""
        for piece, _, kind in pieces:
            if kind == 1 and MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} goes on into a next word")
        self.pieces, self.byte_fallback, self.dummy_prefix = pieces, byte_fallback, dummy_prefix

    @classmethod
    def load(cls, path: str) -> PieceTable:
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as file:
            raw = file.read(MAX_MODEL_BYTES + 1)
        if len(raw) > MAX_MODEL_BYTES:
            raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
        model = pb.ModelProto()
        model.ParseFromString(raw)
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are handled")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], model.trainer_spec.byte_fallback, norm.add_dummy_prefix)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, table: PieceTable):
        self.automaton = ahocorasick.Automaton()
        self.bytes_id, self.unknown, self.prefix = {}, 0, table.dummy_prefix
        surface, worst = [], 0.0
        for i, (piece, score, kind) in enumerate(table.pieces):
            out = b""
            if kind == 1:
                self.automaton.add_word(piece, (len(piece), score, i))
                worst = min(worst, score)
                out = piece.replace(MARK, " ").encode()
            elif kind == 6:
                self.bytes_id[int(piece[1:-1], 16)] = i
                out = bytes([int(piece[1:-1], 16)])
            elif kind == 2:
                self.unknown, out = i, " ⁇ ".encode()
            surface.append(out)
        self.automaton.make_automaton()
        self.surface, self.unknown_score = surface, worst - UNKNOWN_PENALTY
        self.sizes = np.array([len(s) for s in surface])
        self.places, self.bytes = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(surface), np.uint8)
        ordinary = [p for p, _, kind in table.pieces if kind == 1]
        self.singles = frozenset(p for p in ordinary if len(p) == 1)
        # no piece goes on into a next word, nor over a line feed unless one has it: the lattice splits there exactly
        line = "" if any("\n" in p for p in ordinary) else "\n"
        self.units = re.compile(f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + ("|\n" if line else "")).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fallback = table.byte_fallback

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text in which spaces are word marks."""
        n = len(text)
        best, back = [0.0] + [_LOW] * n, [None] * (n + 1)
        if self.singles.issuperset(text):
            for end, (size, score, piece) in self.automaton.iter(text):
                start = end + 1 - size
                total = best[start] + score
                if total > best[end + 1]:
                    best[end + 1], back[end + 1] = total, (start, piece)
        else:
            # a character without a piece of its own is also reached as an unknown one, once its start has its best score
            done, singles, unknown = 0, self.singles, self.unknown_score

            def close(upto: int) -> None:
                for p in range(done + 1, upto + 1):
                    if text[p - 1] not in singles and best[p - 1] + unknown > best[p]:
                        best[p], back[p] = best[p - 1] + unknown, (p - 1, -1)

            for end, (size, score, piece) in self.automaton.iter(text):
                if end > done:
                    close(end)
                    done = end
                start = end + 1 - size
                total = best[start] + score
                if total > best[end + 1]:
                    best[end + 1], back[end + 1] = total, (start, piece)
            close(n)
        out, at = [], n
        while at:
            start, piece = back[at]
            if piece >= 0:
                out.append(piece)
            elif self.fallback:
                out.extend(self.bytes_id[b] for b in reversed(text[start:at].encode()))
            else:
                out.append(self.unknown)
            at = start
        return out[::-1]

    def encode_unit(self, unit: str) -> bytes:
        """Packed ids of a unit; the last CACHE_WORDS to twice as many units are kept."""
        got = self.known.get(unit)
        if got is None:
            got = self.older.get(unit)
            if got is None:
                got = np.array(self.viterbi(unit), "<i4").tobytes()
            if len(self.known) >= CACHE_WORDS:
                self.older, self.known = self.known, {}
            self.known[unit] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit values."""
        if not text:
            return b""
        text = text.replace(" ", MARK)
        units = self.units(MARK + text if self.prefix else text)
        got = list(map(self.known.get, units))
        if None in got:
            got = [self.encode_unit(u) if g is None else g for u, g in zip(units, got, strict=True)]
        return b"".join(got)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The id lists of all texts."""
        got = [None if t is None else self.encode(t) for t in texts.to_pylist()]
        offsets = np.zeros(len(got) + 1, np.int32)
        np.cumsum([len(g or b"") // 4 for g in got], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(g or b"" for g in got), "<i4"))
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([g is None for g in got], pa.bool_()))

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.surface[i] for i in ids])
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def decode_all(self, arrays: pa.ListArray) -> pa.Array:
        """The texts of all id lists; bytes are gathered for the whole batch, or by row where they aren't UTF-8."""
        flat = arrays.flatten()
        ids, offsets = np.asarray(flat), np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(arrays), 0)))])
        size = self.sizes[ids]
        at = np.repeat(self.places[ids] - np.cumsum(size) + size, size) + np.arange(size.sum())
        raw = self.bytes[at]
        ends = np.concatenate([[0], np.cumsum(size)])[offsets]
        if self.prefix:
            full = np.flatnonzero(np.diff(ends))
            first = ends[full][raw[ends[full]] == 0x20]
            raw = np.delete(raw, first)
            ends = ends - np.searchsorted(first, ends, "left")
        valid = np.asarray(arrays.is_valid())
        packed = pa.py_buffer(raw)
        try:
            str(packed.to_pybytes(), "utf-8")
        except UnicodeDecodeError:
            return pa.array([None if a is None else self.decode(a) for a in arrays.to_pylist()], pa.string())
        mask = None if valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little"))
        return pa.Array.from_buffers(pa.large_string(), len(valid), [mask, pa.py_buffer(ends.astype(np.int64)), packed]).cast(pa.string())


_codecs: dict[str, Codec] = {}


def _codec(digest: str, shared) -> Codec:
    """The codec of a worker for the model with this digest; a worker holds the last one only, until its task ends."""
    if digest not in _codecs:
        _codecs.clear()
        _codecs[digest] = Codec(shared.value)
    return _codecs[digest]


def _released() -> None:
    """Drop the codec at the end of a task: idle workers would keep its automaton and words beside later operators."""
    _codecs.clear()
    textbuf.given_back()


def _digest(table: PieceTable) -> str:
    return hashlib.sha256(repr(table.pieces).encode()).hexdigest()


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the piece ids of `text` in the column `out` (array of int)."""
    spark = frugal(docs).sparkSession
    table = PieceTable.load(model_path)
    digest, shared = _digest(table), spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(digest, shared)
        for texts in batches:
            yield codec.encode_all(texts)
        del codec
        _released()

    return docs.withColumn(out, run(F.col(text)))


def decode(docs: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the text of the piece ids in the column `out`."""
    spark = frugal(docs).sparkSession
    table = PieceTable.load(model_path)
    digest, shared = _digest(table), spark.sparkContext.broadcast(table)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(digest, shared)
        for arrays in batches:
            yield codec.decode_all(arrays)
        del codec
        _released()

    return docs.withColumn(out, run(F.col(ids)))


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the piece ids of `text` and the text that these ids decode to: one function, so that a task needs one worker, not two."""
    spark = frugal(docs).sparkSession
    table = PieceTable.load(model_path)
    digest, shared = _digest(table), spark.sparkContext.broadcast(table)

    @F.arrow_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(digest, shared)
        for texts in batches:
            arrays = codec.encode_all(texts)
            yield pa.StructArray.from_arrays([arrays, codec.decode_all(arrays)], ["ids", "decoded"])
        del codec
        _released()

    both = free_name([*docs.columns, ids, out], "_pieces")
    return docs.withColumn(both, run(F.col(text))).withColumns({ids: F.col(both)["ids"], out: F.col(both)["decoded"]}).drop(both)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the ids in decimal, comma-joined), n_bytes_decoded and exact (the decoded text equals the text)."""
    both = encode_decode(docs.select("doc_id", "text"), model_path)
    return both.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<int>")).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.coalesce(F.octet_length("decoded"), F.lit(0)).cast("long").alias("n_bytes_decoded"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


def default_model() -> str:
    """The public 32k piece table's path; any other is a parameter."""
    import os

    return os.environ.get("STRANDLINE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

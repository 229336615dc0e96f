"""Secret scans over a stored trigram inverted index.

One pass over the documents writes the index: a table with a row per segment of
about SEGMENT_BYTES of text, which holds the segment's documents and, for every
trigram of bytes (ASCII lower-cased) that any of them has, the sorted numbers of
the documents with it, as differences. All trigrams are indexed, so one index
serves any set of rules, also later ones. From each rule's regular expression a
Boolean trigram query is derived; its AND and OR nodes intersect and unite the
posting lists, and only the candidates that are left are verified with the
expression itself. A rule whose expression forces no trigram (such as a run of
hex digits) scans every document.

A segment has its own dictionary, lists and documents, so a search reads each row
once, nothing is shuffled, no list grows with the corpus, and a lost task only
redoes its own segments.

Edge cases: a null text is an empty one and has no spans; texts are scanned
whole, whatever their length; matches of one kind that begin at the same place
are one; matches of several kinds there go by the rules' order; repeated rows are
each scanned; an empty table gives an empty index and no rows; other columns are
carried along as they are, whatever their names.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from strandline.llm import textbuf
from strandline.llm.store import free_name, frugal, stored

_parser, _const = re._parser, re._constants

#: Bytes of text in a segment of the index, about; a longer text is one of its own.
SEGMENT_BYTES = 1 << 20
#: Strings of an exactly known set, beyond which only the trigrams they force are kept.
MAX_EXACT = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. The match counts if `group` has at least `least` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    ignore_case: bool = False
    base: bool = True

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: The base kinds, in their order, then further well-known token shapes.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, base=False),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, base=False),
)

# A query is True (no trigram is forced), a trigram (three bytes), or ("and" | "or", frozenset of queries).
ANY = True


def _both(parts: Iterable) -> object:
    flat = set()
    for p in parts:
        flat |= p[1] if isinstance(p, tuple) and p[0] == "and" else {p}
    flat.discard(ANY)
    return ANY if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def _either(parts: Iterable) -> object:
    flat = set()
    for p in parts:
        flat |= p[1] if isinstance(p, tuple) and p[0] == "or" else {p}
    return ANY if ANY in flat or not flat else next(iter(flat)) if len(flat) == 1 else ("or", frozenset(flat))


def _forced(strings: Iterable[str]) -> object:
    return _either(_both(s[i : i + 3] for i in range(len(s) - 2)) for s in (x.encode() for x in strings))


def _joined(exact: list[tuple[set[str] | None, object]]) -> tuple[set[str] | None, object]:
    """The set (if known) and the query of a sequence of parts: neighbouring known sets are multiplied out."""
    queries, run, whole = [], {""}, True
    for strings, query in exact:
        if strings is not None and len(run) * len(strings) <= MAX_EXACT:
            run = {a + b for a in run for b in strings}
            continue
        queries += [_forced(run), query]
        whole = False
        run = strings if strings is not None else {""}
    queries.append(_forced(run))
    return (run if whole else None), _both(queries)


def _analyse(tree) -> tuple[set[str] | None, object]:
    """For a parsed expression: the strings it can match if few, and the trigrams that every match has."""
    parts = []
    for op, arg in tree:
        if op is _const.LITERAL:
            parts.append(({chr(arg).lower() if arg < 128 else chr(arg)}, ANY))
        elif op is _const.IN:
            chars, small = set(), True
            for kind, value in arg:
                if kind is _const.LITERAL:
                    chars.add(chr(value))
                elif kind is _const.RANGE and value[1] - value[0] < 16:
                    chars |= {chr(c) for c in range(value[0], value[1] + 1)}
                else:
                    small = False
            chars = {c.lower() if c.isascii() else c for c in chars}
            parts.append((chars, ANY) if small and len(chars) <= 8 else (None, ANY))
        elif op is _const.SUBPATTERN:
            parts.append(_analyse(arg[-1]))
        elif op is _const.BRANCH:
            branches = [_analyse(b) for b in arg[1]]
            known = [s for s, _ in branches]
            union = set().union(*known) if all(s is not None for s in known) else None
            parts.append((union if union is not None and len(union) <= MAX_EXACT else None, _either(_both([_forced(s), q]) if s is not None else q for s, q in branches)))
        elif op in (_const.MAX_REPEAT, _const.MIN_REPEAT):
            low, high, inner = arg
            strings, query = _analyse(inner)
            if low == 0:
                parts.append(({"", *strings} if high == 1 and strings is not None else None, ANY))
            elif low == high and strings is not None:
                parts += [(strings, query)] * low
            else:
                parts += [(strings, query)] * min(low, 3) + [(None, ANY)]
        elif op is _const.AT:
            continue
        else:
            parts.append((None, ANY))
    return _joined(parts)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regular expression: True, a trigram, or ("and" | "or", queries)."""
    strings, query = _analyse(_parser.parse(pattern))
    return _both([_forced(strings), query]) if strings is not None else query


class Postings:
    """A segment's part of the index: the sorted trigrams, and for each the sorted numbers of the documents that have it."""

    def __init__(self, grams: np.ndarray, bounds: np.ndarray, steps: np.ndarray):
        """grams: numbers of the trigrams; bounds: of their lists in steps, which are differences."""
        self.grams, self.bounds, self.steps = grams, bounds, steps

    @classmethod
    def of(cls, data: np.ndarray, offs: np.ndarray) -> Postings:
        low = textbuf.LOWER[data].astype(np.uint64)
        doc = np.repeat(np.arange(len(offs) - 1, dtype=np.uint64), np.diff(offs))
        key = (low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]) << np.uint64(32) | doc[2:]
        key = np.sort(key[doc[:-2] == doc[2:]])
        key = key[np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))] if len(key) else key
        gram, number = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(key) else np.zeros(0, np.int64)
        steps = np.diff(number, prepend=0)
        steps[first] = number[first]
        return cls(gram[first], np.append(first, len(key)), steps)

    def pack(self) -> tuple[bytes, bytes, bytes]:
        press = zstandard.ZstdCompressor(level=3).compress
        return press(np.diff(self.grams, prepend=0).astype("<u4").tobytes()), press(np.diff(self.bounds).astype("<u4").tobytes()), press(self.steps.astype("<u4").tobytes())

    @classmethod
    def unpack(cls, grams: bytes, counts: bytes, steps: bytes) -> Postings:
        plain = lambda x: np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u4").astype(np.int64)
        return cls(np.cumsum(plain(grams)), np.concatenate([[0], np.cumsum(plain(counts))]), plain(steps))

    def list(self, trigram: bytes) -> np.ndarray:
        code = int.from_bytes(trigram, "big")
        at = int(np.searchsorted(self.grams, code))
        if at == len(self.grams) or self.grams[at] != code:
            return np.zeros(0, np.int64)
        return np.cumsum(self.steps[self.bounds[at] : self.bounds[at + 1]])


def candidates(query: object, index: Postings, n: int) -> np.ndarray:
    """Numbers of the texts that satisfy the query, by intersecting (rarest first) and uniting posting lists."""
    if query is ANY:
        return np.arange(n)
    if isinstance(query, bytes):
        return index.list(query)
    lists = sorted((candidates(q, index, n) for q in query[1]), key=len)
    if query[0] == "or":
        return reduce(np.union1d, lists)
    return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True) if len(a) else a, lists)


@cache
def _plans(rules: tuple[Rule, ...]) -> list[tuple]:
    return [(k, r, r.compiled(), trigram_query(r.pattern)) for k, r in enumerate(rules)]


def find(texts: list[str], rules: tuple[Rule, ...] = RULES, index: Postings | None = None) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each text's secrets by start, then the rules' order; positions are code points."""
    index = index or Postings.of(*textbuf.buffers(pa.array(texts, pa.large_string())))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, rule, regex, query in _plans(rules):
        for i in candidates(query, index, len(texts)):
            found[i] += [(m.start(), k, m.end()) for m in regex.finditer(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
    return [[(rules[k].kind, s, e) for s, k, e in sorted(f)] for f in found]


@dataclass(frozen=True)
class Index:
    """The stored segments of `docs`, by the trigrams of its column `text`."""

    segments: DataFrame
    schema: StructType
    text: str


_SEGMENT = "segment string, n int, docs binary, grams binary, counts binary, steps binary"


def index(docs: DataFrame, text: str = "text") -> Index:
    """One pass over `docs` that writes the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textbuf.pieces(batches, text, SEGMENT_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
                w.write_batch(piece)
            packed = Postings.of(*textbuf.buffers(piece.column(text))).pack()
            row = (uuid.uuid4().hex, piece.num_rows, sink.getvalue().to_pybytes(), *packed)
            yield pa.record_batch([pa.array([row[0]]), pa.array([row[1]], pa.int32()), *(pa.array([x], pa.binary()) for x in row[2:])], ["segment", "n", "docs", "grams", "counts", "steps"])

    return Index(stored(frugal(docs).mapInArrow(run, _SEGMENT), "secret-index"), docs.schema, text)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def search(index: Index, rules: tuple[Rule, ...] = RULES, out: str = "secrets") -> DataFrame:
    """The indexed documents with the spans of their secrets in the column `out`: array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    text = index.text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, *lists in zip(*(batch.column(c).to_pylist() for c in ("docs", "grams", "counts", "steps")), strict=True):
                table = pa.ipc.open_stream(io.BytesIO(docs)).read_all()
                found = find([t or "" for t in table.column(text).to_pylist()], rules, Postings.unpack(*lists))
                spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found], kind)
                yield from table.append_column(out, spans).combine_chunks().to_batches(max_chunksize=500)

    schema = StructType([*index.schema.fields, StructField(out, _parse_datatype_string(SPANS))])
    return index.segments.select("docs", "grams", "counts", "steps").mapInArrow(run, schema)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", out: str = "secrets") -> DataFrame:
    """`docs` with the spans of its secrets in the column `out`, by an index that is written for it."""
    return search(index(docs, text), rules, out)


def joined(spans) -> object:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    base = [r.kind for r in RULES if r.base]
    found = scan(docs.select("doc_id", "text"))
    of = lambda *kinds: F.filter("secrets", lambda x: x["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """`docs` with each secret in `text` replaced by `mark` (overlapping spans by one); all rows and columns stay, and a null text stays null.

    A document without secrets isn't changed. `n_chars`, if there, is the new length.
    """
    name = free_name(docs.columns, "secrets")
    found = scan(docs, text=text, out=name)
    merged = F.aggregate(
        F.col(name),
        F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] < F.element_at(acc, -1)["e"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["end"]).alias("e"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("s"), x["end"].alias("e"))))),
    )
    cut = F.aggregate(
        merged,
        F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc["t"], F.substring(F.col(text), acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark)).alias("t"), x["e"].alias("at")),
        lambda acc: F.concat(acc["t"], F.substring(F.col(text), acc["at"] + 1, F.char_length(F.col(text)))),
    )
    out = found.withColumn(text, F.when(F.size(name) > 0, cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(name) > 0, F.char_length(text).cast("long")).otherwise(F.col("n_chars")))
    return out.drop(name)


def _oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of report(): a match's place is the summed length of what splits and matches before it."""
    parts = []
    for k, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        if r.ignore_case:  # (?i) would also fold letters beyond ASCII
            words, rest = re.match(r"(\([^)]*\))(.*)", pattern, re.S).groups()
            pattern = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words) + rest
        parts.append(
            f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.base} AS base, p0 AS s, p0 + length(m) AS e FROM ("
            f"SELECT doc_id, m, length(regexp_extract(m, '{pattern}', {r.group})) AS size, CAST(list_sum([length(x) FOR x IN parts[1:i]]) + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS BIGINT) AS p0 "
            f"FROM (SELECT doc_id, parts, found, unnest(found) AS m, unnest(range(1, len(found) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS parts, regexp_extract_all(t, '{pattern}') AS found FROM d))) WHERE size >= {r.least}"
        )
    join = "coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k){}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules if r.base)
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (" + " UNION ALL ".join(parts) + ") "
        f"SELECT doc_id, {counts}, sha256({join.format(' FILTER (base)')}) AS base_sha256, {join.format(' FILTER (kind IS NOT NULL)')} AS spans FROM d LEFT JOIN m USING (doc_id) GROUP BY doc_id"
    )


ORACLE = _oracle()

"""Batch data sources for SAM, FASTA, FASTQ and RepeatMasker text, plain or gzip.

Paths are opened through pyarrow's file systems, so local paths and URIs that it
knows both work. A plain file is read in byte ranges of `splitBytes` (an option),
each snapped to where a record begins; gzip files and FASTQ, whose quality lines
may look like headers, are read whole, one file a task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThan

from strandline import schemas

SPLIT_BYTES = 64 << 20
BLOCK = 1 << 20


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int
    whole: bool


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (fs.LocalFileSystem(), path)


def _files(path: str, suffixes: tuple[str, ...]) -> list[fs.FileInfo]:
    files, at = _open(path)
    info = files.get_file_info(at)
    if info.type == fs.FileType.Directory:
        found = files.get_file_info(fs.FileSelector(at, recursive=True))
        return sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(suffixes)), key=lambda f: f.path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    return [info]


def _blocks(part: Part, root: str) -> Iterator[bytes]:
    """The bytes of a range, and on to the end of the file for the reader to finish its last record."""
    files, _ = _open(root)
    with files.open_input_file(part.path) as source:
        source.seek(part.start)
        unzip = zlib.decompressobj(31) if part.path.endswith(".gz") else None
        while block := source.read(BLOCK):
            while unzip:
                yield unzip.decompress(block)
                if not unzip.unused_data:  # block gzip is many members in a row
                    break
                block, unzip = unzip.unused_data, zlib.decompressobj(31)
            if not unzip:
                yield block


def _lines(part: Part, root: str) -> Iterator[tuple[int, str]]:
    """(offset, line) from the range's start; a first line that began before it is left out."""
    at, rest, skip = part.start, b"", part.start > 0
    if skip:
        part = Part(part.path, part.start - 1, part.end, part.whole)
        at -= 1
    for block in _blocks(part, root):
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            if skip:
                skip = False
            else:
                yield at, line.rstrip(b"\r").decode()
            at += len(line) + 1
    if rest and not skip:
        yield at, rest.rstrip(b"\r").decode()


class _Reader(DataSourceReader):
    suffixes: tuple[str, ...] = ("",)
    splittable = True

    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.options = options

    def partitions(self) -> list[Part]:
        out = []
        for f in _files(self.path, self.suffixes):
            if f.path.endswith(".gz") or not self.splittable:
                out.append(Part(f.path, 0, 1 << 62, True))
            else:
                out += [Part(f.path, s, min(s + self.split, f.size), False) for s in range(0, f.size, self.split)]
        return out or [Part("", 0, 0, True)]

    def read(self, part: Part) -> Iterator[tuple]:
        if part.path:
            yield from self.records(part)

    def lines(self, part: Part) -> Iterator[str]:
        for at, line in _lines(part, self.path):
            if at >= part.end:
                return
            yield line

    def records(self, part: Part) -> Iterator[tuple]:
        raise NotImplementedError


class SamReader(_Reader):
    suffixes = (".sam", ".sam.gz")

    def __init__(self, options: dict):
        super().__init__(options)
        self.chrom, self.low, self.high = None, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality on chrom and half-open ranges of pos, so that other records aren't parsed."""
        for f in filters:
            match f:
                case EqualTo(("chrom",), value):
                    self.chrom = value
                case GreaterThanOrEqual(("pos",), value):
                    self.low = value if self.low is None else max(self.low, value)
                case LessThan(("pos",), value):
                    self.high = value if self.high is None else min(self.high, value)
                case _:
                    yield f

    def records(self, part: Part) -> Iterator[tuple]:
        for line in self.lines(part):
            if not line or line[0] == "@":
                continue
            name, flag, chrom, pos, rest = line.split("\t", 4)
            at = int(pos) - 1
            if self.chrom is not None and chrom != self.chrom or self.low is not None and at < self.low or self.high is not None and at >= self.high:
                continue
            mapq, cigar, next_chrom, next_pos, tlen, seq, qual, *tags = rest.split("\t")
            ops = [(op, int(n)) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
            mate = chrom if next_chrom == "=" else next_chrom
            pairs = dict((t[:2], t.split(":", 2)[2]) for t in tags)
            yield name, int(flag), None if chrom == "*" else chrom, at, int(mapq), ops, None if mate == "*" else mate, int(next_pos) - 1 if mate != "*" else None, int(tlen), seq, qual, pairs


class FastaReader(_Reader):
    suffixes = (".fa", ".fasta", ".fa.gz", ".fasta.gz")

    def records(self, part: Part) -> Iterator[tuple]:
        name, parts = None, []
        for at, line in _lines(part, self.path):
            if line.startswith(">"):
                if name is not None:
                    yield self.row(name, parts)
                if at >= part.end:
                    return
                name, parts = (line[1:].split() or [""])[0], []
            elif name is not None:
                parts.append(line.strip())
            elif at >= part.end:
                return
        if name is not None:
            yield self.row(name, parts)

    @staticmethod
    def row(name: str, parts: list[str]) -> tuple:
        seq = "".join(parts)
        return name, seq, len(seq)


class FaiReader(_Reader):
    """The index of FASTA files: name, length, offset of the first base, bases and bytes of a line."""

    suffixes = (".fa", ".fasta")
    splittable = False

    def records(self, part: Part) -> Iterator[tuple]:
        files, _ = _open(self.path)
        name, size, first, bases, width, short, at = None, 0, 0, 0, 0, False, 0
        with files.open_input_stream(part.path) as source:
            rest = b""
            while (block := source.read(BLOCK)) or rest:
                *whole, rest = (rest + block).split(b"\n") if block else (rest, b"")
                for line in whole:
                    n, here = len(line.rstrip(b"\r")), at
                    at += len(line) + 1
                    if line.startswith(b">"):
                        if name is not None:
                            yield name, size, first, bases, width
                        name, size, first, bases, width, short = (line[1:].decode().split() or [""])[0], 0, at, 0, 0, False
                    elif name is not None:
                        if n and (short or bases and n > bases):
                            raise ValueError(f"{part.path}: lines of {name} differ in length at byte {here}")
                        if not bases:
                            bases, width = n, len(line) + 1
                        short = n < bases
                        size += n
        if name is not None:
            yield name, size, first, bases, width


class FastqReader(_Reader):
    suffixes = (".fq", ".fastq", ".fq.gz", ".fastq.gz")
    splittable = False

    def records(self, part: Part) -> Iterator[tuple]:
        lines = self.lines(part)
        for line in lines:
            if not line.startswith("@"):
                if line:
                    raise ValueError(f"{part.path}: a record must begin with @")
                continue
            name, seq, qual = (line[1:].split() or [""])[0], "", ""
            for line in lines:
                if line.startswith("+"):
                    break
                seq += line.strip()
            while len(qual) < len(seq):  # a quality line may begin with @, so only lengths tell the end
                more = next(lines, None)
                if more is None:
                    raise ValueError(f"{part.path}: the record {name} is cut short")
                qual += more
            yield name, seq, qual


class RmskReader(_Reader):
    suffixes = (".out", ".out.gz")

    def records(self, part: Part) -> Iterator[tuple]:
        extend, only = int(self.options.get("extend", 0)), self.options.get("classFilter")
        number = lambda s: int(s.strip("()"))
        for at, line in _lines(part, self.path):
            if at >= part.end:
                return
            f = line.split()
            if len(f) < 15 or f[0] in ("SW", "score") or only and f[10] != only:
                continue
            reverse = f[8] == "C"
            low, high = (f[13], f[12]) if reverse else (f[11], f[12])
            yield f[4], int(f[5]) - extend, int(f[6]) + extend, reverse, f[9], float(f[1]), f[10], number(low), number(high), at


class _Source(DataSource):
    reader_type: type[_Reader]
    ddl: str
    title: str

    @classmethod
    def name(cls) -> str:
        return cls.title

    def schema(self) -> str:
        return self.ddl

    def reader(self, schema) -> DataSourceReader:
        return self.reader_type(self.options)


class SamSource(_Source):
    reader_type, ddl, title = SamReader, schemas.ALIGNMENT, "sam"


class FastaSource(_Source):
    reader_type, ddl, title = FastaReader, schemas.FASTA, "fasta"


class FaiSource(_Source):
    reader_type, ddl, title = FaiReader, schemas.FAI, "fai"


class FastqSource(_Source):
    reader_type, ddl, title = FastqReader, schemas.FASTQ, "fastq"


class RmskSource(_Source):
    reader_type, ddl, title = RmskReader, schemas.RMSK, "rmsk"


def read_range(path: str, start: int, length: int) -> bytes:
    """Bytes of a plain file from an offset on."""
    files, at = _open(path)
    with files.open_input_file(at) as source:
        source.seek(start)
        return source.read(length)

"""FASTQ files as a data source that needs no shuffle: ranges that begin at a record, and mates zipped by counted records.

One pass counts the records of each range and notes some places between them. The
reader then gives each range's records their numbers and, for mates, opens the
other file at the nearest place noted before the range's first record.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readloom.sources import bgzf
from readloom.sources.inflated import Inflated
from readloom.sources.storage import files_of, located

READS = "file string, file_no int, rec_idx long, name string, seq string, qual string"
PAIRS = "file_no int, rec_idx long, name_f string, seq_f string, qual_f string, name_r string, seq_r string, qual_r string"
COUNTS = "file_no int, start long, first long, last long, records long, marks array<struct<records:long,place:long>>"
#: Bytes of a range, places noted in it besides its start, records of a batch, bytes read at once, and records that must follow one another where a search finds one.
RANGE, MARKS, BATCH, PIECE, CHAIN = 64 << 20, 8, 10_000, 1 << 20, 2
#: Kinds of files: plain text, blocked gzip, and gzip that only reads from its start.
PLAIN, BLOCKED, WHOLE = "plain", "blocked", "whole"


class Plain:
    """The bytes of a file from a place on, as bgzf.Stream has them inflated."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.base, self.held, self.used = file, size, at, bytearray(), 0

    def more(self) -> bool:
        at = self.base + len(self.held)
        got = self.file.read_at(min(PIECE, self.size - at), at) if at < self.size else b""
        self.held += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.used += n
        if self.used > PIECE:
            del self.held[: self.used]
            self.base, self.used = self.base + self.used, 0

    def place(self) -> int:
        return self.base + self.used


def line_end(stream, off: int) -> int | None:
    """Where the line that starts ``off`` bytes on ends; None at the file's end."""
    at = off
    while (found := stream.held.find(b"\n", stream.used + at)) < 0:
        at = len(stream.held) - stream.used
        if not stream.more():
            return None
    return found - stream.used


def next_line(stream, off: int, n: int = 1) -> int | None:
    for _ in range(n):
        end = line_end(stream, off)
        if end is None:
            return None
        off = end + 1
    return off


def record_length(stream, off: int) -> int | None:
    """Bytes of the record that starts there: a name, bases, a plus sign, as many qualities as bases. None if none does, 0 if the file ends within it."""
    at, ends = off, []
    for _ in range(4):
        end = line_end(stream, at)
        if end is None:
            end = len(stream.held) - stream.used
            if len(ends) < 3 or at >= end:
                return 0
        ends.append(end)
        at = end + 1
    line = lambda a, b: bytes(stream.held[stream.used + a : stream.used + b]).rstrip(b"\r")
    signs = line(off, ends[0])[:1] + line(ends[1] + 1, ends[2])[:1]
    same = len(line(ends[0] + 1, ends[1])) == len(line(ends[2] + 1, ends[3]))
    return at - off if signs == b"@+" and same else None


def end_of(size: int, kind: str) -> int:
    return size << 16 if kind == BLOCKED else size


def first_record(file, size: int, kind: str, start: int) -> int:
    """Place of the first record behind the first line's end at or behind ``start``; at 0 that of the file, without one the file's end."""
    if start == 0:
        return 0
    if start >= size:
        return end_of(size, kind)
    stream = bgzf.Stream(file, size, bgzf.first_block(file, size, start)) if kind == BLOCKED else Plain(file, size, start - 1)
    off = next_line(stream, 0)
    while off is not None:
        at, chain = off, 0
        while chain < CHAIN and (told := record_length(stream, at)):
            at, chain = at + told, chain + 1
        if chain == CHAIN or chain and told == 0:
            stream.skip(off)
            return stream.place()
        off = next_line(stream, off)
    return end_of(size, kind)


def next_border(raw: bytes, lines: int, within: bool) -> int | None:
    """Where in ``raw`` the next record starts, behind ``lines`` lines of its range; ``within`` a line or at its start."""
    off = 0
    while lines % 4 or within:
        found = raw.find(b"\n", off)
        if found < 0:
            return None
        lines, off, within = lines + 1, found + 1, False
    return off if off < len(raw) else None


def pieces(file, size: int, kind: str, first: int, last: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of what lies between two places, about PIECE at a time; up to the file's end without ``last``."""
    if kind == PLAIN:
        end = size if last is None else last
        while first < end:
            raw = file.read_at(min(PIECE, end - first), first)
            if not raw:
                raise ValueError("the file is shorter than it was")
            yield first, raw
            first += len(raw)
    elif kind == BLOCKED:
        stream = bgzf.Stream(file, size, first >> 16, first & 0xFFFF)
        while (place := stream.place()) >> 16 < size and (last is None or place < last):
            there = stream.held_of_block()
            if last is not None and place >> 16 == last >> 16:
                there = min(there, (last & 0xFFFF) - (place & 0xFFFF))
            yield place, stream.read(there)
    else:
        source = Inflated(file)
        while raw := source.read(PIECE):
            yield 0, raw


def records(chunks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[str, str, str]]:
    """(name, seq, qual) of whole records, without white space around."""
    rest = b""
    for _, raw in chunks:
        lines = (rest + raw).split(b"\n")
        whole = (len(lines) - 1) // 4 * 4
        for i in range(0, whole, 4):
            yield lines[i].strip().decode(), lines[i + 1].strip().decode(), lines[i + 3].strip().decode()
        rest = b"\n".join(lines[whole:])
    lines = rest.split(b"\n")
    if len(lines) >= 4 and lines[3]:
        yield lines[0].strip().decode(), lines[1].strip().decode(), lines[3].strip().decode()


@dataclass
class File:
    """A file's name, packed bytes, kind and number in order of names, from 1."""

    path: str
    size: int
    kind: str
    number: int


@dataclass
class Task(InputPartition):
    """Records of a file between two places, the first one's number, and for mates the other file, opened ``skip`` records before."""

    file: dict
    first: int
    last: int | None
    record: int = 0
    wanted: int | None = None
    other: dict | None = None
    other_first: int = 0
    skip: int = 0


def split_size(spark: SparkSession) -> int:
    """Bytes of a range: RANGE, or less if the session asks for smaller splits of files."""
    told = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower())
    return min(RANGE, int(told[1]) << 10 * " kmgt".index(told[2] or " ")) if told else RANGE


def found_files(paths: str | list[str]) -> list[File]:
    out = []
    for i, (path, size) in enumerate(files_of(paths)):
        system, own = located(path)
        with system.open_input_file(own) as file:
            start = file.read_at(min(64, size), 0) if size else b""
        kind = BLOCKED if bgzf.block_at(start, 0) else WHOLE if start[:2] == b"\x1f\x8b" else PLAIN
        out.append(File(path, size, kind, i + 1))
    return out


class FastqReader(DataSourceReader):
    """Counts ranges (option ``files``), or reads what a plan says (option ``plan``)."""

    def __init__(self, options: dict[str, str], paired: bool):
        self.plan, self.files, self.paired = json.loads(options.get("plan", "[]")), json.loads(options.get("files", "[]")), paired
        self.range = int(options.get("range", RANGE))

    def partitions(self) -> Sequence[InputPartition]:
        if self.files:
            return [Task(f, s, min(s + self.range, f["size"])) for f in self.files for s in range(0, max(f["size"], 1), self.range)]
        return [Task(**t) for t in self.plan]

    def read(self, task: Task | None) -> Iterator[pa.RecordBatch]:
        if task is None:
            return
        if self.files:
            yield self.counted(task)
            return
        rows = self.opened(task.file, task.first, task.last)
        if self.paired:
            rows = zip(rows, islice(self.opened(task.other, task.other_first, None), task.skip, None), strict=False)
        if task.wanted is not None:
            rows = islice(rows, task.wanted)
        at = task.record
        while batch := list(islice(rows, BATCH)):
            numbers = [pa.array([task.file["number"]] * len(batch), pa.int32()), pa.array(range(at, at + len(batch)), pa.int64())]
            columns = [pa.array(c, pa.string()) for c in zip(*((a + b for a, b in batch) if self.paired else batch), strict=True)]
            at += len(batch)
            front = [] if self.paired else [pa.array([task.file["path"]] * len(batch), pa.string())]
            names = [c.split()[0] for c in (PAIRS if self.paired else READS).split(", ")]
            yield pa.RecordBatch.from_arrays([*front, *numbers, *columns], names=names)

    def opened(self, file: dict, first: int, last: int | None) -> Iterator[tuple[str, str, str]]:
        system, own = located(file["path"])
        with system.open_input_file(own) if file["kind"] != WHOLE else system.open_input_stream(own, compression=None) as source:
            yield from records(pieces(source, file["size"], file["kind"], first, last))

    def counted(self, task: Task) -> pa.RecordBatch:
        """Records between a range's first one and the next range's, and places of some; a record that the file's end cuts off doesn't count."""
        size, kind = task.file["size"], task.file["kind"]
        system, own = located(task.file["path"])
        with system.open_input_file(own) as file:
            first, last = (first_record(file, size, kind, at) for at in (task.first, task.last))
            lines, seen, marks, tail = 0, 0, [], b"\n"
            for place, raw in pieces(file, size, kind, first, last) if first < last else ():
                if seen * (MARKS + 1) > self.range * (len(marks) + 1) and (off := next_border(raw, lines, tail != b"\n")) is not None:
                    marks.append({"records": -(-(lines + (tail != b"\n")) // 4), "place": place + off})
                lines, seen, tail = lines + raw.count(b"\n"), seen + len(raw), raw[-1:]
            if last < end_of(size, kind) and lines % 4:
                raise ValueError(f"{task.file['path']}: ranges do not meet at {last}")
            lines += tail != b"\n"
        kinds = pa.list_(pa.struct([("records", pa.int64()), ("place", pa.int64())]))
        columns = [pa.array([x], k) for x, k in ((task.file["number"], pa.int32()), (task.first, pa.int64()), (first, pa.int64()), (last, pa.int64()), (lines // 4, pa.int64()), (marks, kinds))]
        return pa.RecordBatch.from_arrays(columns, names=["file_no", "start", "first", "last", "records", "marks"])


class FastqSource(DataSource):
    paired = False

    @classmethod
    def name(cls) -> str:
        return "readloom_fastq"

    def schema(self) -> str:
        return COUNTS if "files" in self.options else PAIRS if self.paired else READS

    def reader(self, schema) -> FastqReader:
        return FastqReader(dict(self.options), self.paired)


class FastqPairs(FastqSource):
    paired = True

    @classmethod
    def name(cls) -> str:
        return "readloom_fastq_pairs"


@dataclass
class Piece:
    """A counted range: its places, how many records lie before and in it, and places noted by number."""

    first: int
    last: int
    before: int
    records: int
    marks: list[tuple[int, int]]


def counted(spark: SparkSession, files: list[File], range_bytes: int) -> dict[int, list[Piece]]:
    """The ranges of each file that can be read from within, with records; one pass over the files, one row for each range."""
    several = [asdict(f) for f in files if f.kind != WHOLE]
    out: dict[int, list[Piece]] = {f.number: [] for f in files if f.kind != WHOLE}
    if not several:
        return out
    spark.dataSource.register(FastqSource)
    rows = spark.read.format(FastqSource.name()).option("files", json.dumps(several)).option("range", str(range_bytes)).load().collect()
    for r in sorted(rows, key=lambda r: (r["file_no"], r["start"])):
        own = out[r["file_no"]]
        before = own[-1].before + own[-1].records if own else 0
        if r["records"]:
            own.append(Piece(r["first"], r["last"], before, r["records"], [(before, r["first"]), *((before + m["records"], m["place"]) for m in r["marks"])]))
    return out


def load(spark: SparkSession, source: type[FastqSource], plan: list[Task]) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("plan", json.dumps([asdict(t) for t in plan])).load()


def split_reads(spark: SparkSession, path: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """READS of FASTQ files in order; plain files and blocked gzip are read in ranges, other gzip by one task a file."""
    files = found_files(path)
    ranges = counted(spark, files, range_bytes or split_size(spark))
    plan = [t for f in files for t in ([Task(asdict(f), 0, None)] if f.kind == WHOLE else [Task(asdict(f), p.first, p.last, p.before, p.records) for p in ranges[f.number]])]
    return load(spark, FastqSource, plan)


def split_pairs(spark: SparkSession, forward: str | list[str], reverse: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """PAIRS of the files of two lists, in order; the longer file's rest is left out, and nothing is shuffled.

    If a file of a pair is gzip without blocks, one task reads that pair.
    """
    first, second = found_files(forward), found_files(reverse)
    if len(first) != len(second):
        raise ValueError("there must be as many reverse files as forward files")
    size = range_bytes or split_size(spark)
    ranges, others = counted(spark, first, size), counted(spark, second, size)
    plan: list[Task] = []
    for f, r in zip(first, second, strict=True):
        if WHOLE in (f.kind, r.kind):
            plan.append(Task(asdict(f), 0, None, other=asdict(r)))
            continue
        marks = [m for p in others[r.number] for m in p.marks]
        there = others[r.number][-1].before + others[r.number][-1].records if marks else 0
        at = 0
        for p in ranges[f.number]:
            wanted = min(p.records, there - p.before)
            if wanted > 0:
                while at + 1 < len(marks) and marks[at + 1][0] <= p.before:
                    at += 1
                plan.append(Task(asdict(f), p.first, p.last, p.before, wanted, asdict(r), marks[at][1], p.before - marks[at][0]))
    return load(spark, FastqPairs, plan)

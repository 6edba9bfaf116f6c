"""BAM files as a data source: read in ranges of blocks or by region, written sorted and indexed.

A range's first block is found by the chain of blocks behind it, its first record
by the chain of records. Where a range ends, the reader looks for the next range's
first record too and compares it with where its own last record ended, so a wrong
guess would fail the job instead of changing what is read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from readloom.sources import bgzf
from readloom.sources.bam_index import Index, PartIndex, parsed_region
from readloom.sources.bam_records import Head, head_bytes, head_of, record, record_bytes, size_if_record, span_of
from readloom.sources.inflated import SLICE, Inflated
from readloom.sources.storage import clear_folder, files_of, join_parts, located

SCHEMA = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Records of a batch, packed bytes of a range, and records that must follow one another where a search finds one.
BATCH, RANGE, CHAIN = 5000, 64 << 20, 8

def head_in(path: str) -> Head:
    system, own = located(path)
    with system.open_input_stream(own, compression=None) as file:
        return head_of(Inflated(file).read)


def first_record(file, size: int, start: int, head: Head) -> int:
    """Place of the first record whose block starts at or behind ``start``; the file's size, shifted, if there is none."""
    block = bgzf.first_block(file, size, start)
    stream = bgzf.Stream(file, size, block)
    if block == 0:
        stream.skip(head.length)
        return stream.place()
    off = 0
    while stream.there(off + 1):
        at, chain = off, 0
        while chain < CHAIN and stream.there(at + 36):
            told = size_if_record(stream.held, stream.used + at, head.sizes)
            if told is None:
                break
            at, chain = at + told, chain + 1
        if chain == CHAIN or chain and not stream.there(at + 1) and len(stream.held) - stream.used == at:
            stream.skip(off)
            return stream.place()
        off += 1
        if off == SLICE:
            stream.skip(off)
            off = 0
    return size << 16


@dataclass
class Range(InputPartition):
    """Records of a file whose places lie in [first, last); ``start`` and ``end`` instead are packed bytes, of which the places are found."""

    path: str
    size: int
    start: int = 0
    end: int = 0
    first: int | None = None
    last: int | None = None
    blocked: bool = True


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.region = options.get("region")
        self.range = int(options.get("range", RANGE))
        self.files = files_of(options["path"].split("\n"))
        self.heads = {path: head_in(path) for path, _ in self.files}

    def partitions(self) -> Sequence[Range]:
        out = []
        for path, size in self.files:
            system, own = located(path)
            with system.open_input_file(own) as file:
                blocked = bgzf.is_blocked(file)
            if self.region and blocked:
                ref, start, end = parsed_region(self.region, self.heads[path])
                out += [Range(path, size, first=a, last=b) for a, b in Index.of_file(path + ".bai").places(ref, start, end)]
            elif blocked:
                out += [Range(path, size, s, min(s + self.range, size)) for s in range(0, size, self.range)]
            else:
                out.append(Range(path, size, blocked=False))
        return out

    def records(self, part: Range) -> Iterator[bytes]:
        system, own = located(part.path)
        head = self.heads[part.path]
        if not part.blocked:
            with system.open_input_stream(own, compression=None) as file:
                source = Inflated(file)
                head_of(source.read)
                while size := source.read(4):
                    yield source.read(struct.unpack("<i", size)[0])
            return
        with system.open_input_file(own) as file:
            first = first_record(file, part.size, part.start, head) if part.first is None else part.first
            last = part.end << 16 if part.last is None else part.last
            if first >= last:
                return
            stream = bgzf.Stream(file, part.size, first >> 16, first & 0xFFFF)
            while (place := stream.place()) < last:
                raw = stream.read(4)
                size = struct.unpack("<i", raw)[0] if len(raw) == 4 else -1
                raw = stream.read(max(size, 0))
                if size < 32 or len(raw) < size:
                    raise ValueError(f"{part.path}: no whole record at {place}")
                yield raw
            if part.last is None and part.end < part.size and first_record(file, part.size, part.end, head) != place:
                raise ValueError(f"{part.path}: ranges do not meet at {place}")

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # a region without records has no range
            return
        head, rows = self.heads[part.path], []
        ref, start, end = parsed_region(self.region, head) if self.region else (-1, 0, 0)
        name = part.path.rpartition("/")[2]
        for raw in self.records(part):
            row = record(raw, head.names)
            if self.region and not (row[2] == head.names[ref] and row[3] <= end and row[3] - 1 + max(1, span_of(row[5])) > start):
                continue
            rows.append(row)
            if len(rows) == BATCH:
                yield table(rows, name)
                rows = []
        if rows:
            yield table(rows, name)


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its number, its file and its share of the index."""

    number: int
    path: str
    index: PartIndex = field(default_factory=PartIndex)


class BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.text = options["path"], options.get("header", "")
        system, own = located(self.path)
        if not overwrite and system.get_file_info([own])[0].type.value:
            raise FileExistsError(self.path)
        self.names, self.sizes = contigs_of(self.text)
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        part = Part(task.partitionId(), f"{self.parts}/{task.partitionId()}-{task.taskAttemptId()}")
        refs = {name: i for i, name in enumerate(self.names)}
        system, own = located(part.path)
        system.create_dir(located(self.parts)[1], recursive=True)
        with system.open_output_stream(own, compression=None) as out:
            writer = bgzf.Writer(out)
            for batch in iterator:
                for row in batch.to_pylist():
                    raw, ref, start, end = record_bytes(row, refs)
                    part.index.add(ref, start, end, *writer.put(raw))
            writer.flush()
            part.index.bytes = writer.at
        return part

    def commit(self, messages: list[Part | None]) -> None:
        """Joins the parts in order, behind the header and in front of the mark of the file's end, and writes the index."""
        parts = sorted((m for m in messages if m), key=lambda m: m.number)
        raw = head_bytes(self.text, self.names, self.sizes)
        head = b"".join(bgzf.pack(raw[i : i + bgzf.MOST]) for i in range(0, len(raw), bgzf.MOST))
        index = Index.joined([p.index for p in parts], len(head), len(self.names))
        join_parts(self.path, head, [p.path for p in parts], bgzf.END)
        index.to_file(self.path + ".bai")
        clear_folder(self.parts)

    def abort(self, messages: list[Part | None]) -> None:
        clear_folder(self.parts)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "readloom_bam"

    def schema(self) -> str:
        return SCHEMA + ", file string"

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options), overwrite)


def contigs_of(text: str) -> tuple[list[str], list[int]]:
    """Names and sizes of a header's contigs."""
    lines = [dict(f.split(":", 1) for f in line.split("\t")[1:]) for line in text.splitlines() if line.startswith("@SQ\t")]
    return [x["SN"] for x in lines], [int(x["LN"]) for x in lines]


def read_bam(spark: SparkSession, path: str | list[str], *, region: str | None = None, range_bytes: int = RANGE) -> DataFrame:
    """The records of BAM files and the name of each one's file.

    Files are read in ranges of ``range_bytes`` packed bytes, whatever their size.
    ``region`` (contig, contig:first or contig:first-last, from 1) reads only
    blocks that may hold records over it, which takes an index beside each file
    (``.bai``). A file in plain gzip instead of blocks is one task's.
    """
    spark.dataSource.register(BamSource)
    reader = spark.read.format(BamSource.name()).option("path", path if isinstance(path, str) else "\n".join(path)).option("range", str(range_bytes))
    return (reader.option("region", region) if region else reader).load()


def read_bam_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """line_no, line, file of the headers' text."""
    rows = [(i, line, name.rpartition("/")[2]) for name, _ in files_of(path) for i, line in enumerate(head_in(name).text.splitlines())]
    return spark.createDataFrame(rows, "line_no long, line string, file string")


def write_bam(header: DataFrame, sam: DataFrame, path: str) -> None:
    """One BAM file sorted by contig, in the header's order, position, name and flag, unplaced records last, and its index.

    ``header``: line_no, line, with a @SQ line for each contig; ``sam``: the
    columns of SCHEMA. Ranges of the order are packed by a task each, with their
    share of the index; the commit joins the packed parts, a piece at a time. Records
    of one place are dealt by name too, so a pile-up is no single task's.
    """
    spark = sam.sparkSession
    spark.dataSource.register(BamSource)
    text = "".join(f"{r['line']}\n" for r in header.orderBy("line_no").collect())
    order = spark.createDataFrame([(n, i) for i, n in enumerate(contigs_of(text)[0])], "contig_name string, contig_no int")
    placed = sam.join(F.broadcast(order), sam["rname"] == order["contig_name"], "left")
    keys = [F.coalesce("contig_no", F.lit((1 << 31) - 1)), "pos", "qname", "flag"]
    laid = placed.repartitionByRange(*keys).sortWithinPartitions(*keys, *(c for c in COLUMNS if c not in ("pos", "qname", "flag", "tags")))
    laid.select(*COLUMNS).write.format(BamSource.name()).option("path", path).option("header", text).mode("overwrite").save()


def with_lines(bam: DataFrame) -> DataFrame:
    """Adds each record as a SAM line."""
    fields = [F.col(c).cast("string") for c in COLUMNS[:-1]]
    return bam.withColumn("line", F.concat_ws("\t", *fields, F.col("tags")))


def table(rows: list[tuple], file: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}
    columns = [pa.array(v, kinds[c.split()[1]]) for v, c in zip(zip(*rows, strict=True), SCHEMA.split(", "), strict=True)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([file] * len(rows))], names=[*COLUMNS, "file"])

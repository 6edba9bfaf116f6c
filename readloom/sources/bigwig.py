"""bigWig files as a data source: coverage with summaries in bins of several sizes, each under an index of its own.

Tasks pack ranges of places into blocks and tell where these lie; the commit joins
the packed blocks, a piece at a time, and writes the trees over them. What it keeps
grows with the genome's blocks, not with reads.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from readloom.operators.zoom import SUMMARY, pyramid
from readloom.sources import bigwig_layout as L
from readloom.sources.storage import clear_folder, located

RUNS = "chrom string, start_pos long, end_pos long, value double"
BINS = "chrom string, start_pos long, end_pos long, valid long, least double, most double, total double, squares double"
ROWS = "level int, contig int, start_pos long, end_pos long, valid long, least double, most double, total double, squares double"
#: Levels of summaries at most, how much longer their bins get, and blocks of a task that reads.
LEVELS, TIMES, READ_BLOCKS = 10, 4, 200


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its number, its file, its blocks by level, the records of each level, and the sums of the data."""

    number: int
    path: str
    blocks: list[tuple[int, L.Block]] = field(default_factory=list)
    records: dict[int, int] = field(default_factory=dict)
    total: list[float] = field(default_factory=lambda: [0, float("inf"), float("-inf"), 0.0, 0.0])


class BigWigWriter(DataSourceArrowWriter):
    """Takes ROWS in order of level, contig and start; level 0 has the runs, their value as least."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.names, self.sizes = options["names"].split("\t"), [int(n) for n in options["sizes"].split("\t")]
        self.bins = [int(n) for n in options["bins"].split("\t") if n]
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        part = Part(task.partitionId(), f"{self.parts}/{task.partitionId()}-{task.taskAttemptId()}")
        system, own = located(part.path)
        system.create_dir(located(self.parts)[1], recursive=True)
        held, now, at = [], None, 0

        def flush() -> int:
            if not held:
                return at
            level, contig = now
            runs = [(r[2], r[3], r[5]) for r in held]
            raw = L.section(contig, runs) if level == 0 else b"".join(L.RECORD.pack(*r[1:]) for r in held)
            packed = zlib.compress(raw)
            out.write(packed)
            part.blocks.append((level, L.Block(contig, held[0][2], held[-1][3], at, len(packed), len(raw))))
            part.records[level] = part.records.get(level, 0) + len(held)
            held.clear()
            return at + len(packed)

        with system.open_output_stream(own, compression=None) as out:
            for batch in iterator:
                for row in zip(*(batch[c.split()[0]].to_pylist() for c in ROWS.split(", ")), strict=True):
                    if row[:2] != now or len(held) == (L.RECORDS if row[0] else L.ITEMS):
                        at, now = flush(), row[:2]
                    held.append(row)
                    if row[0] == 0:
                        t, bases, value = part.total, row[3] - row[2], row[5]
                        part.total = [t[0] + bases, min(t[1], value), max(t[2], value), t[3] + bases * value, t[4] + bases * value * value]
            at = flush()
        return part

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m), key=lambda m: m.number)
        tree_at = L.HEAD.size + L.ZOOM_HEAD.size * len(self.bins) + L.TOTAL.size
        tree = L.contigs_packed(self.names, self.sizes, tree_at)
        system, own = located(self.path)
        places, zooms, data_at, index_at = tree_at + len(tree), [], 0, 0
        body = f"{self.parts}/body"
        with system.open_output_stream(located(body)[1], compression=None) as out:
            for level in range(len(self.bins) + 1):
                count = sum(1 for p in parts for x, _ in p.blocks if x == level) if level == 0 else sum(p.records.get(level, 0) for p in parts)
                start = count.to_bytes(4 if level else 8, "little")
                out.write(start)
                at, blocks = places + len(start), []
                for part in parts:
                    mine = [b for x, b in part.blocks if x == level]
                    if mine:
                        blocks += [b._replace(at=at + b.at - mine[0].at) for b in mine]
                        at += copy_bytes(out, part.path, mine[0].at, mine[-1].at + mine[-1].size)
                index = L.index_packed(blocks, at)
                out.write(index)
                if level:
                    zooms.append(L.ZOOM_HEAD.pack(self.bins[level - 1], 0, places, at))
                else:
                    data_at, index_at = places, at
                places = at + len(index)
            out.write(L.MAGIC.to_bytes(4, "little"))
        totals = [p.total for p in parts if p.total[0]]
        total = [sum(t[0] for t in totals), min((t[1] for t in totals), default=0.0), max((t[2] for t in totals), default=0.0), sum(t[3] for t in totals), sum(t[4] for t in totals)]
        longest = max((b.plain for p in parts for _, b in p.blocks), default=1)
        head = L.HEAD.pack(L.MAGIC, L.VERSION, len(self.bins), tree_at, data_at, index_at, 0, 0, 0, tree_at - L.TOTAL.size, longest, 0)
        with system.open_output_stream(own, compression=None) as out:
            out.write(head + b"".join(zooms) + L.TOTAL.pack(*total) + tree)
            copy_bytes(out, body, 0, None)
        clear_folder(self.parts)

    def abort(self, messages: list[Part | None]) -> None:
        clear_folder(self.parts)


def copy_bytes(out, path: str, start: int, end: int | None, piece: int = 8 << 20) -> int:
    """Copies a range of a file's bytes, a piece at a time; returns how many."""
    system, own = located(path)
    with system.open_input_file(own) as source:
        end = source.size() if end is None else end
        for at in range(start, end, piece):
            out.write(source.read_at(min(piece, end - at), at))
    return end - start


@dataclass
class Blocks(InputPartition):
    places: list[tuple[int, int]]


class BigWigReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.bins, self.region = options["path"], int(options.get("bins", 0)), options.get("region")
        with self.opened() as file:
            self.layout = L.layout_of(lambda at, n: file.read_at(n, at))
        self.contig, self.start, self.end = None, 0, 1 << 32
        if self.region:
            name, _, places = self.region.rpartition(":")
            first, _, last = places.replace(",", "").partition("-")
            self.contig, self.start, self.end = self.layout.names.index(name), int(first) - 1, int(last)

    def opened(self):
        system, own = located(self.path)
        return system.open_input_file(own)

    def partitions(self) -> Sequence[Blocks]:
        index = dict(self.layout.levels)
        if self.bins not in index:
            raise ValueError(f"bins of the file have {sorted(index)} bases")
        with self.opened() as file:
            found = L.blocks_over(lambda at, n: file.read_at(n, at), index[self.bins], self.contig, self.start, self.end)
        return [Blocks(found[i : i + READ_BLOCKS]) for i in range(0, len(found), READ_BLOCKS)]

    def read(self, part: Blocks | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        schema = [c.split() for c in (BINS if self.bins else RUNS).split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
        with self.opened() as file:
            for at, size in part.places:
                raw = L.unpacked(file.read_at(size, at), self.layout.buffer)
                rows = [L.RECORD.unpack_from(raw, i) for i in range(0, len(raw), L.RECORD.size)] if self.bins else L.runs_in(raw)
                rows = [(self.layout.names[r[0]], *r[1:]) for r in rows if self.contig is None or r[0] == self.contig and r[1] < self.end and r[2] > self.start]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), schema, strict=True)], names=[n for n, _ in schema])


class BigWigSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "readloom_bigwig"

    def schema(self) -> str:
        return BINS if int(self.options.get("bins", "0")) else RUNS

    def reader(self, schema) -> BigWigReader:
        return BigWigReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> BigWigWriter:
        return BigWigWriter(dict(self.options))


def bin_sizes(runs: DataFrame, longest: int) -> list[int]:
    """Bases of the bins of each level: ten runs at first, then longer ones up to the longest contig."""
    mean = runs.agg(F.avg(F.col("end_pos") - F.col("start_pos"))).first()[0]
    sizes = [max(10, round(10 * mean))] if mean else []
    while sizes and len(sizes) < LEVELS and sizes[-1] * TIMES < longest:
        sizes.append(sizes[-1] * TIMES)
    return sizes


def write_bigwig(runs: DataFrame, sizes: DataFrame, path: str) -> None:
    """Runs (chrom, start_pos, end_pos, depth) that don't overlap, as a bigWig file with its levels of summaries.

    ``sizes``: chrom, size, with every contig of the runs. Depths are kept as 32-bit floats.
    """
    spark = runs.sparkSession
    spark.dataSource.register(BigWigSource)
    contigs = sorted((r["chrom"], r["size"]) for r in sizes.select("chrom", "size").collect())
    order = spark.createDataFrame([(n, i, s) for i, (n, s) in enumerate(contigs)], "chrom string, contig int, size long")
    bins = bin_sizes(runs, max((s for _, s in contigs), default=0))
    value = F.col("depth").cast("double")
    data = runs.select(F.lit(0).alias("level"), "chrom", "start_pos", "end_pos", (F.col("end_pos") - F.col("start_pos")).alias("valid"), value.alias("least"), value.alias("most"), value.alias("total"), value.alias("squares"))
    if bins:
        zooms = pyramid(runs.withColumn("depth", value), size=bins[0], levels=len(bins), times=TIMES)
        data = data.unionByName(zooms.select("level", "chrom", "start_pos", "end_pos", *SUMMARY))
    known = data.join(F.broadcast(order), "chrom", "left")
    checked = F.when(F.col("contig").isNotNull() & ((F.col("level") > 0) | (F.col("end_pos") <= F.col("size"))), F.col("contig")).otherwise(F.raise_error(F.concat(F.lit("not within a contig: "), F.col("chrom"))).cast("int"))
    placed = known.withColumns({"contig": checked, "end_pos": F.least("end_pos", "size")})
    keys = ("level", "contig", "start_pos")
    laid = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*(c.split()[0] for c in ROWS.split(", ")))
    tabbed = lambda x: "\t".join(map(str, x))
    laid.write.format(BigWigSource.name()).option("path", path).option("names", tabbed(n for n, _ in contigs)).option("sizes", tabbed(s for _, s in contigs)).option("bins", tabbed(bins)).mode("append").save()


def read_bigwig(spark: SparkSession, path: str, *, region: str | None = None, bins: int = 0) -> DataFrame:
    """RUNS of a bigWig file, or with ``bins`` the BINS of the level that has bins of so many bases.

    ``region`` (contig:first-last, from 1) reads only the blocks that the index has over it.
    """
    spark.dataSource.register(BigWigSource)
    reader = spark.read.format(BigWigSource.name()).option("path", path).option("bins", str(bins))
    return (reader.option("region", region) if region else reader).load()


def bigwig_bins(path: str) -> list[int]:
    """Bases of the bins of each level."""
    return [b for b, _ in BigWigReader({"path": path}).layout.levels if b]

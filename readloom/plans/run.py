"""Whole runs: stages that are written, skipped when they are there already, and a command line."""

from __future__ import annotations

import argparse
import hashlib
import json
import logging
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators import coverage as C
from readloom.operators import dedup as D
from readloom.operators import demux as X
from readloom.operators.merge import merge_aligners, merge_mates, unmapped
from readloom.operators.adapters import trim_adapter
from readloom.operators.align import align_reads
from readloom.operators.overlap import merge_mates_by_score
from readloom.plans.layout import parse_layout
from readloom.sources import readers, writers
from readloom.sources.bam import read_bam, read_bam_header, with_lines, write_bam
from readloom.sources.bigwig import write_bigwig
from readloom.sources.storage import clear_folder

log = logging.getLogger(__name__)


class Stages:
    """Stage results below one folder. A finished stage with the same inputs is read, any other is written anew.

    The fingerprint of its inputs is written beside a result after the result
    itself, so a stage that was broken off is made again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def contents(self, *paths: str | None) -> list:
        """Name, size and time of change of every file of the inputs, so that a file that was changed in place is a new input."""
        given = [p for p in paths if p]
        files = self.spark.read.format("binaryFile").load(given).select("path", "length", F.col("modificationTime").cast("double").cast("string"))
        return sorted(map(list, files.collect()))

    def finished(self, name: str, print_: str) -> bool:
        try:
            return self.spark.read.text(f"{self.folder}/{name}.done").first()[0] == print_
        except (AnalysisException, TypeError):
            return False

    def run(self, name: str, inputs: dict, make: Callable[[], DataFrame]) -> DataFrame:
        print_ = hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()
        path = f"{self.folder}/{name}"
        if self.finished(name, print_):
            log.info("%s: finished before", name)
        else:
            log.info("%s: started", name)
            make().write.mode("overwrite").parquet(path)
            self.spark.createDataFrame([(print_,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.done")
            log.info("%s: finished", name)
        return self.spark.read.parquet(path)


@dataclass
class DemuxRun:
    """Parameters of a demultiplexing run."""

    forward: str
    reverse: str | None
    samples: str
    out: str
    merged: str | None = None
    layout: str = "flash"
    max_mismatch: int = 1
    ignore_pairs: bool = False
    gzip: bool = True
    merge_first: bool = False
    min_insert: int = 30
    max_mismatch_rate: float = 0.0
    forward_adapter: str | None = None
    reverse_adapter: str | None = None


def run_demux(spark: SparkSession, run: DemuxRun) -> dict[str, DataFrame]:
    """Reads, classifies and writes pairs and merged reads, by sample below barcode_sorted; returns what was written and the statistics."""
    if (run.merge_first or not run.ignore_pairs) and not run.reverse:
        raise ValueError("pairs need a reverse file")
    if run.merge_first and run.merged:
        raise ValueError("reads are merged here or were before, not both")
    layout = parse_layout(run.layout)
    samples = readers.read_samples(spark, run.samples)
    X.check_samples(samples)
    stages, found = Stages(spark, run.out), {}
    given = asdict(run) | {"files": stages.contents(run.forward, run.reverse, run.samples, run.merged), "sheet": sorted(map(list, samples.collect()))}
    pairs = merged = None
    if run.merge_first or not run.ignore_pairs:
        if len(stages.contents(run.forward)) != len(stages.contents(run.reverse)):
            raise ValueError("there must be as many reverse files as forward files")
        pairs = readers.read_pairs(spark, run.forward, run.reverse)
        for side, adapter in (("f", run.forward_adapter), ("r", run.reverse_adapter)):
            if adapter:
                pairs = trim_adapter(pairs, adapter, seq=f"seq_{side}", qual=f"qual_{side}").drop("adapter_mismatches")
    if run.merge_first:
        if run.max_mismatch_rate > 0:
            merged, pairs = merge_mates_by_score(pairs, min_insert=run.min_insert, max_mismatch_rate=run.max_mismatch_rate)
            merged = merged.drop("overlap", "mismatches")
        else:
            merged, pairs = merge_mates(pairs, min_insert=run.min_insert)
    elif run.merged:
        merged = readers.read_fastq(spark, run.merged)
    if not run.ignore_pairs:
        found["pairs"] = stages.run("pairs", given, lambda: X.demux_pairs(pairs, samples, layout, run.max_mismatch))
    if merged is not None:
        found["merged"] = stages.run("merged", given, lambda: X.demux_merged(merged, samples, layout, run.max_mismatch))
    clear_folder(f"{run.out}/barcode_sorted")
    for name, reads in list(found.items()):
        writers.write_fastq(reads, f"{run.out}/barcode_sorted", gzip=run.gzip)
        writers.write_bad_barcodes(X.bad_barcodes(reads), f"{run.out}/bad_barcodes/{name}")
        found[f"{name}_counts"] = X.sample_counts(reads, samples, layout)
        found[f"{name}_outcomes"] = X.outcome_counts(reads)
    return found


@dataclass
class TrackRun:
    """Parameters of a run from alignments to tracks: SAM paths by (sample, replicate, aligner)."""

    out: str
    alignments: dict[tuple[str, str, str], str] = field(default_factory=dict)
    min_mapq: int = 10
    strict: bool = True
    merge_replicates: bool = False
    sizes: str | None = None


def write_bigwigs(spark: SparkSession, runs: DataFrame, by: tuple[str, ...], sizes: str, folder: str) -> None:
    """A bigWig file for each group and strand that has coverage; there are as many groups as alignments were given."""
    contigs = readers.read_chrom_sizes(spark, sizes)
    for group in runs.select(*by, "strand").distinct().orderBy(*by, "strand").collect():
        own = runs
        for c in (*by, "strand"):
            own = own.filter(F.col(c).eqNullSafe(F.lit(group[c])))
        strand = {"+": "plus", "-": "minus"}[group["strand"]]
        write_bigwig(own, contigs, f"{folder}/{'_'.join(group[c] for c in by)}_{strand}_coverage.bw")


def run_tracks(spark: SparkSession, run: TrackRun) -> dict[str, DataFrame]:
    """Duplicate removal for each file, union of the aligners, coverage of reads and of crosslinks."""
    by = ("sample", "replicate", "aligner")
    stages = Stages(spark, run.out)
    given = {"min_mapq": run.min_mapq, "strict": run.strict, "alignments": {"/".join(k): v for k, v in run.alignments.items()}, "files": stages.contents(*run.alignments.values())}

    def tagged() -> DataFrame:
        opened = lambda path: read_bam(spark, path) if path.endswith(".bam") else readers.read_sam(spark, path)
        beds = [readers.sam_to_bed(opened(path).drop("file")).withColumns({c: F.lit(v) for c, v in zip(by, key, strict=True)}) for key, path in run.alignments.items()]
        return merge_aligners(*beds)

    kept = stages.run("dedup", given, lambda: D.dedup_alignments(tagged(), min_mapq=run.min_mapq, strict=run.strict, by=by))
    found = {"dedup": kept}
    writers.write_bed(C.crosslinks(kept), f"{run.out}/bed/xlinks", ("sample", "replicate"))
    for name, bed in (("reads", kept), ("xlinks", C.crosslinks(kept))):
        apart, whole = C.merged_coverage(bed, ("sample",), "replicate")
        found[name] = stages.run(f"coverage_{name}", given, lambda apart=apart: apart)
        writers.write_bedgraph(found[name], f"{run.out}/bedgraph/{name}", ("sample", "replicate"))
        if run.sizes:
            write_bigwigs(spark, found[name], ("sample", "replicate"), run.sizes, f"{run.out}/bigwig/{name}")
        if run.merge_replicates:
            found[f"{name}_merged"] = stages.run(f"coverage_{name}_merged", given, lambda whole=whole: whole)
            writers.write_bedgraph(found[f"{name}_merged"], f"{run.out}/bedgraph/{name}_merged", ("sample",))
            if run.sizes:
                write_bigwigs(spark, found[f"{name}_merged"], ("sample",), run.sizes, f"{run.out}/bigwig/{name}_merged")
    return found


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="readloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    demux = commands.add_parser("demux", help="split reads by sample and replicate")
    demux.add_argument("-f", "--forward", required=True)
    demux.add_argument("-r", "--reverse")
    demux.add_argument("-b", "--samples", required=True)
    demux.add_argument("-o", "--out", required=True)
    demux.add_argument("--merged", help="reads that were merged before")
    demux.add_argument("-bm", "--merge-first", action="store_true", help="merge overlapping mates first")
    demux.add_argument("-mi", "--min-insert", type=int, default=30)
    demux.add_argument("-mm", "--max-mismatch-rate", type=float, default=0.0, help="mismatches a base of an overlap that is merged")
    demux.add_argument("-a1", "--forward-adapter", help="cut off forward reads before all else")
    demux.add_argument("-a2", "--reverse-adapter", help="cut off reverse reads")
    demux.add_argument("-ub", "--layout", default="flash")
    demux.add_argument("-hm", "--max-mismatch", type=int, default=1)
    demux.add_argument("-i", "--ignore-pairs", action="store_true")
    demux.add_argument("--plain", action="store_true", help="no gzip")
    fastq = commands.add_parser("dedup-reads", help="one read for each sequence and barcode")
    fastq.add_argument("-f", "--forward", required=True)
    fastq.add_argument("-o", "--out", required=True)
    sam = commands.add_parser("dedup-sam", help="drop duplicate alignments of SAM or BAM files")
    sam.add_argument("-i", "--input", required=True, nargs="+", help="several files are cleaned each for itself, in one job, into a folder each")
    sam.add_argument("-o", "--out", required=True)
    sam.add_argument("-k", "--bed")
    sam.add_argument("--bam", action="store_true", help="write sorted BAM files with an index instead of SAM text; of several files into the output folder")
    sam.add_argument("-m", "--min-mapq", type=int, default=10)
    sam.add_argument("--keep-last", action="store_true")
    tracks = commands.add_parser("tracks", help="from alignments to coverage and crosslink tracks")
    tracks.add_argument("-a", "--alignments", required=True, nargs="+", metavar="SAMPLE/REPLICATE/ALIGNER=PATH")
    tracks.add_argument("-o", "--out", required=True)
    tracks.add_argument("-m", "--min-mapq", type=int, default=10)
    tracks.add_argument("-mr", "--merge-replicates", action="store_true")
    tracks.add_argument("-g", "--chrom-sizes", help="names and sizes of chromosomes; with it, coverage is written as bigWig files too")
    tracks.add_argument("--keep-last", action="store_true")
    align = commands.add_parser("align", help="place reads on a reference, as sorted, indexed BAM")
    align.add_argument("-f", "--forward", required=True)
    align.add_argument("-x", "--reference", required=True, help="FASTA file")
    align.add_argument("-o", "--out", required=True)
    rest = commands.add_parser("unmapped", help="reads that no alignment has, as FASTQ")
    rest.add_argument("-f", "--forward", required=True)
    rest.add_argument("-a", "--alignments", required=True, nargs="+", help="SAM files")
    rest.add_argument("-o", "--out", required=True)
    rest.add_argument("--plain", action="store_true", help="no gzip")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("readloom").getOrCreate()
    if args.command == "demux":
        run = DemuxRun(args.forward, args.reverse, args.samples, args.out, args.merged, args.layout, args.max_mismatch, args.ignore_pairs, not args.plain, args.merge_first, args.min_insert, args.max_mismatch_rate, args.forward_adapter, args.reverse_adapter)
        for name, df in run_demux(spark, run).items():
            if name.endswith(("_counts", "_outcomes")):
                df.show(200, truncate=False)
    elif args.command == "dedup-reads":
        reads = readers.read_fastq(spark, args.forward)
        kept = D.best_reads(reads)
        writers.write_reads(kept, args.out)
        D.read_stats(reads, kept).show()
    elif args.command == "tracks":
        alignments = {tuple(key.split("/")): path for key, path in (a.split("=", 1) for a in args.alignments)}
        if any(len(key) != 3 for key in alignments):
            raise ValueError("alignments are given as sample/replicate/aligner=path")
        run_tracks(spark, TrackRun(args.out, alignments, args.min_mapq, not args.keep_last, args.merge_replicates, args.chrom_sizes))
    elif args.command == "align":
        if args.out in (args.forward, args.reference):
            raise ValueError(f"the input would be overwritten: {args.out}")
        contigs = readers.read_contigs(spark, args.reference)
        sizes = contigs.select("chrom", F.length("seq").alias("size")).orderBy("chrom").collect()
        header = spark.createDataFrame([(i, f"@SQ\tSN:{r['chrom']}\tLN:{r['size']}") for i, r in enumerate(sizes)], "line_no long, line string")
        write_bam(header, align_reads(readers.read_fastq(spark, args.forward), contigs), args.out)
    elif args.command == "unmapped":
        mapped = readers.read_sam(spark, args.alignments).filter(F.col("flag").bitwiseAND(4) == 0)
        names = mapped.select(F.concat(F.lit("@"), F.element_at(F.split("qname", " "), 1)).alias("word"))
        reads = readers.read_fastq(spark, args.forward).withColumn("word", F.element_at(F.split("name", " "), 1))
        writers.write_reads(unmapped(reads.withColumnsRenamed({"name": "whole", "word": "name"}), names.withColumnRenamed("word", "name")).withColumn("name", F.col("whole")), args.out, gzip=not args.plain)
    else:
        clean_alignments(spark, args)


def clean_alignments(spark: SparkSession, args: argparse.Namespace) -> None:
    """Removes duplicates within each of the files, all in one job."""
    packed, several = {i.endswith(".bam") for i in args.input} == {True}, len(args.input) > 1
    if any(i.endswith(".bam") for i in args.input) and not packed:
        raise ValueError("files are BAM or SAM, not both")
    if args.out.rstrip("/") in [i.rstrip("/") for i in args.input] or args.bed and args.bed.rstrip("/") in (*args.input, args.out.rstrip("/")):
        raise ValueError(f"the input or the other output would be overwritten: {args.out}")
    sam = with_lines(read_bam(spark, args.input)) if packed else readers.read_sam(spark, args.input)
    header = read_bam_header(spark, args.input) if packed else readers.read_sam_header(spark, args.input)
    if not several:
        sam, header = sam.drop("file"), header.drop("file")
    by = ("file",) if several else ()
    bed = readers.sam_to_bed(sam)
    kept = D.dedup_alignments(bed, min_mapq=args.min_mapq, strict=not args.keep_last, by=by)
    named = sam.withColumn("qname", F.element_at(F.split("qname", " "), 1))
    lines = D.keep_by_name(named, kept)
    if not args.bam:
        writers.write_sam(header, lines, args.out, by_file=several)
    elif not several:
        write_bam(header, lines, args.out)
    else:
        for path in args.input:
            name = path.rpartition("/")[2]
            write_bam(header.filter(F.col("file") == name), lines.filter(F.col("file") == name), f"{args.out}/{name.removesuffix('.sam').removesuffix('.bam')}.bam")
    if args.bed:
        writers.write_bed(kept, args.bed, by)
    D.alignment_stats(bed, min_mapq=args.min_mapq, strict=not args.keep_last, by=by).show(200, truncate=False)


if __name__ == "__main__":
    main()
